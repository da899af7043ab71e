"""Quality scores by attention-based multiple-instance learning over passages."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A passage has so many bytes; the last one of a text from a half of it more or less.
PASSAGE_BYTES = 512
#: Bytes of text that are encoded at once.
BLOCK_BYTES = 1 << 20
#: Most documents that a model is fitted on, and passages of each.
MAX_DOCUMENTS, MAX_PASSAGES = 4096, 64
EMBEDDED, GATED = 48, 32
EPOCHS, BATCH, RATE, DECAY, SEED = 24, 64, 2e-3, 1e-4, 13
#: The score without any labelled document.
NO_SCORE = 0.5

_CLASSES, _BUCKETS = 8, 256
_PAIRS = _CLASSES * _CLASSES
FEATURES = _PAIRS + _BUCKETS + 3


def _byte_classes() -> np.ndarray:
    """Lower case, upper case, digit, blank, line end, punctuation of prose, other ASCII, beyond ASCII."""
    table = np.full(256, 6, np.uint8)
    for kind, members in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r\x0b\x0c", b".,;:!?'\"()-")):
        table[list(members)] = kind
    table[128:] = 7
    return table


_KIND = _byte_classes()
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8).astype(np.uint32)
_MIX = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35], np.uint32)


def passage_count(n_bytes: int) -> int:
    return max(1, (n_bytes + PASSAGE_BYTES // 2) // PASSAGE_BYTES)


def _slices(texts: list[bytes]) -> Iterator[list[tuple[int, int, int, int]]]:
    """Blocks of ``(text, first passage, start, end)``: whole passages, of a bounded size together."""
    block, size = [], 0
    step = BLOCK_BYTES // PASSAGE_BYTES
    for i, text in enumerate(texts):
        n = passage_count(len(text))
        for first in range(0, n, step):
            start = first * PASSAGE_BYTES
            end = len(text) if first + step >= n else (first + step) * PASSAGE_BYTES
            if block and size + end - start > BLOCK_BYTES:
                yield block
                block, size = [], 0
            block.append((i, first, start, end))
            size += end - start
    if block:
        yield block


def encoded(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks ``(owners, features)``: one row per passage of the texts, in order; an empty text has one.

    Features are square roots of the shares of pairs of byte classes and of hashed
    lower-case byte triples, how much the triples repeat, the passage's length
    and the text's. A passage's first bytes pair with the end of the one before.
    """
    for block in _slices(texts):
        pieces, owners, lengths = [], [], []
        passage, base = [], 0
        for i, first, start, end in block:
            before = texts[i][max(0, start - 2) : start]
            pieces.append(b"\n" * (2 - len(before)) + before + texts[i][start:end])
            n = max(1, min(passage_count(len(texts[i])) - first, BLOCK_BYTES // PASSAGE_BYTES))
            place = np.minimum(np.arange(-2, end - start) // PASSAGE_BYTES, n - 1) + base
            place[:2] = -1
            passage.append(place)
            owners.append(np.full(n, i))
            lengths.append(np.full(n, len(texts[i])))
            base += n
        raw, place = np.frombuffer(b"".join(pieces), np.uint8), np.concatenate(passage)
        inside = np.flatnonzero(place >= 0)
        place = place[inside]
        kinds, lower = _KIND[raw], _LOWER[raw]
        pair = kinds[inside - 1].astype(np.int64) * _CLASSES + kinds[inside]
        triple = lower[inside] * _MIX[0] + lower[inside - 1] * _MIX[1] + lower[inside - 2] * _MIX[2]
        pairs = np.bincount(place * _PAIRS + pair, minlength=base * _PAIRS).reshape(base, _PAIRS)
        triples = np.bincount(place * _BUCKETS + (triple >> np.uint32(24)), minlength=base * _BUCKETS).reshape(base, _BUCKETS)
        own = np.maximum(pairs.sum(axis=1, keepdims=True), 1)
        features = np.empty((base, FEATURES), np.float32)
        features[:, :_PAIRS] = np.sqrt(pairs / own)
        features[:, _PAIRS : _PAIRS + _BUCKETS] = np.sqrt(triples / own)
        features[:, -3] = ((triples / own) ** 2).sum(axis=1)
        features[:, -2] = pairs.sum(axis=1) / PASSAGE_BYTES
        features[:, -1] = np.log1p(np.concatenate(lengths))
        yield np.concatenate(owners), features


class Model(NamedTuple):
    """Standardisation, embedding, gated attention and classifier."""

    mean: np.ndarray
    scale: np.ndarray
    embed: np.ndarray
    embed_bias: np.ndarray
    tanh: np.ndarray
    gate: np.ndarray
    attend: np.ndarray
    classify: np.ndarray
    bias: np.ndarray


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _embedded(model: Model, features: np.ndarray) -> np.ndarray:
    return np.tanh((features - model.mean) / model.scale @ model.embed + model.embed_bias)


def _attention(model: Model, embedded: np.ndarray) -> np.ndarray:
    """What the softmax over a document's passages is taken of."""
    return (np.tanh(embedded @ model.tanh) * _sigmoid(embedded @ model.gate)) @ model.attend


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    """The score of each text: its passages' embeddings, weighted by attention and classified.

    The softmax is carried from block to block with its largest exponent, so a text
    of any length needs the memory of a block.
    """
    top = np.full(len(texts), -np.inf)
    weight = np.zeros(len(texts))
    summed = np.zeros((len(texts), EMBEDDED))
    for owners, features in encoded(texts):
        embedded = _embedded(model, features).astype(np.float64)
        logits = _attention(model, embedded)
        starts = np.flatnonzero(np.concatenate(([True], owners[1:] != owners[:-1])))
        own = owners[starts]
        new = np.maximum(top[own], np.maximum.reduceat(logits, starts))
        kept = np.exp(top[own] - new)
        share = np.exp(logits - np.repeat(new, np.diff([*starts, len(owners)])))
        weight[own] = weight[own] * kept + np.add.reduceat(share, starts)
        summed[own] = summed[own] * kept[:, None] + np.add.reduceat(share[:, None] * embedded, starts)
        top[own] = new
    return _sigmoid(summed / weight[:, None] @ model.classify + model.bias[0])


def _gradients(model: Model, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy of some documents, in the order of the model's trained fields."""
    sizes = np.diff([*starts, len(x)])
    owner = np.repeat(np.arange(len(starts)), sizes)
    e = np.tanh(x @ model.embed + model.embed_bias)
    t, g = np.tanh(e @ model.tanh), _sigmoid(e @ model.gate)
    logits = (t * g) @ model.attend
    share = np.exp(logits - np.maximum.reduceat(logits, starts)[owner])
    share /= np.add.reduceat(share, starts)[owner]
    z = np.add.reduceat(share[:, None] * e, starts)
    error = (_sigmoid(z @ model.classify + model.bias[0]) - y) / len(y)
    to_z = (error[:, None] * model.classify)[owner]
    to_share = (to_z * e).sum(axis=1)
    to_logit = share * (to_share - np.add.reduceat(share * to_share, starts)[owner])
    inner = to_logit[:, None] * model.attend
    to_tanh, to_gate = inner * g * (1 - t * t), inner * t * g * (1 - g)
    to_e = share[:, None] * to_z + to_tanh @ model.tanh.T + to_gate @ model.gate.T
    before = to_e * (1 - e * e)
    return [x.T @ before, before.sum(axis=0), e.T @ to_tanh, e.T @ to_gate, (t * g).T @ to_logit, z.T @ error, error.sum(keepdims=True)]


def train(bags: list[np.ndarray], y: np.ndarray, seed: int = SEED) -> Model:
    """A model from the features of each document's passages and a label from 0 to 1 for each; by Adam."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(np.float64)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    bags = [((b - mean) / scale) for b in bags]
    sizes = [(FEATURES, EMBEDDED), (EMBEDDED,), (EMBEDDED, GATED), (EMBEDDED, GATED), (GATED,), (EMBEDDED,), (1,)]
    parts = [rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 else rng.normal(0, 0.1, s) if s == (GATED,) else np.zeros(s) for s in sizes]
    first, second = [np.zeros(s) for s in sizes], [np.zeros(s) for s in sizes]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            x = np.concatenate([bags[i] for i in chosen])
            starts = np.cumsum([0, *(len(bags[i]) for i in chosen[:-1])])
            step += 1
            for k, grad in enumerate(_gradients(Model(mean, scale, *parts), x, starts, y[chosen])):
                grad = grad + DECAY * parts[k]
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                parts[k] = parts[k] - RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, *parts)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_documents: int = MAX_DOCUMENTS,
    max_passages: int = MAX_PASSAGES,
) -> Model | None:
    """A model from at most ``max_documents`` labelled rows, chosen by a hash of key and text.

    Of longer texts ``max_passages`` evenly spaced passages are used. Several
    labels of a key count as their mean; null keys and labels teach nothing, null texts
    count as empty. Passages are encoded where the texts are; one task fits the model on
    the bounded sample, and the driver gets the finished model. None without labelled rows.
    """

    @F.arrow_udf("binary")
    def features(texts: pa.Array) -> pa.Array:
        bags = []
        for body in texts:
            bag = np.concatenate([rows for _, rows in encoded([body.as_py() or b""])])
            if len(bag) > max_passages:
                bag = bag[np.linspace(0, len(bag) - 1, max_passages).round().astype(int)]
            bags.append(bag.tobytes())
        return pa.array(bags, pa.binary())

    def learn(batches):
        rows = [row for batch in batches for row in batch.to_pylist()]
        if rows:
            rows.sort(key=lambda row: (row["place"], row["bag"]))
            bags = [np.frombuffer(row["bag"], np.float32).reshape(-1, FEATURES) for row in rows]
            model = train(bags, np.clip([row["y"] for row in rows], 0, 1))
            yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(tuple(model))], pa.binary())})

    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("doc")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    chosen = known.orderBy(F.xxhash64("doc"), "doc").limit(max_documents)
    read = docs.select(F.col(key).alias("doc"), F.col(text).cast("binary").alias("text"))
    # At most max_documents rows of a key and a number each.
    both = read.join(F.broadcast(chosen), "doc")
    bags = both.select(F.xxhash64("doc", "text").alias("place"), "y", features("text").alias("bag"))
    found = bags.orderBy("place", "bag").limit(max_documents).mapInArrow(learn, "model binary").collect()
    return Model(*pickle.loads(found[0].model)) if found else None


def score(text: Column, model: Model | None) -> Column:
    """The score of a whole text from 0 to 1, higher where label 1 is likelier.

    Every passage is encoded, whatever the text's length; null is empty, and an empty
    text is one passage without bytes. Equal texts have equal scores up to rounding. Without
    a model the score is ``NO_SCORE``. Invalid UTF-8 is read as bytes, like any text.
    """

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(scores(model, [t.as_py() or b"" for t in texts]), pa.float64())

    return scored(text.cast("binary")) if model else F.lit(NO_SCORE)
