"""Divergence of sources within a language, by term counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larder.sources import stage, unstage

#: Anything but ASCII letters and characters beyond ASCII parts terms.
BETWEEN_TERMS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS, TOP = 10, 10
SCALE, PRIOR = 1_000_000_000, 2
#: Partial counts that a task holds before it passes them on.
HELD_ROWS = 1 << 20
#: Counts per shard, and cells of a matrix, that are worked on at once.
SHARD_ROWS, BLOCK_ROWS, BLOCK_CELLS = 1 << 20, 1 << 15, 1 << 20
_STEP = 1000  # SCALE is its cube
_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.binary()), ("n", pa.int64()), ("docs", pa.int64())]
)
_FOUND = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.binary()), ("value", pa.int64())]
)


def _batch_counts(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences, and documents, of each term in each group of one batch.

    Documents lie in one batch each, so documents are counted exactly. Every group of
    the batch has a row with an empty term, which no text holds.
    """
    langs, sources = (pc.dictionary_encode(batch.column(c)) for c in ("lang", "source"))
    group = pc.add(pc.multiply(langs.indices.cast(pa.int64()), len(sources.dictionary)), sources.indices.cast(pa.int64()))
    lowered = pc.ascii_lower(batch.column("text").view(pa.string())).view(pa.binary())
    split = pc.split_pattern_regex(lowered, pattern=BETWEEN_TERMS)
    found, owner = split.flatten(), pc.list_parent_indices(split)
    real = pc.greater(pc.binary_length(found), 0)
    terms, owner = pc.dictionary_encode(found.filter(real)), owner.filter(real)
    each = pa.table({"owner": owner, "term": terms.indices})
    each = each.group_by(["owner", "term"], use_threads=False).aggregate([([], "count_all")])
    grouped = pa.table({"group": pc.take(group, each["owner"]), "term": each["term"], "n": each["count_all"]})
    grouped = grouped.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    there = pc.unique(group)
    none = pa.array(np.zeros(len(there), np.int64))
    own = pa.chunked_array([*grouped["group"].chunks, there], pa.int64())
    width = len(sources.dictionary)
    names = pa.chunked_array([*pc.take(terms.dictionary, grouped["term"]).chunks, pa.array([b""] * len(there), pa.binary())], pa.binary())
    columns = [
        pc.take(langs.dictionary, pc.divide(own, width)),
        pc.take(sources.dictionary, pc.subtract(own, pc.multiply(pc.divide(own, width), width))),
        names,
        pa.chunked_array([*grouped["n_sum"].chunks, none], pa.int64()),
        pa.chunked_array([*grouped["n_count"].chunks, none], pa.int64()),
    ]
    return pa.table(columns, schema=_COUNTS)


def _merged(tables: list[pa.Table]) -> pa.Table:
    whole = pa.concat_tables(tables)
    sums = whole.group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([sums[c] for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=_COUNTS)


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts, merged while they fit; what does not fit is passed on as it is."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(_batch_counts(batch))
        if sum(map(len, held)) > HELD_ROWS:
            held = [_merged(held)]
            if len(held[0]) > HELD_ROWS // 4 * 3:
                yield from held.pop().to_batches(max_chunksize=1 << 16)
    if held:
        yield from _merged(held).to_batches(max_chunksize=1 << 16)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents, of each term in each group.

    Each group has a row with an empty term and no count. Null columns count as empty.
    """
    names = {"text": F.col(text).cast("binary"), "lang": F.col(lang).cast("string"), "source": F.col(source).cast("string")}
    empty = {"text": F.lit(b""), "lang": F.lit(""), "source": F.lit("")}
    read = docs.select(*(F.coalesce(c, empty[name]).alias(name) for name, c in names.items()))
    partial = read.mapInArrow(_partial_counts, "lang string, source string, term binary, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probabilities(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + PRIOR) / sum), exact for sums up to 2 ** 53: a long division in three steps."""
    whole, rest = np.divmod(counts + PRIOR, sums)
    for _ in range(3):
        digit, rest = np.divmod(rest * _STEP, sums)
        whole = whole * _STEP + digit
    return whole + 1


class _Shard:
    """The counts of one language in one task: a column for each source, a row for each term."""

    def __init__(self, lang: str):
        self.lang = lang
        self.sources: list[str] = []
        self.sums: list[int] = []
        self.held: list[pa.Table] = []
        self.pairs = self.best = None

    def group(self, source: str, total: int, lang_total: int, terms: int) -> None:
        if source in self.sources:  # known from another shard of the task
            return
        self.sources.append(source)
        self.sums.append(total + PRIOR * terms)
        self.lang_sum = lang_total + PRIOR * terms

    def feed(self, rows: pa.Table) -> None:
        """Rows in the order of their terms; the last term waits, as more of it may come."""
        self.held.append(rows)
        if sum(map(len, self.held)) >= BLOCK_ROWS:
            whole = pa.concat_tables(self.held)
            known = pc.not_equal(whole["term"], whole["term"][-1])
            self._count(whole.filter(known))
            self.held = [whole.filter(pc.invert(known))]

    def _count(self, rows: pa.Table) -> None:
        if not len(rows):
            return
        rows = rows.combine_chunks()
        terms = rows["term"].combine_chunks()
        if isinstance(terms, pa.ChunkedArray):
            terms = pa.concat_arrays(terms.chunks)
        first = np.concatenate(([True], pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)))
        line = np.cumsum(first) - 1
        column = pc.index_in(rows["source"], pa.array(self.sources, pa.string())).to_numpy()
        names = terms.filter(pa.array(first))
        totals = rows["total"].to_numpy()[first]
        n = rows["n"].to_numpy()
        step = max(1, BLOCK_CELLS // len(self.sources))
        for at in range(0, len(names), step):
            own = (line >= at) & (line < at + step)
            matrix = np.zeros((min(step, len(names) - at), len(self.sources)), np.int64)
            matrix[line[own] - at, column[own]] = n[own]
            self._block(names[at : at + step], matrix, totals[at : at + step])

    def _block(self, names: pa.Array, counts: np.ndarray, totals: np.ndarray) -> None:
        p = probabilities(counts, np.array(self.sums, np.int64))
        q = probabilities(totals, np.int64(self.lang_sum))
        for i in range(len(self.sources)):
            own, others = p[:, i : i + 1], p[:, i + 1 :]
            self.pairs[i, i + 1 :] += ((own - others) ** 2 // (own + others)).sum(axis=0)
            above = np.flatnonzero((counts[:, i] > 0) & (p[:, i] > q))
            if not len(above):
                continue
            value = (p[above, i] - q[above]) ** 2 // (p[above, i] + q[above])
            if len(value) > TOP:
                least = np.partition(value, len(value) - TOP)[len(value) - TOP]
                above, value = above[value >= least], value[value >= least]
            found = zip((-value).tolist(), names.take(pa.array(above)).to_pylist(), strict=True)
            self.best[i] = sorted([*self.best[i], *found])[:TOP]

    def start(self) -> None:
        self.pairs = np.zeros((len(self.sources), len(self.sources)), np.int64)
        self.best = [[] for _ in self.sources]

    def results(self) -> pa.RecordBatch:
        if self.pairs is None:
            self.start()
        if self.held:
            self._count(pa.concat_tables(self.held))
        sums = self.pairs + self.pairs.T
        names = [s.encode() for s in self.sources]
        rows = [(s, "pair", names[j], int(sums[i, j])) for i, s in enumerate(self.sources) for j in range(len(names)) if j != i]
        rows += [(s, "term", term, -value) for i, s in enumerate(self.sources) for value, term in self.best[i]]
        columns = list(zip(*rows, strict=True)) or [()] * 4
        arrays = [pa.array([self.lang] * len(rows), pa.string())]
        arrays += [pa.array(c, f.type) for c, f in zip(columns, list(_FOUND)[1:], strict=True)]
        return pa.RecordBatch.from_arrays(arrays, schema=_FOUND)


def _shard_results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per language, sorted: first its groups (without a term), then the counts of all shards in the task."""
    shard = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        places = pc.dictionary_encode(table["lang"]).combine_chunks().indices.to_numpy()
        edges = [0, *(np.flatnonzero(places[1:] != places[:-1]) + 1).tolist(), len(table)]
        for a, b in zip(edges, edges[1:], strict=False):
            if a == b:
                continue
            rows = table.slice(a, b - a)
            lang = rows["lang"][0].as_py()
            if not shard or lang != shard.lang:
                if shard:
                    yield shard.results()
                shard = _Shard(lang)
            groups = rows.filter(rows["term"].is_null())
            for row in groups.to_pylist():
                shard.group(row["source"], row["n"], row["total"], row["terms"])
            if len(groups) < len(rows):
                if shard.pairs is None:
                    shard.start()
                shard.feed(rows.filter(rows["term"].is_valid()).select(["source", "term", "n", "total"]))
    if shard:
        yield shard.results()


def _shards(spark, rows: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // SHARD_ROWS))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how sources of a language differ, and in which terms.

    Terms are runs of ASCII letters and characters beyond ASCII, lower-cased in A-Z; a
    language keeps those in ``min_documents`` of its rows. Each (lang, source) group, and each
    language, gives each kept term the integer probability 1 + floor(10^9 (n + 2) / (N + 2 V)).
    Part ``pair`` holds, for each other source of the language, the sum over kept terms
    of floor((p - q)^2 / (p + q)); part ``term`` the ``TOP`` terms that a source uses
    more than its language does. Ranks go by value, then by item in UTF-8 order.

    Null texts, languages and sources count as empty; a group without terms has the
    prior alone, a language without kept terms 0 for each pair. Repeated rows count each.
    An empty table has no rows. Other columns are not read.

    Tasks count terms in Arrow, so what is shuffled grows with the different terms, not with the
    texts. Kept counts are dealt to shards by term, so a language or source with most
    of the rows is spread; each shard gets the few figures of every group as rows, and
    gives one sum per pair of sources and ``TOP`` terms per source.
    """
    spark = docs.sparkSession
    counts = stage(term_counts(docs, text, lang, source), "term-counts")
    real = counts.where(F.length("term") > 0)
    sums = real.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = sums.where(F.col("docs") >= min_documents).drop("docs")
    cells = stage(real.drop("docs").join(kept, ["lang", "term"]), "kept-counts")
    in_lang = cells.groupBy("lang", "term").agg(F.first("total").alias("total"))
    in_lang = in_lang.groupBy("lang").agg(F.sum("total").alias("total"), F.count("*").alias("terms"))
    in_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    there = counts.where(F.length("term") == 0).select("lang", "source")
    groups = there.join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left").na.fill(0, ["n", "total", "terms"])
    shards = _shards(spark, cells.count())
    none = F.lit(None)
    heads = groups.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "lang", "source",
        none.cast("binary").alias("term"), "n", "total", "terms",
    )
    shard = F.pmod(F.xxhash64("lang", "term"), F.lit(shards)).cast("int").alias("shard")
    rows = heads.unionByName(cells.select(shard, "lang", "source", "term", "n", "total", F.lit(0).cast("long").alias("terms")))
    dealt = rows.repartition(shards, "shard").sortWithinPartitions("lang", F.asc_nulls_first("term"), "source")
    found = dealt.mapInArrow(_shard_results, "lang string, source string, part string, item binary, value long")
    found = stage(found, "divergences")
    unstage(counts, cells)
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    terms = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    both = ranked.unionByName(terms)
    return both.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")


def oracle_sql() -> str:
    """DuckDB SQL of ``audit`` over ``documents``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    p = "1 + ({scale}::hugeint * ({n} + {prior})) // ({total} + {prior} * {terms})"
    group_p = p.format(scale=SCALE, prior=PRIOR, n="coalesce(c.n, 0)", total="g.n", terms="k.terms")
    lang_p = p.format(scale=SCALE, prior=PRIOR, n="t.total", total="k.total", terms="k.terms")
    distance = "(a.p - {q}) * (a.p - {q}) // (a.p + {q})"
    return f"""
with read as (
  select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as terms
  from documents
), words as (select row, lang, source, unnest(terms) as term from read),
counts as (select lang, source, term, count(*) as n from words group by all),
kept as (
  select lang, term, count(*) as total from words group by all having count(distinct row) >= {MIN_DOCUMENTS}
), langs as (select lang, sum(total) as total, count(*) as terms from kept group by all),
there as (select distinct lang, source from read),
groups as (
  select h.lang, h.source, coalesce(sum(c.n), 0) as n
  from there h left join (select * from counts semi join kept using (lang, term)) c using (lang, source) group by all
), cells as (
  select g.lang, g.source, t.term, coalesce(c.n, 0) as n, {group_p} as p, {lang_p} as q
  from groups g join kept t using (lang) join langs k using (lang) left join counts c using (lang, source, term)
), sums as (
  select a.lang, a.source, b.source as item, sum({distance.format(q="b.p")}) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
), found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from there a join there b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
  union all
  select lang, source, 'term', term, {distance.format(q="a.q")} from cells a where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found
)
select lang, source, part, item, value::bigint as value, rank::int as rank from ranked where part = 'pair' or rank <= {TOP}"""
