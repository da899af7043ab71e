"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import re
from collections import Counter
from os.path import commonprefix

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text: str | None) -> int:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64(" ".join(words[i : i + 3]).encode(), seed=42).intdigest() for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints: list[int], distance: int) -> list[int]:
    """The smallest index reachable over links of at most ``distance`` bits."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def duplicated_bytes(texts: list[bytes], length: int) -> list[tuple[set[int], set[int]]]:
    """For each text the bytes in strings that start anywhere else, and in strings that start earlier."""
    seen: dict[bytes, list[tuple[int, int]]] = {}
    for row, text in enumerate(texts):
        for at in range(len(text) - length + 1):
            seen.setdefault(text[at : at + length], []).append((row, at))
    anywhere, earlier = [set() for _ in texts], [set() for _ in texts]
    for places in seen.values():
        for i, (row, at) in enumerate(places):
            if len(places) > 1:
                anywhere[row].update(range(at, at + length))
            if i:
                earlier[row].update(range(at, at + length))
    return list(zip(anywhere, earlier, strict=True))


def runs(places: set[int]) -> list[tuple[int, int]]:
    edges = sorted(p for p in places if p - 1 not in places), sorted(p + 1 for p in places if p + 1 not in places)
    return list(zip(*edges, strict=True))


def edit_distance(a: str, b: str) -> int:
    a, b = a.removeprefix(start := commonprefix([a, b])), b.removeprefix(start)
    end = len(commonprefix([a[::-1], b[::-1]]))
    a, b = a[: len(a) - end], b[: len(b) - end]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def similar_pairs(lines: list[str], similarity: float) -> list[tuple[int, int]]:
    """All pairs of places whose lines are similar, each compared with each of a length that allows it."""
    grams = [Counter(x[k : k + 5] for k in range(len(x) - 4)) for x in lines]
    order = sorted(range(len(lines)), key=lambda i: len(lines[i]))
    found = []
    for at, i in enumerate(order):
        most = int(len(lines[i]) * (1 - similarity) + 1e-9)
        for j in reversed(order[:at]):
            if len(lines[i]) - len(lines[j]) > most:
                break
            # An edit changes five strings of five characters at most.
            common = sum(min(n, grams[j][g]) for g, n in grams[i].items() if g in grams[j])
            if grams[i].total() + grams[j].total() - 2 * common <= 10 * most and edit_distance(lines[i], lines[j]) <= most:
                found.append((i, j))
    return found


def normal(line: str) -> str:
    return " ".join(WORD.findall(line.lower()))


def kept_lines(docs: list[tuple[int, str | None]], min_chars: int, similarity: float) -> dict[int, str | None]:
    """Texts without the lines that repeat or resemble an earlier one, by edit similarity alone."""
    norms: dict[str, tuple] = {}
    for doc, text in sorted(docs):
        for pos, line in enumerate((text or "").split("\n")):
            if normal(line):
                norms.setdefault(normal(line), (doc, pos))
    names = list(norms)
    root = list(range(len(names)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    long = [i for i, name in enumerate(names) if len(name) >= min_chars]
    for i, j in similar_pairs([names[i] for i in long], similarity):
        a, b = find(long[i]), find(long[j])
        root[max(a, b)] = min(a, b)
    stays = {norms[names[find(i)]] for i in range(len(names))}
    result = {}
    for doc, text in docs:
        if text is None:
            result[doc] = None
            continue
        lines = enumerate(text.split("\n"))
        result[doc] = "\n".join(line for pos, line in lines if not normal(line) or (doc, pos) in stays)
    return result
