"""Runs of words that repeat with a period, by descending-LCP Kruskal.

A run is a stretch whose words equal those one period further on, for its smallest period, and which no neighbouring
word extends; it counts if it is so many periods and so many words long. The suffixes of a text that have the fewest words
in common that a run needs are sorted, and neighbours in that order are edges weighted by their common prefix (LCP).
Classes of suffixes are united by decreasing LCP with union-find; each keeps its places in order. When classes meet at LCP
l, places that become neighbours at a distance d have exactly l words in common, so if d fits into l often enough, the
stretch of d + l words from the first one has the period d. d is the smallest, for a smaller one would have put another
place of the class in between. With another word before the first place than before the second, the stretch is a run; the
first two periods of every run meet in this way, so each run is found once.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import BLANK, fresh, text_or_empty, without

LEAST_POWER = 4
LEAST_LENGTH = 6
MIX = np.uint64(0x9E3779B97F4A7C15)
RUN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def needed(power: int, length: int) -> int:
    """The fewest words that the suffixes at the first two periods of a run have in common."""
    return min(max(length, power * q) - q for q in range(1, max(length, 1) + 1))


def recur(words: list[bytes], gram: int) -> bool:
    """Whether any `gram` words seem to stand in two places: never false if they do."""
    if len(words) <= gram:
        return False
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(h) - gram + 1
    mixed = np.zeros(n, np.uint64)
    for k in range(gram):
        mixed = mixed * MIX + h[k : k + n]
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def suffix_order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, whether one begins with other words than the one before, looked at 3 words deep).

    By prefix doubling; `codes` are from 1 on, and only suffixes that are not yet told apart are sorted again.
    """
    n = len(codes)
    padded = np.concatenate([codes, np.zeros(3, np.int64)])
    bits = int(codes.max()).bit_length()
    if 3 * bits < 63:
        reach, key = 3, padded[:n] << 2 * bits | padded[1 : n + 1] << bits | padded[2 : n + 2]
    else:
        reach, key = 1, padded[:n]
    order = np.argsort(key, kind="stable")
    first = np.ones(n, bool)
    first[1:] = key[order][1:] != key[order][:-1]
    shallow = first.copy() if reach == 3 else None
    rank = np.zeros(n + 1, np.int64)  # that of the empty suffix is 0
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(1, n + 1), 0))
    while True:
        alone = first & np.append(first[1:], True)
        slots = np.flatnonzero(~alone)
        if not len(slots):
            return order, shallow if shallow is not None else np.zeros(n, bool)
        left = order[slots]
        key = rank[left] * (n + 1) + rank[np.minimum(left + reach, n)]
        by = np.argsort(key, kind="stable")
        left, key = left[by], key[by]
        order[slots] = left
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        first[slots] = new
        rank[left] = np.maximum.accumulate(np.where(new, slots + 1, 0))
        reach *= 2


def common_prefixes(codes: np.ndarray, order: np.ndarray, apart: np.ndarray, gram: int) -> list[tuple[int, int, int]]:
    """(LCP, place, place before it in order), for LCPs from `gram` on, greatest first.

    In text order an LCP is at most one less than that of the place before, so words are compared once.
    """
    before = np.full(len(order), -1, np.int64)
    before[order[1:]] = np.where(apart[1:], -1, order[:-1])
    words, edges, h = [*codes.tolist(), 0], [], 0
    for i, j in enumerate(before.tolist()):
        if j < 0:
            h = 0
            continue
        while words[i + h] == words[j + h]:
            h += 1
        if h >= gram:
            edges.append((h, i, j))
        h = max(h - 1, 0)
    edges.sort(key=lambda e: -e[0])
    return edges


def united(edges: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(LCP, place, place after it) whenever two places become neighbours in a class."""
    parent: dict[int, int] = {}
    places: dict[int, list[int]] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for lcp, i, j in edges:
        i, j = root(i), root(j)
        large, small = places.pop(i, None) or [i], places.pop(j, None) or [j]
        if len(large) < len(small):
            i, large, j, small = j, small, i, large
        parent[j] = i
        places[i] = large
        at = [bisect_left(large, x) for x in small]
        for k, (x, a) in enumerate(zip(small, at, strict=True)):
            if a and (k == 0 or small[k - 1] < large[a - 1]):
                yield lcp, large[a - 1], x
            if a < len(large) and (k == len(small) - 1 or large[a] < small[k + 1]):
                yield lcp, x, large[a]
        if 32 * len(small) < len(large):
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()


def runs_of(words: list[bytes], power: int = LEAST_POWER, length: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run of at least `power` periods and `length` words, by start and period."""
    gram = needed(power, length)
    if not recur(words, gram):
        return []
    known: dict[bytes, int] = {}
    codes = np.array([known.setdefault(w, len(known) + 1) for w in words], np.int64)
    order, apart = suffix_order(codes)
    if gram < 3:  # suffixes apart within 3 words may still have so few in common
        apart[:] = False
    out = []
    for lcp, a, b in united(common_prefixes(codes, order, apart, gram)):
        period = b - a
        if period * (power - 1) <= lcp and lcp + period >= length and (a == 0 or codes[a - 1] != codes[b - 1]):
            out.append((a, lcp + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that stand in a run after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def with_runs(df: DataFrame, text: str = "text", power: int = LEAST_POWER, length: int = LEAST_LENGTH,
              keep: list[str] | None = None) -> DataFrame:
    """The rows with `n_words`, `runs` (start, length, period by start and period, in words from 0) and `collapsed`, the words
    joined by one space without those of a run after its first period.

    `power` is at least 2. Words part at ASCII white space. Null and empty texts have no words and no runs, and an empty text
    for `collapsed`. Texts of any length are looked at whole; each is one task's work, in memory of some hundred bytes a word
    if it repeats itself. Rows are looked at one by one, so repeated rows give equal results; an empty table stays empty.
    Input columns of those names are replaced. `keep`: the input columns to return, all by default.
    """
    if power < 2:
        raise ValueError("a run has two periods at least")
    rows = without(df, "n_words", "runs", "collapsed")
    kept = [c for c in rows.columns if keep is None or c in keep]
    types = (pa.int64(), RUN_ARROW, pa.string())
    schema = T.StructType([
        *[rows.schema[c] for c in kept], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType())])

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out = []
            for t in batch.column(len(kept)):
                words = (t.as_py() or b"").split()
                runs = runs_of(words, power, length)
                found = [{"start": s, "length": n, "period": q} for s, n, q in runs]
                out.append((len(words), found, b" ".join(collapsed(words, runs)).decode()))
            new = zip(*out, strict=True) if out else ((), (), ())
            columns = [*batch.columns[: len(kept)], *[pa.array(c, t) for c, t in zip(new, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    data = fresh("data", rows.columns)
    return rows.select(*kept, F.col(text).cast("binary").alias(data)).mapInArrow(look, schema)


def stretched(text: str = "text", doc_id: str = "doc_id") -> Column:
    """The text, in a tenth of documents (by the CRC-32 h of the id) with its words from a place on repeated with a period.

    Of n words, those from a = (h div 10) mod n on become word a + (i - a) mod p, for p = 1 + (n - a) div (3 + (h div 10) mod 8),
    and words are joined by a space. A null id leaves the text as it is.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    words = F.filter(F.split(text_or_empty(text), f"{BLANK}+"), lambda w: w != "")
    g = F.floor(h / 10).cast("long")
    return F.when((h % 10 == 0) & F.col(doc_id).isNotNull(), _repeated(words, g)).otherwise(F.col(text))


def _repeated(words: Column, g: Column) -> Column:
    """One array of one struct binds the words once; the rest are expressions of it."""
    bound = F.array(F.struct(words.alias("w"), g.alias("g")))

    def repeat(s):
        n = F.size(s["w"]).cast("long")
        a = s["g"] % n
        p = 1 + F.floor((n - a) / (3 + s["g"] % 8)).cast("long")
        return F.array_join(F.transform(s["w"], lambda x, i: F.when(i < a, x).otherwise(
            F.get(s["w"], (a + (i.cast("long") - a) % p).cast("int")))), " ")

    return F.get(F.transform(bound, repeat), F.lit(0))
