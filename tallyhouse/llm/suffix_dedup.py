"""Removal of byte strings that stand anywhere else, by interval expansion on Burrows-Wheeler transforms.

Every string of LENGTH bytes holds an anchor: the 32 bytes in it whose hash is least, the first of equals. Equal strings
have equal anchors, so strings can only recur among the runs of starts that share an anchor. Copies of a text, and equal
segments (runs with their LENGTH - 1 following bytes) within a text, recur for certain and are told at once; one of each
goes on. For each anchor that is left in two places or more, the segments meet in one task; equal ones are counted before. Of
a string over an anchor, at least half of the other bytes stand on one side of it, so a segment goes on only if another
one of its anchor has the same bytes on a side. A task joins segments to blocks of bounded size, builds the Burrows-Wheeler
transform of a block and finds common prefixes by extending intervals backwards, breadth first: depth by depth the
boundaries between suffixes with that many bytes in common are marked, until depth LENGTH. Suffixes whose boundary is still
unmarked have LENGTH bytes in common. An anchor with very many different segments is split by the bytes on either side of it,
then by further anchors.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, stored, text_or_empty, without

LENGTH = 400
GRAM = 32
# Starts looked at together in a long text, bytes of a block, and different segments of an anchor (some 600 bytes each, at
# most 768) before it is split.
CHUNK = 1 << 20
BLOCK_BYTES = 2 << 20
SEGMENTS = 6000
LEVELS = 5
# Segments that a task of the last stage takes (some 600 bytes each).
TASK_SEGMENTS = 100_000
MULTIPLIERS = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]

OCCURRENCE_ARROW = pa.schema([
    ("digest", pa.binary()), ("copies", pa.int64()), ("start", pa.int64()), ("anchor", pa.int64()),
    ("place", pa.int64()), ("segment", pa.binary()), ("content", pa.binary()),
])
OCCURRENCE = "digest binary, copies long, start long, anchor long, place long, segment binary, content binary"
SPANS = "array<struct<a:bigint,b:bigint>>"


def gram_hashes(data: bytes, level: int) -> np.ndarray:
    """A hash of the GRAM bytes from each place on; each level has a hash of its own."""
    raw = np.frombuffer(data, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(raw, 8).copy().view("<u8").ravel()
    n = len(raw) - GRAM + 1
    h = np.full(n, 1 + level, np.uint64) * MULTIPLIERS[1]
    for k, m in enumerate(MULTIPLIERS):
        h ^= words[8 * k : 8 * k + n]
        h *= m
        h ^= h >> np.uint64(29)
    return h


def runs(data: bytes, level: int = 0, length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor, first start, number of starts, place of the anchor) of each run of starts whose strings have the same anchor
    in one place; chunk by chunk."""
    for at in range(0, len(data) - length + 1, CHUNK):
        h = gram_hashes(data[at : at + CHUNK + length - 1], level)
        # The place in the low bits makes the first of equal hashes the least.
        least = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
        width, size = length - GRAM + 1, 1
        while size * 2 <= width:
            least = np.minimum(least[: len(least) - size], least[size:])
            size *= 2
        n = len(h) - width + 1
        least = np.minimum(least[:n], least[width - size : width - size + n])
        place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        yield h[place[first]].view(np.int64), first + at, np.diff(np.append(first, n)), place[first] + at


def own_runs(data: bytes, length: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int]]]:
    """(anchor, first start, number of starts, place of the anchor, times) of each different segment of a text, and the ranges
    of starts whose segments stand in the text more than once.

    A text of a short period has as many segments as starts, but few different ones.
    """
    known: dict[tuple[int, bytes], list] = {}
    found, again = [], []
    for anchors, firsts, counts, places in runs(data, 0, length):
        for run in zip(anchors.tolist(), firsts.tolist(), counts.tolist(), places.tolist(), strict=True):
            key = (run[0], run[2], run[3] - run[1])
            held = known.get(key)
            if held is None:
                known[key] = [len(found)]
                found.append([*run, 1])
                continue
            segment = data[run[1] : run[1] + run[2] + length - 1]
            for k in held:
                first = found[k][1]
                if data[first : first + len(segment)] == segment:
                    found[k][4] += 1
                    again += [(first, first + run[2]), (run[1], run[1] + run[2])]
                    if len(again) > 10_000:
                        again = merged_ranges(again)
                    break
            else:
                held.append(len(found))
                found.append([*run, 1])
    return [tuple(f) for f in found], merged_ranges(again)


def merged_ranges(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def half_shared(segments: list[bytes], places: list[int], length: int) -> list[bool]:
    """Of segments of one anchor, `places` in them, which share half a string's other bytes on a side of it with another."""
    half = (length - GRAM) // 2
    left = [hash(s[p - half : p]) if p >= half else None for s, p in zip(segments, places, strict=True)]
    right = [hash(s[p + GRAM : p + GRAM + half]) if p + GRAM + half <= len(s) else None for s, p in zip(segments, places, strict=True)]
    lefts, rights = Counter(left), Counter(right)
    return [x is not None and lefts[x] > 1 or y is not None and rights[y] > 1 for x, y in zip(left, right, strict=True)]


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """The rotations of t, sorted by their first `depth` symbols at least (symbols below 512)."""
    n = len(t)
    key, reach = np.zeros(n, np.int64), 7
    for k in range(reach):
        key = key << 9 | np.roll(t, -k)
    order = np.argsort(key)
    first = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    begin = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = begin
    while reach < depth:
        alone = first & np.append(first[1:], True)
        left = order[~alone]  # in sorted order; only these can change
        if not len(left):
            break
        key = rank[left] * n + rank[(left + reach) % n]
        by = np.argsort(key)
        left, key = left[by], key[by]
        slots = np.flatnonzero(~alone)
        order[slots] = left
        new = np.concatenate([[True], key[1:] != key[:-1]])
        first[slots] = new
        rank[left] = np.maximum.accumulate(np.where(new, slots, 0))
        reach *= 2
    return order


class Wavelet:
    """A wavelet matrix: the symbols in a range, each with its backward extension, for many ranges at once."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.bits, current = [], symbols
        for bit in reversed(range(max(1, int(size - 1).bit_length()))):
            one = (current >> bit & 1).astype(bool)
            self.bits.append(np.concatenate([[0], np.cumsum(~one)]).astype(np.int32))
            current = np.concatenate([current[~one], current[one]])
        starts = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.shift = np.zeros(1 << len(self.bits), np.int64)
        symbol, low, _ = self.leaves(np.array([0]), np.array([len(symbols)]))
        self.shift[symbol] = starts[symbol] - low

    def leaves(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        symbol = np.zeros(len(low), np.int64)
        for zeros in self.bits:
            a, b, z = zeros[low].astype(np.int64), zeros[high].astype(np.int64), int(zeros[-1])
            c, d = low - a + z, high - b + z
            some0, some1 = b > a, d > c
            symbol = np.concatenate([symbol[some0] << 1, symbol[some1] << 1 | 1])
            low, high = np.concatenate([a[some0], c[some1]]), np.concatenate([b[some0], d[some1]])
        return symbol, low, high

    def extended(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ranges of c + w for the range of each w and each symbol c before it."""
        symbol, a, b = self.leaves(low, high)
        return a + self.shift[symbol], b + self.shift[symbol]


def shared_prefixes(t: np.ndarray, length: int) -> np.ndarray:
    """For each place of t, whether `length` symbols from it on (around the end) stand in another place too."""
    n = len(t)
    order = suffix_order(t, length)
    wavelet = Wavelet(t[order - 1], int(t.max()) + 1)
    # marked[i]: the suffixes before and at rank i have fewer than `length` symbols in common.
    marked = np.zeros(n + 1, bool)
    marked[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        low, high = wavelet.extended(low, high)
        new = ~marked[high]
        new[high == n] = False
        # The last symbol's range ends at n, which is marked from the start but must be extended all the same.
        keep = new | (high == n)
        low, high = low[keep], high[keep]
        marked[high] = True
        if marked.all():
            break
    common = ~marked
    out = np.zeros(n, bool)
    at = np.flatnonzero(common)
    out[order[at]] = True
    out[order[at - 1]] = True
    return out


def block_spans(segments: list[bytes], copies: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per segment the ranges [a, b) of starts whose `length` bytes stand in another place too."""
    used = np.unique(np.frombuffer(b"".join(segments), np.uint8))
    code = np.zeros(256, np.int16)
    code[used] = np.arange(1, len(used) + 1)  # 0 parts segments
    t = np.concatenate([x for s in segments for x in (code[np.frombuffer(s, np.uint8)], np.zeros(1, np.int16))])
    common = shared_prefixes(t.astype(np.int64), length)
    out, at = [], 0
    for s, n in zip(segments, copies, strict=True):
        starts = len(s) - length + 1
        flag = np.ones(starts, bool) if n > 1 else common[at : at + starts]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.view(np.int8), [0]])))
        out.append(list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)))
        at += len(s) + 1
    return out


def occurrences(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), OCCURRENCE_ARROW, strict=True)], schema=OCCURRENCE_ARROW)

    for digest, copies, start, anchor, place, segment in rows:
        held.append((digest, copies, start, anchor, place, segment, hashlib.blake2b(segment, digest_size=16).digest()))
        size += len(segment)
        if size > 4 << 20:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def mixed(parent: int, anchors: np.ndarray) -> np.ndarray:
    """Anchors of a further level together with the one they split."""
    both = anchors.view(np.uint64) ^ (np.uint64(parent & (1 << 64) - 1) * MULTIPLIERS[0])
    return (both * MULTIPLIERS[2]).view(np.int64)


def sides(anchor: int, place: int, data: bytes, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(key, first, last, place) of the two parts of a segment's starts: strings with half their other bytes before the anchor
    and those with half behind it. Equal strings have the same bytes there, so they have equal keys."""
    half = (length - GRAM) // 2
    last = len(data) - length
    for side, first, end, at in ((b"<", 0, min(last, place - half), place - half), (b">", max(0, place - half), last, place + GRAM)):
        if first <= end:
            key = hashlib.blake2b(side + anchor.to_bytes(8, "little", signed=True) + data[at : at + half], digest_size=8).digest()
            yield int.from_bytes(key, "little", signed=True), first, end, place - first


def split_anchors(found: DataFrame, length: int) -> DataFrame:
    """The occurrences, those of anchors with over SEGMENTS different segments dealt to keys of further levels.

    The first level's keys are an anchor with the bytes on one side of it, at most two a segment; then come anchors by other
    hashes. The last level's key is the string itself, so that what is left together there are equal segments.
    """
    done = None
    for level in range(1, LEVELS + 1):
        counts = found.select("anchor", "content").distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
        hot = stored(counts.filter(F.col("n") > SEGMENTS).select("anchor"))
        if hot.isEmpty():
            break
        rest = found.join(hot, "anchor", "left_anti").select(found.columns)

        def split(it, level=level):
            def rows():
                for batch in it:
                    for digest, copies, start, anchor, place, data, _ in zip(*[batch.column(c) for c in OCCURRENCE_ARROW.names], strict=True):
                        data, at = data.as_py(), start.as_py()
                        if level == 1:
                            for key, first, last, own in sides(anchor.as_py(), place.as_py(), data, length):
                                yield digest.as_py(), copies.as_py(), at + first, key, own, data[first : last + length]
                            continue
                        if level == LEVELS:
                            for i in range(len(data) - length + 1):
                                own = data[i : i + length]
                                key = int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "little", signed=True)
                                yield digest.as_py(), copies.as_py(), at + i, key, 0, own
                            continue
                        for anchors, *rest in runs(data, level - 1, length):
                            for a, f, c, p in zip(mixed(anchor.as_py(), anchors).tolist(), *[x.tolist() for x in rest], strict=True):
                                yield digest.as_py(), copies.as_py(), at + f, a, p - f, data[f : f + c + length - 1]
            return occurrences(rows())

        further = found.join(hot, "anchor", "left_semi").select(found.columns).mapInArrow(split, OCCURRENCE)
        done = rest if done is None else done.unionByName(rest)
        found = stored(further)
    return found if done is None else done.unionByName(found)


def recurring(df: DataFrame, text: str, digest: str, length: int = LENGTH) -> DataFrame:
    """(digest, spans): per text with a string that recurs, the ranges [a, b) of starts of such strings, in any order."""
    texts = df.select(F.col(digest).alias("digest"), text_or_empty(text).cast("binary").alias("data"))
    names = ["anchor", "first", "count", "place", "times"]
    ranges = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def anchors(it):
        for batch in it:
            each = [own_runs(d.as_py(), length) for d in batch.column("data")]
            columns = [pa.array([[r[k] for r in found] for found, _ in each], pa.list_(pa.int64())) for k in range(len(names))]
            spans = pa.array([[{"a": a, "b": b} for a, b in known] for _, known in each], ranges)
            starts = pa.array([len(d.as_py()) - length + 1 for d in batch.column("data")], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *columns, spans, starts], names=["digest", *names, "known", "starts"])

    kinds = f"digest binary, {', '.join(f'{c} array<long>' for c in names)}, known {SPANS}, starts long"
    looked = texts.filter(F.octet_length("data") >= length).mapInArrow(anchors, kinds)
    # Copies of a text count once from here on.
    one = stored(looked.groupBy("digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first(F.struct(*names, "known", "starts")).alias("r")))
    each = one.select("digest", "copies", F.explode(F.arrays_zip(*[F.col(f"r.{c}") for c in names])).alias("r")).select(
        "digest", "copies", "r.*")
    often = each.select("anchor").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    # Written, so that the join below shuffles both sides itself and adaptive execution can split a common line's anchor.
    often = stored(often.filter("n > 1").select("anchor"))
    met = each.join(often, "anchor")
    wanted = met.groupBy("digest").agg(F.max("copies").alias("copies"), F.collect_list(F.struct(*names)).alias("runs"))
    once = texts.groupBy("digest").agg(F.first("data").alias("data"))

    def segments(it):
        def rows():
            for batch in it:
                for digest, data, copies, own in zip(*[batch.column(c) for c in ("digest", "data", "copies", "runs")], strict=True):
                    data = data.as_py()
                    for r in own.as_py():
                        segment = data[r["first"] : r["first"] + r["count"] + length - 1]
                        yield digest.as_py(), copies.as_py() * r["times"], r["first"], r["anchor"], r["place"] - r["first"], segment
        return occurrences(rows())

    found = stored(once.join(wanted, "digest").select("digest", "data", "copies", "runs").mapInArrow(segments, OCCURRENCE))
    found = split_anchors(found, length)

    def blocks(it):
        out: list[tuple] = []
        block: list[tuple] = []
        group: list[tuple] = []
        size = 0

        def chosen():
            """The group's segments: those that may share a string go into the block, of the others copies recur as a whole."""
            for row, goes in zip(group, half_shared([r[2] for r in group], [r[4] for r in group], length), strict=True):
                if goes:
                    block.append(row)
                elif row[3] > 1:
                    out.append((row[0], row[1], [(0, len(row[2]) - length + 1)]))
            group.clear()

        def searched():
            spans = block_spans([r[2] for r in block], [r[3] for r in block], length)
            out.extend((r[0], r[1], s) for r, s in zip(block, spans, strict=True) if s)
            block.clear()

        def batch():
            rows = [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary()),
                    pa.array([[{"a": a, "b": b} for a, b in o[2]] for o in out], ranges)]
            out.clear()
            return pa.RecordBatch.from_arrays(rows, names=["anchor", "content", "spans"])

        for rows in it:
            for row in zip(*[rows.column(c).to_pylist() for c in ("anchor", "content", "segment", "copies", "place")], strict=True):
                if group and row[0] != group[-1][0]:
                    chosen()
                    size = sum(len(r[2]) for r in block) if block else 0
                    if size > BLOCK_BYTES:
                        searched()
                    if len(out) > 4096:
                        yield batch()
                group.append(row)
        chosen()
        if block:
            searched()
        if out:
            yield batch()

    distinct = found.groupBy("anchor", "content").agg(
        F.first("segment").alias("segment"), F.sum("copies").alias("copies"), F.first("place").alias("place"))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), found.count() // TASK_SEGMENTS)
    shared = distinct.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(
        blocks, f"anchor long, content binary, spans {SPANS}")
    spans = found.select("digest", "start", "anchor", "content").join(shared, ["anchor", "content"]).select(
        "digest", F.explode("spans").alias("s"), "start").select(
        "digest", (F.col("start") + F.col("s.a")).alias("a"), (F.col("start") + F.col("s.b")).alias("b"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("r.starts").alias("b")))
    known = one.select("digest", F.explode(F.when(F.col("copies") > 1, whole).otherwise(F.col("r.known"))).alias("s")).select("digest", "s.*")
    return spans.unionByName(known).groupBy("digest").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def cut(data: bytes, spans: list[dict] | None, length: int) -> tuple[bytes, list[tuple[int, int]]]:
    """The bytes that no recurring string covers, and the maximal ranges taken out."""
    gone = merged_ranges([(s["a"], s["b"] + length - 1) for s in spans or ()])
    out, at = [], 0
    for a, b in gone:
        out.append(data[at:a])
        at = b
    return b"".join(out) + data[at:], gone


CUT_TYPE = T.StructType([
    T.StructField("kept_bytes", T.BinaryType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])))])
CUT_ARROW = pa.struct([("kept_bytes", pa.binary()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def deduplicated(df: DataFrame, text: str = "text", length: int = LENGTH, keep: list[str] | None = None) -> DataFrame:
    """The rows with `n_bytes`, `n_removed`, `n_spans`, `removed` (start and end of each maximal range taken out, in bytes) and
    `kept_bytes`, the text's UTF-8 bytes without recurring strings.

    A byte goes if a string of `length` bytes over it starts anywhere else too, in the same document or another; copies of
    a document are others. Null texts count as empty; texts under `length` bytes stay whole. Bytes may be cut within a
    character. An empty table stays empty. Input columns of those names are replaced. `keep`: the input columns to
    return, all by default. Texts are told apart by their SHA-256.
    """
    added = ("n_bytes", "n_removed", "n_spans", "removed", "kept_bytes")
    rows = without(df, *added)
    kept = [c for c in rows.columns if keep is None or c in keep]
    digest, data, other, spans, done = (fresh(c, rows.columns) for c in ("digest", "data", "found_digest", "spans", "cut"))
    marked = rows.withColumn(data, text_or_empty(text).cast("binary")).withColumn(digest, F.unhex(F.sha2(data, 256)))
    found = recurring(marked, text, digest, length).select(F.col("digest").alias(other), F.col("spans").alias(spans))

    def cut_all(texts: pa.Array, spans: pa.Array) -> pa.Array:
        each = [cut(t.as_py(), s.as_py(), length) for t, s in zip(texts, spans, strict=True)]
        return pa.array([{"kept_bytes": k, "removed": [{"start": a, "end": b} for a, b in gone]} for k, gone in each], CUT_ARROW)

    joined = marked.select(*kept, data, digest).join(found, F.col(digest) == F.col(other), "left")
    out = joined.withColumn(done, F.arrow_udf(cut_all, CUT_TYPE)(F.col(data), F.col(spans)))
    return out.select(
        *kept, F.octet_length(data).cast("long").alias("n_bytes"),
        (F.octet_length(data) - F.octet_length(f"{done}.kept_bytes")).cast("long").alias("n_removed"),
        F.size(f"{done}.removed").cast("long").alias("n_spans"), f"{done}.removed", f"{done}.kept_bytes")
