"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments. Fingerprints that differ in three bits or fewer differ in at most
one bit of one segment, so they share one of its 32 variants in which one bit is blotted out. Variants meet by an equality
exchange; every meeting is verified on the whole fingerprints. A variant that very many fingerprints share is
cut once more in the same way (the rest of the fingerprint into 16-bit, then 8-bit segments), which bounds what one task
compares without dropping a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, stored, without

SEED = 42
FAR = 3
# Fingerprints compared with one another in one place; larger groups are cut once more.
GROUP = 2048
BLOCK = 8192
MAX_LEVEL = 2


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 bits: each is 1 if over half of the shingles' hashes have it set.

    Words part at ASCII white space, A-Z become lower case. Fewer than `width` words make one shingle; none make 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=starts[1:])
    lows, highs = starts[:-width].tolist(), (starts[width:] - 1).tolist()
    n, votes, digest = len(lows), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        spans = zip(lows[at : at + BLOCK], highs[at : at + BLOCK], strict=True)
        h = np.array([digest(line[a:b], SEED) for a, b in spans], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprints(text: pa.Array) -> pa.Array:
    return pa.array(np.array([fingerprint(t.as_py()) for t in text], np.uint64).view(np.int64))


def fingerprint_of(text: str = "text") -> Column:
    """The fingerprint as a signed number; a null text counts as empty."""
    return fingerprints(F.col(text))


def variants(groups: DataFrame, level: int) -> DataFrame:
    """(key, fp, low) for each one-wildcard variant of the two halves of the bits that `key` leaves free.

    Those are `64 >> level` bits from bit `low` on; in the result, the half that the new key leaves free. Blotted bits
    stay free as well, but three of them need no further cut.
    """
    width = 32 >> level
    masks = F.expr(f"""
        explode(transform(sequence(0, {2 * width - 1}), j -> named_struct(
            'j', j,
            'low', low + {width} * (j div {width}),
            'rest', low + {width} * (1 - j div {width}),
            'part', shiftrightunsigned(fp, low + {width} * (j div {width}))
                    & ({(1 << width) - 1}L & ~shiftleft(1L, j % {width})))))
    """)
    v = groups.select("key", "fp", masks.alias("v"))
    if level == 0:
        key = F.shiftleft(F.col("v.j").cast("bigint"), 32).bitwiseOR(F.col("v.part"))
    else:
        key = F.xxhash64("key", "v.j", "v.part")
    return v.select(key.alias("key"), "fp", F.col("v.rest").alias("low"))


def union_of(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least member of each of n members' components under the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def forest(keys: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between fingerprints of one key, sorted by key: enough to connect all that are near."""
    links_a, links_b = [], []
    at = np.arange(len(keys))
    shift = 1
    while True:
        at = at[at + shift < len(keys)]
        at = at[keys[at] == keys[at + shift]]
        if not len(at):
            break
        near = at[np.bitwise_count(prints[at] ^ prints[at + shift]) <= FAR]
        links_a.append(near)
        links_b.append(near + shift)
        shift += 1
    if not links_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    label = union_of(np.concatenate(links_a), np.concatenate(links_b), len(keys))
    linked = np.flatnonzero(label != np.arange(len(keys)))
    return prints[linked].view(np.int64), prints[label[linked]].view(np.int64)


def compare(it: Iterator[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Over rows (key, fp, low) sorted by key: links (a, b, low null), and rows (key, fp, low) of groups left to cut."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("low", pa.int32())])
    held = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int32))

    def batch(a, b, low=None):
        low = pa.nulls(len(a), pa.int32()) if low is None else pa.array(low)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), low], schema=schema)

    def settle(keys, prints, lows):
        """Whole groups: large ones are passed on, the others compared."""
        _, starts, sizes = np.unique(keys, return_index=True, return_counts=True)
        size = np.repeat(sizes, sizes)
        large = (size > GROUP) & (not last)
        if large.any():
            yield batch(keys[large], prints[large].view(np.int64), lows[large])
        some = (size > 1) & ~large
        if some.any():
            a, b = forest(keys[some], prints[some])
            if len(a):
                yield batch(a, b)

    for rows in it:
        new = (rows.column("key").to_numpy(), rows.column("fp").to_numpy().view(np.uint64), rows.column("low").to_numpy())
        held = tuple(np.concatenate(x) for x in zip(held, new, strict=True))
        whole = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        if whole:
            yield from settle(*[x[:whole] for x in held])
            held = tuple(x[whole:] for x in held)
        elif len(held[0]) > BLOCK * 4 and not last:  # one group: pass on all but enough to know that it is large
            yield batch(held[0][GROUP + 1 :], held[1][GROUP + 1 :].view(np.int64), held[2][GROUP + 1 :])
            held = tuple(x[: GROUP + 1] for x in held)
    if len(held[0]):
        yield from settle(*held)


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) to links (a, b) that connect all those which differ in three bits or fewer."""
    groups = prints.select(F.lit(0).cast("bigint").alias("key"), "fp", F.lit(0).alias("low"))
    found = None
    for level in range(MAX_LEVEL + 1):
        rows = variants(groups, level).repartition("key").sortWithinPartitions("key")
        last = level == MAX_LEVEL
        out = stored(rows.mapInArrow(lambda it, last=last: compare(it, last), "a bigint, b bigint, low int"))
        new = out.filter("low IS NULL").select("a", "b")
        found = new if found is None else found.unionByName(new)
        groups = out.filter("low IS NOT NULL").select(F.col("a").alias("key"), F.col("b").alias("fp"), "low")
        if groups.isEmpty():
            break
    return found.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links: root is the least node it reaches.

    Alternating large-star and small-star steps on tables in the shared folder; the number of rounds grows with the
    logarithm of the longest path. A node's least neighbour is an aggregate, so no neighbourhood is gathered.
    """
    edges = stored(edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # large star: larger neighbours to the least one
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # small star: smaller neighbours and the node itself to the least one
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = stored(small.filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
    roots = edges.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def rooted(prints: DataFrame) -> DataFrame:
    """(fp, id, root) per fingerprint, from rows (fp, id): its least id and the fingerprint that stands for its class."""
    first = prints.groupBy("fp").agg(F.min("id").alias("id"))
    member = components(links(first.select("fp")))
    return first.join(member, first["fp"] == member["node"], "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))


def classes(prints: DataFrame) -> DataFrame:
    """(fp, component_id) per fingerprint, from rows (fp, id): the least id of all rows the fingerprint reaches."""
    found = rooted(prints)
    return found.join(found.groupBy("root").agg(F.min("id").alias("component_id")), "root").select("fp", "component_id")


def near_duplicates(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: list[str] | None = None,
) -> DataFrame:
    """The rows with `fingerprint` (16 hexadecimal digits) and `component_id`, the least doc_id of the row's component.

    Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share a component; a null
    doc_id is never a component's id, and a component of null ids has a null id. An empty table gives an empty one.
    Input columns named fingerprint or component_id are replaced. `keep`: the input columns to return, all by default.
    """
    rows = without(df, "fingerprint", "component_id")
    kept = [c for c in rows.columns if keep is None or c in keep]
    fp, own = fresh("fp", rows.columns), fresh("own_id", rows.columns)
    marked = stored(rows.select(*kept, F.col(doc_id).alias(own), fingerprint_of(text).alias(fp)))
    found = classes(marked.select(F.col(fp).alias("fp"), F.col(own).alias("id"))).withColumnRenamed("fp", fp)
    digits = F.lower(F.lpad(F.hex(F.col(fp)), 16, "0")).alias("fingerprint")
    return marked.join(found, fp).select(*kept, digits, "component_id")


def one_of_each(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row, with its own columns, of each component: that of the least doc_id, nulls last; of equal ones any.

    Null and empty texts are one component, with whatever else has three bits or fewer set. An empty table stays empty;
    columns may have any names."""
    fp, least, print_of = (fresh(name, df.columns) for name in ("fp", "keep_id", "keep_fp"))
    marked = stored(df.withColumn(fp, fingerprint_of(text)))
    found = rooted(marked.select(F.col(fp).alias("fp"), F.col(doc_id).alias("id")))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "fp")).alias("k"))
    keep = first.select(F.col("k.fp").alias(print_of), F.col("k.id").alias(least))
    same = (F.col(fp) == F.col(print_of)) & F.col(doc_id).eqNullSafe(F.col(least))
    return marked.join(keep, same, "left_semi").dropDuplicates([fp]).drop(fp)
