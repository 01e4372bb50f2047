"""Minimax contiguous partition of atomic groups into shards.

Groups are ordered by a 60-bit hash of their key and never split. The smallest capacity for which cutting the
ordered groups greedily needs no more than the given shards is found by binary search. The search runs on the driver
over a bounded tree of hash ranges: ranges in which a cut may fall are opened, level by level, by a Spark job that
sums the groups below them, until every tested capacity is decided. A row's shard is then a comparison of its hash
with the cut points, so no row moves.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.common import fresh, stored, without

BITS = 60
FIRST_BITS = 12
STEP_BITS = 6
TESTED = 16


@dataclass(frozen=True)
class Node:
    """The groups whose hash lies in [low, low + 2**width)."""

    low: int
    width: int
    size: int
    groups: int

    @property
    def high(self) -> int:
        return self.low + (1 << self.width)


def group_hash(key: Column) -> Column:
    """The place of a group in the order. Keys of one hash form one group."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - BITS)


class Tree:
    """Hash ranges in order, with the sums of their sizes."""

    def __init__(self, nodes: list[Node]):
        self.nodes = sorted(nodes, key=lambda n: n.low)
        self.ends = list(accumulate(n.size for n in self.nodes))
        self.total = self.ends[-1] if self.ends else 0

    def cuts(self, capacity: int, shards: int) -> list[int] | None:
        """Greedy cuts at ends of ranges, the last at the total; None if more shards are needed."""
        at, out = 0, []
        for _ in range(shards):
            i = bisect_right(self.ends, at + capacity)
            to = self.ends[i - 1] if i else 0
            out.append(to)
            if to == self.total:
                return out
            if to <= at:
                return None
            at = to
        return None

    def hoped(self, capacity: int, shards: int) -> tuple[bool, set[int]]:
        """Whether the capacity could do if every open range could be cut anywhere; ranges where that was supposed."""
        at, open_ranges = 0, set()
        for _ in range(shards):
            goal = at + capacity
            if goal >= self.total:
                return True, open_ranges
            i = bisect_right(self.ends, goal)
            start = self.ends[i - 1] if i else 0
            if self.nodes[i].groups > 1 and goal > start:
                open_ranges.add(i)
                at = goal
            elif start <= at:
                return False, open_ranges
            else:
                at = start
        return False, open_ranges

    def open_on_path(self, capacity: int, shards: int) -> set[int]:
        """Open ranges in which the greedy cuts at this capacity fall."""
        out = self.hoped(capacity, shards)[1]
        for end in self.cuts(capacity, shards) or []:
            i = bisect_right(self.ends, end + capacity)
            if i < len(self.nodes) and self.nodes[i].groups > 1:
                out.add(i)
        return out


def smallest(fits, low: int, high: int) -> int:
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def even_cuts(tree: Tree, capacity: int, shards: int) -> list[int]:
    """Cuts that keep to the capacity and lie as near to equal shares of what is left as that allows.

    Greedy filling would leave the last shards empty when one group is larger than a fair share.
    """
    ends = [0, *tree.ends]
    least = [0] * shards + [tree.total]
    for j in range(shards, 0, -1):
        least[j - 1] = ends[bisect_left(ends, max(0, least[j] - capacity))]
    at, out = 0, []
    for j in range(1, shards):
        last = bisect_right(ends, at + capacity) - 1
        first = min(max(bisect_left(ends, least[j]), bisect_right(ends, at)), last)  # one group at least
        wish = at + (tree.total - at) / (shards - j + 1)
        i = min(max(bisect_left(ends, wish), first), last)
        if i > first and abs(ends[i - 1] - wish) <= abs(ends[i] - wish):
            i -= 1
        out.append(ends[i])
        at = ends[i]
    return out


def cut_points(df: DataFrame, group: str, size: str, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity, and the `shards - 1` hashes at which a next shard begins."""
    groups = stored(df.groupBy(F.col(group).alias("g")).agg(F.sum(size).alias("s")))

    def below(width: int, nodes: list[Node]) -> list[Node]:
        """The ranges of `width` bits within `nodes`, which are all of one width."""
        rows = groups
        if nodes:
            rows = rows.filter(F.shiftright("g", nodes[0].width).isin([n.low >> nodes[0].width for n in nodes]))
        sums = rows.groupBy(F.shiftright("g", width).alias("p")).agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("n"))
        return [Node(r.p << width, width, r.s, r.n) for r in sums.collect()]

    tree = Tree(below(BITS - FIRST_BITS, []))
    while True:
        low = smallest(lambda c: tree.hoped(c, shards)[0], -(-tree.total // shards), tree.total)
        high = smallest(lambda c: tree.cuts(c, shards) is not None, low, tree.total)
        if low == high:
            break
        tested = {low + (high - low) * k // TESTED for k in range(TESTED + 1)}
        split = [tree.nodes[i] for i in sorted(set().union(*[tree.open_on_path(c, shards) for c in tested]))]
        kept = [n for n in tree.nodes if n not in set(split)]
        for width in sorted({n.width for n in split}):
            kept += below(max(0, width - STEP_BITS), [n for n in split if n.width == width])
        tree = Tree(kept)
    if not tree.nodes:
        return 0, [1 << BITS] * (shards - 1)
    highs = [0, *[n.high for n in tree.nodes]]
    ends = [0, *tree.ends]
    return high, [highs[bisect_right(ends, e) - 1] for e in even_cuts(tree, high, shards)]


def numbered(it: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and each row's place among the task's rows of its shard."""
    part, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
    for batch in it:
        shard = batch.column("shard").to_numpy()
        order = np.argsort(shard, kind="stable")
        ordered = shard[order]
        first = np.searchsorted(ordered, ordered)
        place = np.empty(len(shard), np.int64)
        place[order] = np.arange(len(shard)) - first + seen[ordered]
        seen += np.bincount(shard, minlength=shards)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(shard), part, np.int64)), pa.array(place)],
            names=[*batch.schema.names, "part", "place"],
        )


def sharded(df: DataFrame, key: Column, size: Column, shards: int) -> DataFrame:
    """The rows with `shard` (0 to shards - 1), `slot` (gapless from 0 in its shard) and `capacity`.

    Rows of equal key share a shard. The largest shard is as small as any contiguous cut of the ordered groups allows.
    Null keys form one group; a null size counts as 0. With no rows there are no shards. Columns of the input named
    shard, slot or capacity are replaced. Slots follow the order in which tasks read the rows. Rows move nowhere: a
    task counts its rows per shard, and the starts come from a table of tasks and shards.
    """
    rows = without(df, "shard", "slot", "capacity")
    group, weight = (fresh(c, rows.columns) for c in ("group_hash", "group_size"))
    marked = rows.withColumns({group: group_hash(key), weight: F.coalesce(size.cast("long"), F.lit(0).cast("long"))})
    capacity, cuts = cut_points(marked, group, weight, shards)
    shard = sum((F.when(F.col(group) >= F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0)).cast("int")
    assigned = marked.select(*[F.col(c) for c in rows.columns], shard.alias("shard"))
    plain = assigned.toDF(*[f"c{i}" for i in range(len(rows.columns))], "shard")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    placed = stored(plain.mapInArrow(lambda it: numbered(it, shards), f"{fields}, part long, place long"))
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    starts = counts.select("part", "shard", F.coalesce(before, F.lit(0)).alias("start"))
    out = placed.join(starts, ["part", "shard"])
    return out.select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns)], "shard",
        (F.col("start") + F.col("place")).alias("slot"), F.lit(capacity).cast("long").alias("capacity"),
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder per shard, as sharded() dealt them; large shards have several files, rows in slot order."""
    df.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
