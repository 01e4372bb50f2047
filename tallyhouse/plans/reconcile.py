"""Comparing a source table with a target table.

Whole tables are compared, not samples. Counts, nulls and row content come from one
aggregate per side; a difference report aggregates equal rows before it groups by key,
so a key with very many rows never has to be ranked in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import binary_to_hex
from tallyhouse.sources import store
from tallyhouse.sources.scan import plain_names, read_source

MATCH, MISMATCH, EQUIVALENT = "Match", "Mismatch", "Equivalent"


def status(equal: Column) -> Column:
    return F.when(equal, MATCH).otherwise(MISMATCH)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def aligned(source: DataFrame, target: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their common columns, named alike, in one order and of one type.

    Binary becomes hex text; where the types of a column differ it is compared as text.
    """
    source, target = plain_names(source), plain_names(target)
    common = sorted(set(source.columns) & set(target.columns))

    source_types, target_types = dict(source.dtypes), dict(target.dtypes)

    def column(name: str, dtype: str, other: str) -> Column | str:
        if dtype == "binary":
            return binary_to_hex(name).alias(name)
        return name if dtype == other else F.col(name).cast("string").alias(name)

    return (
        source.select(*[column(c, source_types[c], target_types[c]) for c in common]),
        target.select(*[column(c, target_types[c], source_types[c]) for c in common]),
    )


# --- counts, names, types, nulls ------------------------------------------------------------

def row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    sides = [
        source.agg(F.count(F.lit(1)).alias("source_count"), F.lit(0).cast("long").alias("target_count")),
        target.agg(F.lit(0).cast("long").alias("source_count"), F.count(F.lit(1)).alias("target_count")),
    ]
    counts = _union(sides).agg(F.sum("source_count").alias("source_count"), F.sum("target_count").alias("target_count"))
    return counts.withColumn("count_match", status(F.col("source_count") == F.col("target_count")))


def schema_rows(df: DataFrame, side: str) -> DataFrame:
    """(column_name, <side>_type) of a table, its schema as data."""
    fields = [(name, dtype) for name, dtype in plain_names(df).dtypes]
    return df.sparkSession.createDataFrame(fields, f"column_name string, {side}_type string")


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """(column_name, source_type, target_type): every column of either table; a type is null where the column is missing."""
    return schema_rows(source, "source").join(schema_rows(target, "target"), "column_name", "full")


def schema_report(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row: how many columns each table has and they share, do the sets match, are the types the same or only equivalent.

    Types of shared columns decide on equivalence; a column on one side alone is a mismatch of the schema.
    """
    shared = F.col("source_type").isNotNull() & F.col("target_type").isNotNull()
    counts = schema_diff(source, target).agg(
        F.count("source_type").alias("source_columns"), F.count("target_type").alias("target_columns"),
        F.count_if(shared).alias("shared_columns"), F.count_if(shared & (F.col("source_type") == F.col("target_type"))).alias("same_types"),
    )
    all_shared = (F.col("shared_columns") == F.col("source_columns")) & (F.col("shared_columns") == F.col("target_columns"))
    all_same = all_shared & (F.col("same_types") == F.col("shared_columns"))
    return counts.withColumns({
        "schema_match": status(all_shared), "datatype_match": F.when(all_same, MATCH).otherwise(EQUIVALENT)})


def schema_and_rows(pair: TablePair, source: DataFrame, target: DataFrame) -> DataFrame:
    """The schema report of a pair beside the counts of its rows."""
    counts = row_count(source, target).drop("count_match")
    return counts.crossJoin(schema_report(source, target)).select(
        F.lit(pair.source_name).alias("source_table"), F.lit(pair.target_name).alias("target_table"), "*")


def null_counts(df: DataFrame, count_name: str) -> DataFrame:
    """Nulls per column: one aggregate row turned into one row per column."""
    counts = df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", count_name)


def null_report(source: DataFrame, target: DataFrame) -> DataFrame:
    source, target = aligned(source, target)
    both = null_counts(source, "source_nulls").join(null_counts(target, "target_nulls"), "column_name")
    return both.withColumn("null_match", status(F.col("source_nulls") == F.col("target_nulls")))


# --- row content -----------------------------------------------------------------------------

DIGEST = ["_a", "_b"]


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    """A 64-bit hash of a row. A null leaves a hash unchanged, so whether each column is null is hashed too."""
    cells = ", ".join(f"`{c}`, `{c}` IS NULL" for c in columns)
    return F.expr(f"xxhash64({seed}, {cells})")


def _digested(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: _row_hash(columns, seed) for seed, name in enumerate(DIGEST, 1)})


def digest_copies(source: DataFrame, target: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, 128 bits of each distinct row, its copies in the source `_src` and in the target `_tgt`).

    Rows take part by their digest, so no exchange carries their values; copies are summed in every task first. Two rows that
    differ share a digest with a chance of 2^-128.
    """
    source, target = aligned(source, target)
    names = source.columns

    def side(df: DataFrame, src: int) -> DataFrame:
        slim = _digested(df, names).select(*keys, *DIGEST)
        return slim.withColumns({"_src": F.lit(src), "_tgt": F.lit(1 - src)})

    tagged = side(source, 1).unionByName(side(target, 0))
    return tagged.groupBy(*keys, *DIGEST).agg(F.sum("_src").alias("_src"), F.sum("_tgt").alias("_tgt"))


def data_equal(source: DataFrame, target: DataFrame) -> DataFrame:
    """Comparison of the row multisets."""
    differing = digest_copies(source, target).agg(F.count_if(F.col("_src") != F.col("_tgt")).alias("differing_rows"))
    return differing.withColumn("data_match", status(F.col("differing_rows") == 0))


def keyed_diff(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on each side and how many are equal, differing or on one side only.

    Keys may repeat: equal rows of a key are paired first, the rest as far as both sides go.
    """
    per_key = digest_copies(source, target, keys).groupBy(*keys).agg(
        F.sum("_src").alias("source_rows"), F.sum("_tgt").alias("target_rows"),
        F.sum(F.least("_src", "_tgt")).alias("equal_rows"),
    )
    paired = F.least("source_rows", "target_rows")
    return per_key.withColumns({
        "differing_rows": paired - F.col("equal_rows"),
        "only_in_source": F.col("source_rows") - paired,
        "only_in_target": F.col("target_rows") - paired,
    })


def differing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of one side that the other lacks, whole: all columns, surplus copies `_src` or `_tgt`, and of their key
    how many there are on each side, `_key_src` and `_key_tgt`.

    Digests cancel first; whole rows are fetched for the rest alone.
    """
    left, right = aligned(source, target)
    names = left.columns
    equal = F.least("_src", "_tgt")
    copies = digest_copies(source, target, keys).filter(F.col("_src") != F.col("_tgt"))
    rest = copies.select(*keys, *DIGEST, (F.col("_src") - equal).alias("_src"), (F.col("_tgt") - equal).alias("_tgt"))
    per_key = rest.groupBy(*keys).agg(F.sum("_src").alias("_key_src"), F.sum("_tgt").alias("_key_tgt"))
    same_key = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])
    marked = rest.alias("r").join(per_key.alias("k"), same_key).select(
        *DIGEST, "r._src", "r._tgt", "k._key_src", "k._key_tgt")

    def whole(df: DataFrame, surplus: str) -> DataFrame:
        own = marked.filter(F.col(surplus) > 0)
        return _digested(df, names).join(own, DIGEST).dropDuplicates(DIGEST).drop(*DIGEST)

    return whole(left, "_src").unionByName(whole(right, "_tgt"))


def column_mismatches(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per column, rows present on both sides of a key whose value has no counterpart there.

    Where a key has one differing row on each side, the two are compared column by column in one pass; only the rows of keys
    with several are spread over their columns.
    """
    rest = differing_rows(source, target, keys)
    others = [c for c in rest.columns if c not in (*keys, "_src", "_tgt", "_key_src", "_key_tgt")]
    single = (F.col("_key_src") == 1) & (F.col("_key_tgt") == 1)
    pairs = rest.filter(single).groupBy(*keys).agg(*[
        F.max_by(F.struct(*others), side).alias(side) for side in ("_src", "_tgt")])
    counted = pairs.agg(*[F.count_if(~F.col(f"_src.`{c}`").eqNullSafe(F.col(f"_tgt.`{c}`"))).alias(c) for c in others])
    of_pairs = counted.unpivot([], others, "column_name", "mismatched_rows")

    several = rest.filter(~single & (F.col("_key_src") > 0) & (F.col("_key_tgt") > 0)).select(
        *keys, *[F.col(c).cast("string").alias(c) for c in others], "_src", "_tgt")
    cells = several.unpivot([*keys, "_src", "_tgt"], others, "column_name", "_value")
    values = cells.groupBy(*keys, "column_name", "_value").agg(F.sum("_src").alias("_src"), F.sum("_tgt").alias("_tgt"))
    per_key = values.groupBy(*keys, "column_name").agg(
        F.sum("_src").alias("_src"), F.sum("_tgt").alias("_tgt"), F.sum(F.least("_src", "_tgt")).alias("_same")
    )
    mismatched = F.least("_src", "_tgt") - F.col("_same")
    of_several = per_key.groupBy("column_name").agg(F.sum(mismatched).alias("mismatched_rows"))
    return of_pairs.unionByName(of_several).groupBy("column_name").agg(F.sum("mismatched_rows").alias("mismatched_rows"))


def diff_totals(diff: DataFrame) -> DataFrame:
    """A key diff as counts per kind."""
    return diff.agg(
        F.count_if(F.col("differing_rows") > 0).alias("keys_differing"),
        F.count_if(F.col("source_rows") == 0).alias("keys_only_in_target"),
        F.count_if(F.col("target_rows") == 0).alias("keys_only_in_source"),
        *[F.sum(c).alias(c) for c in ("equal_rows", "differing_rows", "only_in_source", "only_in_target")],
    )


def diff_lines(diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that are not equal on both sides as report lines."""
    unequal = diff.filter((F.col("equal_rows") != F.col("source_rows")) | (F.col("equal_rows") != F.col("target_rows")))
    key = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
    counts = F.format_string(
        ": %d differing, %d only in source, %d only in target", "differing_rows", "only_in_source", "only_in_target"
    )
    return unequal.select(F.concat(key, counts).alias("line"))


# --- summaries over many table pairs ------------------------------------------------------

@dataclass(frozen=True)
class TablePair:
    """A source and a target to compare, with an optional time column for a window on each and the key of their rows."""

    source_name: str
    target_name: str
    source: Callable[[], DataFrame]
    target: Callable[[], DataFrame]
    source_filter: str | None = None
    target_filter: str | None = None
    keys: tuple[str, ...] = ()


def _fingerprint(df: DataFrame, seed: int) -> Column:
    """A sum of row hashes, equal for equal multisets of rows in any order."""
    return F.sum(_row_hash(df.columns, seed).cast("decimal(38,0)"))


def _profile(df: DataFrame) -> DataFrame:
    nulls = F.expr(f"array({', '.join(f'count_if(`{c}` IS NULL)' for c in df.columns)})")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), nulls.alias("nulls"),
        F.struct(_fingerprint(df, 1).alias("a"), _fingerprint(df, 2).alias("b")).alias("content"),
    )


def pair_summary(pair: TablePair, source: DataFrame, target: DataFrame) -> DataFrame:
    """One row with the nine columns of the comparison report.

    Each side is scanned once and nothing is shuffled but one row per task: the row
    content is compared by two 64-bit sums over all rows. `data_equal` compares exactly.
    """
    left, right = aligned(source, target)
    sides = _profile(left).withColumn("side", F.lit("source")).unionByName(
        _profile(right).withColumn("side", F.lit("target"))
    )

    def of(side: str, name: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(name)))

    both = sides.agg(*[of(s, n).alias(f"{s}_{n}") for s in ("source", "target") for n in ("rows", "nulls", "content")])
    return both.crossJoin(schema_report(source, target)).select(
        F.lit(pair.source_name).alias("source_table"), F.lit(pair.target_name).alias("target_table"),
        F.col("source_rows").alias("source_count"), F.col("target_rows").alias("target_count"),
        status(F.col("source_rows") == F.col("target_rows")).alias("count_match"),
        "schema_match", "datatype_match",
        status(F.col("source_nulls") == F.col("target_nulls")).alias("null_match"),
        status(F.col("source_content").eqNullSafe(F.col("target_content"))).alias("data_match"),
    )


def landing_summary(pair: TablePair, source: DataFrame, target: DataFrame) -> DataFrame:
    """Counts and column names only."""
    return row_count(source, target).crossJoin(schema_report(source, target)).select(
        F.lit(pair.source_name).alias("source_table"), F.lit(pair.target_name).alias("target_table"),
        "source_count", "target_count", "count_match", "schema_match",
    )


def count_summary(pair: TablePair, source: DataFrame, target: DataFrame) -> DataFrame:
    """The count of a relation against the count of the table it feeds."""
    return row_count(source, target).select(F.lit(pair.target_name).alias("target_table"), "source_count", "target_count", "count_match")


def pair_columns(pair: TablePair, source: DataFrame, target: DataFrame, folder: str | None = None) -> DataFrame:
    """Per column of a pair, how many rows of keys on both sides differ in it.

    With a `folder` for their counts, a large pair is compared here and now, slice by slice of its keys: the disk then holds
    the whole rows of one slice at a time, and no other pair's.
    """
    left, right = aligned(source, target)
    count = 1 if folder is None else store.slices_of(source.count())

    def of(part: store.Part) -> DataFrame:
        return column_mismatches(*[store.slice_of(df, pair.keys, part) for df in (left, right)], pair.keys)

    found = store.in_slices(source.sparkSession, f"{folder}/{pair.target_name}", count, of)
    if count > 1:
        found = found.groupBy("column_name").agg(F.sum("mismatched_rows").alias("mismatched_rows"))
    return found.select(F.lit(pair.source_name).alias("source_table"), F.lit(pair.target_name).alias("target_table"), "*")


def pair_diff(pair: TablePair, source: DataFrame, target: DataFrame) -> DataFrame:
    """How many keys and rows of a pair are equal, differing or on one side only."""
    totals = diff_totals(keyed_diff(source, target, pair.keys))
    return totals.select(F.lit(pair.source_name).alias("source_table"), F.lit(pair.target_name).alias("target_table"), "*")


def reconcile_all(
    pairs: Sequence[TablePair], summarize: Callable[[TablePair, DataFrame, DataFrame], DataFrame] = pair_summary,
    lo: str | None = None, hi: str | None = None,
) -> DataFrame:
    """One report row per pair; a pair with a time column is compared inside the window only."""
    def window(df: DataFrame, column: str | None) -> DataFrame:
        return read_source(df, column, lo, hi) if column and lo else df

    return _union([
        summarize(p, window(p.source(), p.source_filter), window(p.target(), p.target_filter)) for p in pairs
    ])


# --- rules ------------------------------------------------------------------------------------

def check_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows breaking each rule: every rule of a table in one pass."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")
