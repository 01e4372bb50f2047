"""Parquet tables in a shared folder, written by Spark's own writers.

A keyed table is partitioned by a hash of its key. A load writes the rows it changed to a folder of their own, and then
rewrites only the partitions that hold one of them, by dynamic partition overwrite: files of other partitions stay as they
are, and a load that stops halfway is finished by applying the same changes again. Rows deleted by the last rewrite of a
partition stay in it, marked, so that no partition becomes empty (an empty one would not replace the old one); readers do
not see them. One job writes a table at a time; a reader meanwhile may see some partitions before and some after the load.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import all_of

BUCKET = "_bucket"
GONE = "_gone"

# Rows of a table for each slice that a job is cut into, and the most slices; a power of two, so that a slice holds whole
# partitions of a keyed table.
SLICE_ROWS = 1 << 20
MOST_SLICES = 8
Part = tuple[int, int]  # a slice's index and how many there are
WHOLE: Part = (0, 1)
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Keyed tables and rows on their way into them take the codec that stores keys and texts smallest.
COMPACT = {"compression": "zstd"}


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at `path`, or None where nothing was written yet."""
    try:
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_table(spark: SparkSession, path: str, part: Part = WHOLE) -> DataFrame:
    """The rows of a table, without those marked as gone; of a keyed table, the partitions of one slice of its keys."""
    table = read_if_exists(spark, path)
    if table is None:
        raise FileNotFoundError(f"no table at {path}")
    index, count = part
    if count > 1:
        table = table.filter(F.col(BUCKET) % count == index)
    if GONE in table.columns:
        table = table.filter(~F.col(GONE))
    return table.drop(BUCKET, GONE)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a log, archive or reject table."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("append").parquet(path)


def truncate_load(df: DataFrame, path: str) -> None:
    """Replace a staging table, which nothing reads while it is written."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(path)


def replace(df: DataFrame, path: str, stage: str) -> None:
    """Replace a table by rows that may be computed from it: they are written to the folder `stage` first."""
    df.write.mode("overwrite").parquet(stage)
    df.sparkSession.read.schema(df.schema).parquet(stage).write.mode("overwrite").parquet(path)


# --- slices --------------------------------------------------------------------------------
#
# A shuffle stays on disk until its plan ends. A plan over wide tables of one key is therefore run slice by slice of that
# key: the disk then holds what is written and the shuffles of one slice. Every slice scans its tables again.

def slices_of(rows: int) -> int:
    """How many slices a job over a table of so many rows is cut into."""
    count = 1
    while count < MOST_SLICES and count * SLICE_ROWS < rows:
        count *= 2
    return count


def parts(count: int) -> list[Part]:
    return [(index, count) for index in range(count)]


def slice_of(df: DataFrame, keys: Sequence[str], part: Part) -> DataFrame:
    """The rows whose key falls into one slice; all rows of a key, and those without one, share a slice."""
    index, count = part
    return df if count == 1 else df.filter(bucket_of(keys, count) == index)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a plan that runs inside go when it ends, not when the driver happens to collect its garbage."""
    held = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, held)


def in_slices(spark: SparkSession, path: str, count: int, build: Callable[[Part], DataFrame]) -> DataFrame:
    """The rows of all slices: `build` gives those of one, which are written to the new folder `path` before the next begins.

    A single slice is not written but returned as it is.
    """
    if count == 1:
        return build(WHOLE)
    for part in parts(count):
        rows = build(part)
        with shuffles_freed(spark):
            rows.write.mode("append").options(**COMPACT).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# --- keyed tables --------------------------------------------------------------------------

def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, option: str, mode: str = "overwrite") -> None:
    # Rebalanced by bucket: rows of a bucket meet, and adaptive execution splits a bucket that is too large for one file.
    writer = df.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", option)
    with shuffles_freed(df.sparkSession):
        writer.partitionBy(BUCKET).options(**COMPACT).parquet(path)


def write_table(df: DataFrame, path: str, keys: Sequence[str], buckets: int, slices: int = 1) -> None:
    """A whole table partitioned by a hash of its key; it must not be computed from the table it replaces.

    In `slices`, of which each holds partitions of its own, only one slice is in the shuffle at a time.
    """
    for part in parts(slices):
        rows = slice_of(df, keys, part).withColumns({GONE: F.lit(False), BUCKET: bucket_of(keys, buckets)})
        _write(rows, path, "static", "append" if part[0] else "overwrite")


def apply_changes(
    spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str], buckets: int, gone: str | None = None
) -> list[int]:
    """Put changed rows in the place of the rows with their key; returns the partitions rewritten.

    `changes` is a written table, one row per key, with the table's columns; rows whose flag `gone` is set are deleted. At
    most `buckets` numbers reach the driver. Applying the same changes again changes nothing.
    """
    table = spark.read.parquet(path)
    flag = F.coalesce(F.col(gone), F.lit(False)) if gone else F.lit(False)
    new = changes.withColumns({GONE: flag, BUCKET: bucket_of(keys, buckets)}).select(*table.columns)
    touched = sorted(row[0] for row in new.select(BUCKET).distinct().collect())
    if not touched:
        return []
    t, n = table.filter(F.col(BUCKET).isin(touched) & ~F.col(GONE)).alias("t"), new.select(*keys).alias("n")
    kept = t.join(n, all_of([F.col(f"t.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys]), "left_anti")
    _write(kept.unionByName(new), path, "dynamic")
    return touched
