"""Reading landing and operational tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow, changed, moment
from tallyhouse.sources import schemas as S
from tallyhouse.sources import store

# Columns a landing table has and its operational source has not.
LANDING_ONLY = ("_SNOWFLAKE_INSERTED_AT", "_SNOWFLAKE_UPDATED_AT", "_SNOWFLAKE_DELETED")


def plain_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, without the quotes a quoted identifier leaves."""
    return df.toDF(*[name.replace('"', "").lower() for name in df.columns])


def read_landing(spark: SparkSession, folder: str, name: str, file_format: str = "parquet") -> DataFrame:
    """A landing table of the lending schema, read with its declared types."""
    return spark.read.format(file_format).schema(S.struct(name)).load(f"{folder.rstrip('/')}/{name}.{file_format}")


CHANGED_ON = "_changed_on"


def land_by_change(df: DataFrame, path: str, change_columns: Sequence[str], keys: Sequence[str] = (), slices: int = 1) -> None:
    """Write a landing table partitioned by the month of each row's last change.

    Rows of a month meet by a shuffle of whole rows; in `slices` of the key only one slice is in it at a time, and a month
    has files of each.
    """
    latest = F.greatest(*change_columns) if len(change_columns) > 1 else F.col(change_columns[0])
    for part in store.parts(slices):
        dated = store.slice_of(df, keys, part).withColumn(CHANGED_ON, F.trunc(latest.cast("date"), "month"))
        writer = dated.hint("rebalance", CHANGED_ON).write.mode("append" if part[0] else "overwrite").options(**store.COMPACT)
        with store.shuffles_freed(df.sparkSession):
            writer.partitionBy(CHANGED_ON).parquet(path)


def read_changed(spark: SparkSession, path: str, window: ChangeWindow, change_columns: Sequence[str]) -> DataFrame:
    """The rows of such a table with a change in the window.

    A row changed in the window was last changed in it or later, so months before its start are not read; within the
    others the window itself reaches the scan.
    """
    table = spark.read.parquet(path)
    since = F.col(CHANGED_ON) >= F.trunc(moment(window.start).cast("date"), "month")
    return table.filter(since & changed(window, *change_columns)).drop(CHANGED_ON)


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    lower: str | None = None, upper: str | None = None, partitions: int = 64, **options: str,
) -> DataFrame:
    """An operational table over JDBC, read in parallel ranges of `partition_column`.

    The driver jar comes with the cluster. Window filters put on the result are pushed
    into the database by Spark.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=lower, upperBound=upper, numPartitions=partitions
        )
    return reader.load()


def read_source(
    df: DataFrame, filter_col: str | None = None, lo: str | None = None, hi: str | None = None,
    order_by: Sequence[str] = (), limit: int | None = None,
) -> DataFrame:
    """Rows strictly between two times, optionally the first `limit` in order.

    Rows equal in `order_by` are ordered by their other columns, so the sample is the
    same on every run.
    """
    if filter_col:
        df = df.filter((F.col(filter_col) > moment(lo)) & (F.col(filter_col) < moment(hi)))
    if limit is not None:
        ties = [c for c in df.columns if c not in order_by]
        df = df.orderBy(*order_by, *ties).limit(limit)
    return df


def add_landing_columns(df: DataFrame) -> DataFrame:
    """The change columns as empty text, so an operational table has the landing's columns."""
    return df.withColumns({name: F.lit("") for name in LANDING_ONLY})
