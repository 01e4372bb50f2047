"""Lookups that bring one row, or one value, per key.

All of them aggregate before they are joined: a key with many rows is reduced inside
every map task, so the shuffle carries one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import col


def _one_by(pick, df: DataFrame, keys: Sequence[str], order: str | Column, where: Column | None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    others = [c for c in df.columns if c not in keys]
    # Of equal ids the other columns decide, so the row does not depend on the run; a null id is never picked.
    place = F.when(col(order).isNotNull(), F.struct(col(order), *[F.col(c) for c in others]))
    best = rows.groupBy(*keys).agg(pick(F.struct(*others), place).alias("_row"))
    return best.select(*keys, "_row.*")


def latest_by(df: DataFrame, keys: Sequence[str], order: str | Column, where: Column | None = None) -> DataFrame:
    """The row with the greatest `order` per key; its null fields stay null."""
    return _one_by(F.max_by, df, keys, order, where)


def first_by(df: DataFrame, keys: Sequence[str], order: str | Column, where: Column | None = None) -> DataFrame:
    """The row with the smallest `order` per key."""
    return _one_by(F.min_by, df, keys, order, where)


def max_by_key(df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[Column, str]]) -> DataFrame:
    """Greatest value per key, one column per condition: {name: (condition, column)}."""
    return df.groupBy(*keys).agg(*[F.max(F.when(cond, col(c))).alias(name) for name, (cond, c) in measures.items()])


def sum_by(df: DataFrame, keys: Sequence[str], measures: dict[str, str]) -> DataFrame:
    """Decimal sums per key: {name: column}."""
    return df.groupBy(*keys).agg(*[F.sum(col(c)).cast("decimal(38,2)").alias(name) for name, c in measures.items()])


def ordered(order_by: Sequence[str | Column], columns: Sequence[str]) -> list[Column]:
    """Latest first by the given columns, then by every column, so ties never depend on the run."""
    latest = [col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_by]
    named = {c for c in order_by if isinstance(c, str)}
    return [*latest, *[F.col(c).asc_nulls_last() for c in columns if c not in named]]


def dedupe_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]) -> DataFrame:
    """One row per key, the latest. Spark limits each key to one row before the shuffle."""
    others = [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*ordered(order_by, others))
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def eav(df: DataFrame, keys: Sequence[str], names: dict[str, str], name_col: str, value_col: str) -> DataFrame:
    """Attributes of a key/value table as columns: {column: attribute name}.

    Where an attribute repeats for a key, its smallest value is taken.
    """
    wanted = df.filter(F.col(name_col).isin(*names.values()))
    picks = [F.min(F.when(F.col(name_col) == name, F.col(value_col))).alias(c) for c, name in names.items()]
    return wanted.groupBy(*keys).agg(*picks)


def eav_by_column(df: DataFrame, codes: DataFrame, key: str, code_col: str, name_col: str, value_col: str) -> DataFrame:
    """`codes` rows with the value of the parameter their `code_col` names."""
    named = df.select(key, F.col(name_col).alias(code_col), F.col(value_col).alias("parameter_value"))
    return codes.join(named, [key, code_col])


def eav_indirect(df: DataFrame, key: str, start: str, prefix: str, name_col: str, value_col: str) -> DataFrame:
    """Two hops: the value of parameter `start` names the parameter that holds the value."""
    hops = df.filter(F.col(name_col) == start).select(key, F.col(value_col).alias("_hop"))
    named = df.filter(F.col(name_col).like(prefix)).select(
        key, F.col(name_col).alias("_hop"), F.col(value_col).alias("parameter_value")
    )
    return hops.join(named, [key, "_hop"]).select(key, "parameter_value")
