"""Agreed formats for dates, numbers and currencies, column by column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import money, only_numeric


def standardize(df: DataFrame, amounts=(), dates=(), times=(), emails=()) -> DataFrame:
    """Money text to decimals, date and time text to types, emails to lower case; bad text becomes null."""
    changes: dict[str, Column] = {c: money(c, strict=False) for c in amounts}
    changes |= {c: F.col(c).try_cast("date") for c in dates}
    changes |= {c: F.col(c).try_cast("timestamp_ntz") for c in times}
    changes |= {c: F.lower(F.btrim(F.col(c))) for c in emails}
    return df.withColumns(changes)


def unreadable_money(df: DataFrame, key: str, column: str, table: str) -> DataFrame:
    """Reject rows for money text that is no number."""
    bad = F.col(column).isNotNull() & money(column, strict=False).isNull() & only_numeric(column, "[^$, ]")
    return df.filter(bad).select(
        F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
        F.col(key).cast("string").alias("column_value"), F.lit("Not a number").alias("reject_reason"),
    )
