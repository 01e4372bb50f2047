"""Rows of one table by presence of their key in another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys(right: DataFrame, on: Sequence[str], unique: bool) -> DataFrame:
    # A key with many rows is reduced to one before it is shuffled for the join.
    return right.select(*on) if unique else right.select(*on).distinct()


def only_in_left(left: DataFrame, right: DataFrame, on: Sequence[str], right_unique: bool = False) -> DataFrame:
    """Rows whose key `right` lacks; a null key counts as lacking."""
    return left.join(_keys(right, on, right_unique), list(on), "left_anti")


def only_in_both(left: DataFrame, right: DataFrame, on: Sequence[str], right_unique: bool = False) -> DataFrame:
    return left.join(_keys(right, on, right_unique), list(on), "left_semi")


def mark_present(left: DataFrame, right: DataFrame, on: Sequence[str], flag: str, right_unique: bool = False) -> DataFrame:
    """`left` with a flag telling whether `right` has the key."""
    marked = _keys(right, on, right_unique).withColumn(flag, F.lit(True))
    return left.join(marked, list(on), "left").withColumn(flag, F.col(flag).isNotNull())
