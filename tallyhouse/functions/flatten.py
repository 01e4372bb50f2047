"""Raw JSON text to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """Replace a JSON text column by the fields of `schema` (DDL text)."""
    parsed = df.withColumn("_json", F.from_json(F.col(column), schema))
    return parsed.select(*[c for c in df.columns if c != column], "_json.*")
