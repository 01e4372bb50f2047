"""Tables in the shared folder, and helpers the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# White space that parts words, as a class of Java, Python and RE2 patterns.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def shared_folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under `spark.checkpoint.dir`, else under the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and safe when executors go."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, with underscores before it until no given column has it (names are compared as Spark does)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """The columns but for those an operator is about to add."""
    return df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in names}])


def text_or_empty(text: str = "text"):
    return F.coalesce(F.col(text), F.lit(""))


def batches(columns: dict[str, pa.DataType], rows: Iterator[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most `size` rows."""
    schema = pa.schema(list(columns.items()))
    held: list[tuple] = []

    def batch():
        values = zip(*held, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, columns.values(), strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held = []
    if held:
        yield batch()
