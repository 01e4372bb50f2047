"""Secret scans over a ledger of blobs.

Every version of every path is addressed by the SHA-256 of its content. A ledger keeps one row per blob and rule
version that was scanned, with what was found. A scan reads only pairs that the ledger lacks, each blob once, and
findings are joined back to all paths that hold the blob.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, text_or_empty, without

RULE_VERSION = "1"
BASE = ("assign", "access", "hex")
SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
LEDGER = f"blob string, rule_version string, spans {SPAN_TYPE.simpleString()}"

# The three base kinds, then tokens by their issuers' published prefixes. A run that is too short fails
# as a whole, so the least lengths stand in the patterns.
PATTERNS = {
    "assign": re.compile(
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII),
    "access": re.compile(r"AKIA[A-Z0-9]{12,}"),
    "hex": re.compile(r"[0-9a-f]{32,}"),
    "private_key": re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    "github": re.compile(r"(?<![A-Za-z0-9_])gh[pousr]_[A-Za-z0-9]{36,}"),
    "slack": re.compile(r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}"),
    "jwt": re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
}
# What a text must hold for a kind to be searched: cheap to test, and necessary for a match.
NEEDS = {"access": "AKIA", "private_key": "PRIVATE KEY-----", "github": "gh", "slack": "xox", "jwt": "eyJ"}
ASSIGN_LEAST = 8


def find(text: str | None) -> list[dict]:
    """Spans of a text by start, then kind; leftmost and not overlapping per kind, in code points, the end exclusive."""
    out: list[tuple] = []
    text = text or ""
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        if NEEDS.get(kind, "") not in text:
            continue
        if kind == "assign" and "=" not in text and ":" not in text:
            continue
        for m in pattern.finditer(text):
            if kind != "assign" or len(m[2]) >= ASSIGN_LEAST:
                out.append((m.start(), order, m.end(), kind))
    return [{"kind": kind, "start": start, "end": end} for start, _, end, kind in sorted(out)]


@F.arrow_udf(SPAN_TYPE)
def spans_of(text: pa.Array) -> pa.Array:
    return pa.array([find(t.as_py()) for t in text], SPAN_ARROW)


def read_ledger(spark: SparkSession, folder: str, rule_version: str) -> DataFrame:
    """(blob, spans) of one rule version. Two scans at once may both have added a blob; it counts once."""
    rows = spark.read.schema(LEDGER).parquet(folder).filter(F.col("rule_version") == rule_version)
    return rows.groupBy("blob").agg(F.min("spans").alias("spans"))


def start_ledger(spark: SparkSession, folder: str) -> None:
    spark.createDataFrame([], LEDGER).write.mode("append").parquet(folder)


def scan(versions: DataFrame, folder: str, text: str = "text", rule_version: str = RULE_VERSION) -> DataFrame:
    """Brings the ledger in `folder` up to date, then returns the rows with `blob` and `secret_spans`.

    A row is one version of one path. Null and empty texts are the same, empty blob, with no spans. Repeated rows hold
    the same blob and get the same spans. An empty table adds nothing and returns no rows. Input columns named blob or
    secret_spans are replaced. The ledger is appended to in one commit, so a scan that fails leaves it as it was.
    """
    spark = versions.sparkSession
    rows = without(versions, "blob", "secret_spans")
    blob = F.sha2(text_or_empty(text).cast("binary"), 256)
    held = rows.select(blob.alias("blob"), text_or_empty(text).alias("text"))
    once = held.groupBy("blob").agg(F.first("text").alias("text"))
    known = read_ledger(spark, folder, rule_version).select("blob", F.lit(True).alias("known"))
    # A left join stays above the aggregate, which drops copies in every task; an anti join would be moved below it.
    unseen = once.join(known, "blob", "left").filter("known IS NULL")
    found = unseen.select("blob", F.lit(rule_version).alias("rule_version"), spans_of("text").alias("spans"))
    found.write.mode("append").parquet(folder)
    key = fresh("key", rows.columns)
    # Joined by the raw digest: it is half as long, and since no side is partitioned by it yet both are shuffled for this
    # join alone, so adaptive execution can split a blob that holds many rows.
    ledger = read_ledger(spark, folder, rule_version).select(F.unhex("blob").alias(key), F.col("spans").alias("secret_spans"))
    return rows.withColumn("blob", blob).join(ledger, F.unhex("blob") == F.col(key)).drop(key)
