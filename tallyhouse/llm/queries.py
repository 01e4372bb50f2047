"""One query per operator, over the tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import (
    bpe_codec, decontaminate, host_quality, lexical_search, packing, periodic_runs, pii, repair_ids, secrets_ledger, sharding, simhash,
    suffix_dedup, toxicity,
)
from tallyhouse.llm.common import read, shared_folder, stored, text_or_empty

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def span_digest(base):
    return F.sha2(pii.listed(base).cast("binary"), 256)


def count_kind(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces(read(spark, sf_dir, "documents"))
    return packing.pack(stored(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")))


@query
def op2_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    names = [f.name for f in docs.schema.fields if f.name != "text"]
    judged = host_quality.judged(docs, keep=names)
    return judged.select("doc_id", *host_quality.FEATURES, "base_failed", "kept")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.deduplicated(docs, keep=["doc_id"]).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"),
        F.array_join(F.transform("removed", lambda r: F.concat_ws(":", r["start"], r["end"])), ",").alias("removed"))


@query
def op4_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    repair_ids.write(read(spark, sf_dir, "documents"), folder)
    ids = repair_ids.read(spark, folder)
    return ids.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs).select("doc_id", "pii_spans")
    return found.select(
        "doc_id", *[count_kind("pii_spans", k) for k in pii.BASE],
        span_digest(F.filter("pii_spans", lambda s: s["base"])).alias("base_sha256"),
        pii.listed(F.col("pii_spans")).alias("spans"),
        F.transform("pii_spans", lambda s: s["score"]).alias("scores"),
    )


@query
def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.found(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


@query
def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    folder = shared_folder(spark)
    secrets_ledger.start_ledger(spark, folder)
    found = secrets_ledger.scan(docs, folder).select("doc_id", "blob", "secret_spans")
    return found.select(
        "doc_id", *[count_kind("secret_spans", k) for k in secrets_ledger.BASE],
        span_digest(F.filter("secret_spans", lambda s: s["kind"].isin(*secrets_ledger.BASE))).alias("base_sha256"),
        pii.listed(F.col("secret_spans")).alias("spans"), "blob",
    )


@query
def op8_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    text = text_or_empty()
    # Rows carry a 128-bit digest of their text in its place: equal texts are the atomic groups.
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    dealt = sharding.sharded(slim, F.col("digest"), F.col("size"), 24)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "capacity",
    )


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.scored(docs, read(spark, sf_dir, "labels")).drop("text")


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = periodic_runs.with_runs(docs.select("doc_id", periodic_runs.stretched().alias("text")), keep=["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("longest.back")).alias("start"), "longest.length",
        (-F.col("longest.short")).alias("period"),
        F.floor(F.lit(1000) * F.col("longest.length") / -F.col("longest.short")).cast("long").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@query
def op12_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe_codec.encoded(read(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return bpe_codec.decoded(ids).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)
