"""fct_collection_detail: collections per loan, amounts collected and still open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions import cleaning as C
from tallyhouse.functions.change_window import ChangeWindow, changed, moment
from tallyhouse.operators.correct import Update, apply_updates, attach_latest
from tallyhouse.operators.lookup import dedupe_latest, latest_by
from tallyhouse.operators.modify import delete_keys, diverges, merge_upsert
from tallyhouse.operators.presence import mark_present, only_in_both, only_in_left
from tallyhouse.plans.job import DELETED, merge_step, OP, JobResult, Step, Tables, update_steps
from tallyhouse.sources import schemas as S

# A collection may hold several loans; rows are kept per pair.
KEYS = ["collection_id", "base_loan_id"]

# The item column summed into each collected amount. The parity assignment
# puts three sums into columns of another name; it is kept for comparisons only.
COLLECTED_FROM = {
    "collected_total_amount": "total_amount", "collected_principal_amount": "amount_prin",
    "collected_interest_amount": "amount_int", "collected_fees_amount": "amount_fee",
    "collected_other_amount": "amount_other",
}
COLLECTED_FROM_PARITY = {
    "collected_total_amount": "total_amount", "collected_principal_amount": "amount_fee",
    "collected_interest_amount": "amount_prin", "collected_fees_amount": "amount_int",
    "collected_other_amount": "amount_other",
}
CURES = ("_cure_id", "_notice_id", "_outgoing_date", "_default_date", "_sent", "_cured", "_cure_date")
ITEM_AMOUNTS = ("total_amount", "amount_fee", "amount_prin", "amount_int", "amount_other")


def collection_source(landing: Tables, window: ChangeWindow, now: str) -> DataFrame:
    collections = landing["collections"].select("collection_id", *S.COLLECTION_PASS)
    return (
        landing["collection_lms_loan_map"]
        .filter(changed(window, *S.CHANGE_COLUMNS))
        .join(collections, "collection_id")
        .select(*S.MAP_PASS, *S.COLLECTION_PASS, moment(now).alias("process_timestamp"))
    )


def collection_merge(landing: Tables, target: DataFrame, window: ChangeWindow, now: str, small_source: bool = False) -> DataFrame:
    return merge_upsert(
        target, collection_source(landing, window, now), KEYS, S.INSERT_ONLY["fct_collection_detail"],
        small_source=small_source, op_column=OP,
    )


def purged_pairs(landing: Tables, target: DataFrame) -> DataFrame:
    """(collection, loan) pairs that left landing."""
    return only_in_left(target.select(*KEYS), landing["collection_lms_loan_map"], KEYS)


def collection_purge(landing: Tables, target: DataFrame, parity: bool = False) -> DataFrame:
    """Drop the pairs that left landing; `parity` drops every row of their collections."""
    if parity:
        return delete_keys(target, purged_pairs(landing, target), ["collection_id"])
    return only_in_both(target, landing["collection_lms_loan_map"], KEYS)


# --- collected amounts -----------------------------------------------------------------

def loan_activity(landing: Tables) -> DataFrame:
    """Per loan id whether its latest row is active; null for a loan without a status."""
    rows = landing["lms_base_loans"].select("base_loan_id", "loan_status", "updated_datetime")
    latest = dedupe_latest(rows, ["base_loan_id"], ["updated_datetime"])
    return latest.select("base_loan_id", F.col("loan_status").isin(*V.ACTIVE_LOAN).alias("_active"))


def collected_sums(landing: Tables, window: ChangeWindow, parity: bool = False) -> DataFrame:
    """Sums of collected debit items of collection schedules per loan, as active and as other loans count them.

    Active loans count items dated up to the start, `a_...`, if there is one (`_counts_active`). Others count all items
    if one is dated or changed since the start, or with `parity` those items alone: `o_...`, `_counts_other`. Items are
    read once, and summed per schedule before the join, so a schedule with very many items reaches the shuffle as one row
    per map task.
    """
    since = F.coalesce(window.since_start("item_date") | window.since_start("updated_datetime"), F.lit(False))
    past = F.coalesce(F.col("item_date") <= moment(window.start), F.lit(False))
    items = landing["lms_payment_schedule_items"].filter(
        F.col("status").isin(*V.COLLECTED_ITEM) & (F.col("item_type") == "D")
    )
    per_schedule = items.groupBy("payment_schedule_id").agg(
        *[F.sum(F.when(past, F.col(c))).alias(f"a_{c}") for c in ITEM_AMOUNTS],
        *[F.sum(F.when(since, F.col(c)) if parity else F.col(c)).alias(f"o_{c}") for c in ITEM_AMOUNTS],
        F.bool_or(past).alias("_counts_active"), F.bool_or(since).alias("_counts_other"),
    )
    schedules = landing["lms_payment_schedules"].filter("is_collections = 1").select("payment_schedule_id", "base_loan_id")
    return per_schedule.join(schedules, "payment_schedule_id").groupBy("base_loan_id").agg(
        *[F.sum(f"{side}_{c}").cast(C.MONEY).alias(f"{side}_{c}") for side in "ao" for c in ITEM_AMOUNTS],
        F.bool_or("_counts_active").alias("_counts_active"), F.bool_or("_counts_other").alias("_counts_other"),
    )


def _own_sums(prefix: str = "") -> list[Column]:
    """Of both sums those that the loan's activity selects."""
    return [F.when(F.col("_active"), F.col(f"a_{c}")).otherwise(F.col(f"o_{c}")).alias(f"{prefix}{c}") for c in ITEM_AMOUNTS]


def _counted() -> Column:
    return F.when(F.col("_active"), F.col("_counts_active")).when(~F.col("_active"), F.col("_counts_other"))


def collected_by_status(landing: Tables, window: ChangeWindow, parity: bool = False) -> DataFrame:
    """Collected amounts of active and other loans in one table; a loan is one of the two."""
    sums = collected_sums(landing, window, parity).join(loan_activity(landing), "base_loan_id")
    return sums.filter(_counted()).select("base_loan_id", *_own_sums(), "_active")


def collected_amounts(landing: Tables, window: ChangeWindow, active: bool, parity: bool = False) -> DataFrame:
    """Collected amounts of the active loans, or of the others."""
    return collected_by_status(landing, window, parity).filter(F.col("_active") == active).drop("_active")


# --- open cure records -----------------------------------------------------------------

def newest_cures(landing: Tables) -> DataFrame:
    """Newest enabled, uncured record per loan with its notice email."""
    cures = landing["lms_collection_cure_info"].select(
        "base_loan_id", "lms_collection_cure_info_id", "rtc_notice", "default_time", "is_cured", "cure_date", "is_enabled"
    )
    newest = latest_by(cures, ["base_loan_id"], "lms_collection_cure_info_id", F.expr("is_cured = 0 AND is_enabled = 1"))
    emails = dedupe_latest(landing["lms_deferred_outgoing_email"].select(
        F.col("lms_deferred_outgoing_email_id").alias("rtc_notice"), "outgoing_date", "is_sent"
    ), ["rtc_notice"], ["outgoing_date"])
    return newest.join(emails, "rtc_notice").select(
        "base_loan_id",
        F.col("lms_collection_cure_info_id").alias("_cure_id"), F.col("rtc_notice").alias("_notice_id"),
        F.col("outgoing_date").cast("date").alias("_outgoing_date"), F.col("default_time").cast("date").alias("_default_date"),
        F.col("is_sent").alias("_sent"), F.col("is_cured").alias("_cured"), F.col("cure_date").alias("_cure_date"),
    )


def loan_facts(landing: Tables, window: ChangeWindow, parity: bool = False) -> DataFrame:
    """Per loan whether it is active, what was collected (`_counted`: anything that counts) and its newest open cure record."""
    facts = loan_activity(landing).join(collected_sums(landing, window, parity), "base_loan_id", "left")
    facts = facts.join(newest_cures(landing), "base_loan_id", "left")
    cures = [c for c in facts.columns if c in CURES]
    return facts.select("base_loan_id", "_active", F.coalesce(_counted(), F.lit(False)).alias("_counted"), *_own_sums("_sum_"), *cures)


def attach_facts(facts: DataFrame):
    return lambda target: target.join(facts, "base_loan_id", "left")


def attach_status(landing: Tables):
    status = landing["collections"].select(
        "collection_id", F.col("status_code").alias("_status_code"), F.col("sub_status_code").alias("_sub_status_code")
    )
    return attach_latest(status, ["collection_id"])


# --- corrections ------------------------------------------------------------------------

def collection_updates(window: ChangeWindow, now: str, parity: bool = False) -> list[Update]:
    """Corrections in order; the active amounts carry the start as processing time, all others `now`."""
    collected = {name: F.col(f"_sum_{c}") for name, c in (COLLECTED_FROM_PARITY if parity else COLLECTED_FROM).items()}
    processed = window.since_start("process_timestamp")
    stamp = {"process_timestamp": moment(now)}
    outstanding = {
        f"outstanding_{a}_amount": C.remaining(f"{a}_amount", f"collected_{a}_amount", zero_default=a != "total")
        for a in S.AMOUNTS
    }
    cures = {
        "open_cure_info_id": F.col("_cure_id"), "open_rtc_notice_id": F.col("_notice_id"),
        "rtc_outgoing_date": F.col("_outgoing_date"), "rtc_default_date": F.col("_default_date"),
        "rtc_sent_flag": F.col("_sent"), "rtc_cured_flag": F.col("_cured"), "rtc_cure_date": F.col("_cure_date"),
    }
    differs = diverges([
        (F.col("status_code"), F.col("_status_code")), (F.col("sub_status_code"), F.col("_sub_status_code")),
    ])
    return [
        Update("collected_active", ("facts",), F.col("_counted") & F.col("_active"), collected | {"process_timestamp": moment(window.start)}),
        Update("collected_inactive", ("facts",), F.col("_counted") & ~F.col("_active"), collected | stamp),
        Update("outstanding", (), processed, outstanding | stamp),
        Update("rtc_cure", ("facts",), processed & F.col("_active") & F.col("_cure_id").isNotNull(), cures | stamp),
        Update("status_sync", ("status",), differs, {"status_code": F.col("_status_code"), "sub_status_code": F.col("_sub_status_code")}),
    ]


def correct_collections(
    landing: Tables, target: DataFrame, window: ChangeWindow, now: str, parity: bool = False,
    only: tuple[str, ...] | None = None, purged: bool = False,
) -> tuple[DataFrame, list[Update]]:
    """The target after its corrections, or the named ones. Amounts reach loans that landing maps to a collection; `purged`
    says that the rows of all others are marked as deleted already."""
    updates = [u for u in collection_updates(window, now, parity) if only is None or u.name in only]
    facts = loan_facts(landing, window, parity)
    if not purged:
        facts = mark_present(facts, landing["collection_lms_loan_map"], ["base_loan_id"], "_mapped")
        facts = facts.withColumn("_counted", F.col("_counted") & F.col("_mapped")).drop("_mapped")
    return apply_updates(target, updates, {"facts": attach_facts(facts), "status": attach_status(landing)}), updates


def collection_job(
    landing: Tables, target: DataFrame, window: ChangeWindow, now: str, parity: bool = False, small_source: bool = False
) -> JobResult:
    """Merge, purge and corrections. Purged rows stay flagged in the plan until it is written."""
    merged = collection_merge(landing, target, window, now, small_source)
    if parity:
        gone = purged_pairs(landing, merged)
        flagged = mark_present(merged, gone, ["collection_id"], DELETED)
    else:
        flagged = mark_present(merged, landing["collection_lms_loan_map"], KEYS, "_in_landing").withColumn(
            DELETED, ~F.col("_in_landing")
        )
    corrected, updates = correct_collections(landing, flagged, window, now, parity, purged=True)
    kept = [Step(s.name, s.kind, s.counts & ~F.col(DELETED)) for s in update_steps(updates)]
    steps = (merge_step(), Step("purge", "Delete", F.col(DELETED)), *kept)
    return JobResult(corrected, target.columns, steps, keys=tuple(KEYS))
