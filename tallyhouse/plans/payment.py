"""dim_payment_schedule: schedule items, their failure dates, and items gone from landing."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions import cleaning as C
from tallyhouse.functions.change_window import ChangeWindow, changed, moment, recent
from tallyhouse.operators.correct import Attach, Update, apply_updates, attach_latest
from tallyhouse.operators.lookup import eav
from tallyhouse.operators.modify import merge_upsert
from tallyhouse.operators.presence import only_in_left
from tallyhouse.plans.job import DELETED, merged_rows, OP, JobResult, SlicedTables, Step, Tables, update_steps
from tallyhouse.sources import schemas as S
from tallyhouse.sources.store import Part, slice_of, WHOLE

KEYS = ["payment_schedule_item_id"]
ITEM = "payment_schedule_item_id"
# Landing tables with rows of single items, by their column of the item: a job cut into slices of items reads one of each.
BY_ITEM = {
    "lms_payment_schedule_items": ITEM, "ach_transactions": "lms_payment_schedule_item_id", "funding_payment_return": ITEM,
    "lms_payment_schedule_item_metadata": ITEM,
}
# The merge source joins items and schedules, by this column of both.
BY_SCHEDULE = {"lms_payment_schedule_items": "payment_schedule_id", "lms_payment_schedules": "payment_schedule_id"}


def payment_items(landing: Tables) -> DataFrame:
    """The join chain of schedules, loans, customers and items, all columns kept apart by alias."""
    loans = landing["lms_base_loans"].select("base_loan_id", F.col("customer_id").alias("loan_customer_id"))
    customers = landing["lms_customer_info_flat"].select(F.col("customer_id").alias("loan_customer_id"), "organization_id")
    schedules = landing["lms_payment_schedules"].select("payment_schedule_id", *S.SCHEDULE_PASS)
    owned = schedules.join(loans, "base_loan_id").join(customers, "loan_customer_id").drop("loan_customer_id")
    return landing["lms_payment_schedule_items"].join(owned, "payment_schedule_id")


def payment_source(landing: Tables, window: ChangeWindow, now: str) -> DataFrame:
    """Items changed in the window that belong to a tenant slice, all slices in one pass."""
    special = {
        "item_type": C.item_type("item_type", "total_amount", "status"),
        "payment_failed_date": F.col("payment_failed_date").cast("timestamp_ntz"),
        "is_active": C.or_zero("is_active"),
        "is_collections": C.or_zero("is_collections"),
    }
    names = [*S.ITEM_PASS, *S.SCHEDULE_PASS, "organization_id"]
    return (
        payment_items(landing)
        .filter(changed(window, *S.CHANGE_COLUMNS) & C.org_slice("organization_id").isNotNull())
        .select(*[special.get(n, F.col(n)).alias(n) for n in names], moment(now).alias("process_timestamp"))
    )


def payment_merge(
    landing: Tables, target: DataFrame, window: ChangeWindow, now: str, small_source: bool = False, part: Part = WHOLE,
) -> DataFrame:
    return merge_upsert(
        target, payment_source(landing, window, now), KEYS, S.INSERT_ONLY["dim_payment_schedule"],
        small_source=small_source, op_column=OP, part=part,
    )


def merged_per_slice(merged: DataFrame) -> DataFrame:
    """Rows a merge touched, per tenant slice and kind."""
    touched = merged.filter(merged_rows())
    return touched.groupBy(C.org_slice("organization_id").alias("org_slice"), F.col(OP).alias("op")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def merge_steps() -> tuple[Step, ...]:
    """The merge as one logged step per tenant slice; slices never overlap, so one plan counts them all."""
    return tuple(
        Step(f"merge slice {k}", "Merge", merged_rows() & (C.org_slice("organization_id") == k)) for k in V.ORG_SLICES)


# --- corrections ------------------------------------------------------------------------

def ach_returns(landing: Tables) -> DataFrame:
    """Latest bank transaction time per item."""
    return landing["ach_transactions"].groupBy(F.col("lms_payment_schedule_item_id").alias(ITEM)).agg(
        F.max("update_datetime").alias("_ach_time")
    )


def funding_returns(landing: Tables) -> DataFrame:
    """Latest readable return time per item."""
    return landing["funding_payment_return"].groupBy(ITEM).agg(F.max(C.failure_time("return_time")).alias("_return_time"))


def tracking_ids(landing: Tables) -> DataFrame:
    metadata = landing["lms_payment_schedule_item_metadata"]
    return eav(metadata, [ITEM], {"_tracking_id": V.TRACKING_NAME}, "name", "value")


def _join(extra: DataFrame, target: DataFrame) -> DataFrame:
    return target.join(extra, ITEM, "left")


def payment_attachments(landing: Tables) -> dict[str, Attach]:
    items = landing["lms_payment_schedule_items"].select(
        ITEM, F.col("auxiliary_type").alias("_item_auxiliary_type"), F.lit(True).alias("_in_landing"),
        F.col("updated_datetime").alias("_item_updated"),
    )
    return {
        "items": attach_latest(items, [ITEM], ["_item_updated"]),
        "ach": partial(_join, ach_returns(landing)),
        "funding": partial(_join, funding_returns(landing)),
        "metadata": partial(_join, tracking_ids(landing)),
    }


def _is_card() -> Column:
    return (F.col("payment_mode") == V.NON_ACH) | F.col("payment_mode").like(V.CARD_PATTERN)


def payment_updates(window: ChangeWindow) -> list[Update]:
    """Failure dates first, cleared items before failed ones, then the copied attributes."""
    fresh = recent(window, "item_date", "process_timestamp")
    unset = F.col("payment_failed_date").isNull()
    failed = fresh & F.col("status").isin(*V.FAILED_ITEM) & unset
    processed = window.since_start("process_timestamp")

    def failure(name: str, needs: tuple[str, ...], condition: Column, when: Column) -> Update:
        return Update(name, needs, condition, {"payment_failed_date": when.cast("timestamp_ntz")})

    return [
        failure("failed_clear", (), fresh & F.col("status").isin(*V.COLLECTED_ITEM) & ~unset, F.lit(None)),
        failure("failed_card", (), failed & _is_card(), F.date_add("item_date", V.CARD_FAILURE_DAYS)),
        failure("failed_ach", ("ach",), failed & F.col("_ach_time").isNotNull(), F.col("_ach_time").cast("date")),
        failure("failed_missed", (), failed & (F.col("status") == "MISSED"), F.col("item_date")),
        failure("failed_funding", ("funding",), failed & F.col("_return_time").isNotNull(), F.col("_return_time")),
        Update("auxiliary_sync", ("items",), processed & F.col("_in_landing"), {"auxiliary_type": F.col("_item_auxiliary_type")}),
        Update("tracking_id", ("metadata",), processed & F.col("_tracking_id").isNotNull(), {"subid_tracking_id": F.col("_tracking_id")}),
    ]


def correct_payments(
    landing: Tables, target: DataFrame, window: ChangeWindow, only: tuple[str, ...] | None = None
) -> tuple[DataFrame, list[Update]]:
    updates = [u for u in payment_updates(window) if only is None or u.name in only]
    return apply_updates(target, updates, payment_attachments(landing)), updates


def failed_cascade(landing: Tables, target: DataFrame, window: ChangeWindow) -> DataFrame:
    """The five failure-date steps as one expression over two lookups."""
    fresh = F.coalesce(recent(window, "item_date", "process_timestamp"), F.lit(False))
    card = F.when(_is_card(), F.date_add("item_date", V.CARD_FAILURE_DAYS)).cast("timestamp_ntz")
    ach = F.col("_ach_time").cast("date").cast("timestamp_ntz")
    missed = F.when(F.col("status") == "MISSED", F.col("item_date")).cast("timestamp_ntz")
    date = (
        F.when(fresh & F.col("status").isin(*V.COLLECTED_ITEM), F.lit(None).cast("timestamp_ntz"))
        .when(fresh & F.col("status").isin(*V.FAILED_ITEM), F.coalesce("payment_failed_date", card, ach, missed, "_return_time"))
        .otherwise(F.col("payment_failed_date"))
    )
    attach = payment_attachments(landing)
    joined = attach["funding"](attach["ach"](target))
    return joined.withColumn("payment_failed_date", date).select(*target.columns)


# --- items gone from landing --------------------------------------------------------------

def removed_items(
    landing: Tables, target: DataFrame, archive: DataFrame, window: ChangeWindow, parity: bool = False
) -> DataFrame:
    """Rows to archive: gone from landing and not archived yet.

    Every row that is deleted is archived; `parity` archives only items dated since the start.
    """
    removed = only_in_left(target, landing["lms_payment_schedule_items"], KEYS, right_unique=True)
    if parity:
        removed = removed.filter(window.since_start("item_date"))
    return only_in_left(removed, archive, KEYS)


def payment_job(
    landing: Tables, target: DataFrame, archive: DataFrame, window: ChangeWindow, now: str,
    parity: bool = False, small_source: bool = False, part: Part = WHOLE,
) -> JobResult:
    """Merge, corrections and purge in one plan, of all items or of one slice of them.

    All lookups are keyed by item, as the merge is, so the target is shuffled once. The
    join that copies the auxiliary type also tells which items landing still has. Items
    gone from landing are in no merge source, so the archive is built from them alone.
    """
    merged = payment_merge(landing, target, window, now, small_source, part)
    landing, target, archive = SlicedTables(landing, BY_ITEM, part), slice_of(target, KEYS, part), slice_of(archive, KEYS, part)
    corrected, updates = correct_payments(landing, merged, window)
    flagged = corrected.withColumn(DELETED, F.col("_in_landing").isNull())
    gone, _ = correct_payments(landing, removed_items(landing, target, archive, window, parity), window)
    return JobResult(
        flagged, target.columns,
        (*merge_steps(), *update_steps(updates), Step("delete_removed", "Delete", F.col(DELETED))),
        {"dim_payment_schedule_removed": gone.select(*target.columns)}, tuple(KEYS),
    )
