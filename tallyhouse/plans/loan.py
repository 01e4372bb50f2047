"""dim_loan: loans with their headers, then the corrections that follow the merge."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions import cleaning as C
from tallyhouse.functions.change_window import ChangeWindow, changed, changed_keys, moment
from tallyhouse.operators.correct import Attach, Update, apply_updates, attach_latest
from tallyhouse.operators.lookup import dedupe_latest, eav_by_column, eav_indirect, first_by, latest_by, max_by_key
from tallyhouse.operators.modify import append_rows, diverges, merge_landed, merge_upsert, one_landed_row, update_where
from tallyhouse.operators.presence import mark_present, only_in_both, only_in_left
from tallyhouse.plans.job import merge_step, OP, JobResult, SlicedTables, Tables, update_steps
from tallyhouse.sources import schemas as S
from tallyhouse.sources.store import Part, slice_of, WHOLE

KEYS = ["base_loan_id"]
# Landing tables by their column of the header, and of the loan: what a job cut into slices of either reads one slice of.
BY_HEADER = {name: "loan_header_id" for name in ("lms_base_loans", "lms_loan_header", "lms_loanheader_state")}
BY_LOAN = {name: "base_loan_id" for name in (
    "lms_base_loans", "collection_lms_loan_map", "loc_fee_structure", "lms_loan_entity_parameters")}

# Columns of the base row that corrections read.
BASE_FACTS = ["loan_status", "loan_amount", "loan_type", "effective_date", "updated_datetime", "loan_interest_pct"]


def first_open_time(landing: Tables) -> DataFrame:
    """Time of the first `open` action per header."""
    opened = landing["lms_loanheader_state"].select("loan_header_id", "id", "action_time", "action")
    first = first_by(opened, ["loan_header_id"], "id", F.col("action") == "open")
    return first.select("loan_header_id", F.col("action_time").alias("agent_open_time"))


def loan_source(landing: Tables, window: ChangeWindow, now: str, narrow_first: bool = True) -> DataFrame:
    """Loans whose header or base row changed in the window.

    The window spans two tables, which no scan can apply. With `narrow_first` the changed
    header ids are collected from both scans and both tables are cut down to them before
    they meet; the exact condition still holds after the join.
    """
    base, header = landing["lms_base_loans"], landing["lms_loan_header"]
    opened = first_open_time(landing)
    if narrow_first:
        keys = changed_keys(window, "loan_header_id", (header, ["last_update"]), (base, ["updated_datetime"]))
        base, header, opened = (only_in_both(t, keys, ["loan_header_id"], right_unique=True) for t in (base, header, opened))
    joined = _with_lookups(landing, base.alias("b").join(header.alias("h"), F.col("b.loan_header_id") == F.col("h.loan_header_id")), opened)
    return joined.filter(changed(window, "h.last_update", "b.updated_datetime")).select(*_loan_columns(now))


def _with_lookups(landing: Tables, loans: DataFrame, opened: DataFrame) -> DataFrame:
    """Loans (b) with headers (h), and what describes them: first opening (f), entity (e), organization (o), risk level (r)."""
    entities = landing["lms_entities"].select("lms_entity_id", "entity_name", "organization_id").alias("e")
    organizations = landing["upm_organizations"].select("organization_id", "organization_name").alias("o")
    levels = landing["risk_level"].select("id", "risk_code", "description").alias("r")
    return (
        loans.join(opened.alias("f"), F.col("h.loan_header_id") == F.col("f.loan_header_id"), "left")
        .join(entities, F.col("h.lms_entity_id") == F.col("e.lms_entity_id"), "left")
        .join(organizations, F.col("e.organization_id") == F.col("o.organization_id"), "left")
        .join(levels, F.col("h.risk_level_id") == F.col("r.id"), "left")
    )


def _loan_columns(now: str) -> list[Column]:
    special = {
        "origination_date": C.date_of("b.origination_date", "h.origination_timestamp"),
        "loan_status": C.loan_status("h.status", "b.loan_status"),
        **{name: C.or_zero(f"h.{name}") for name in ("is_nc_auto_fund", "is_nc_auto_fund_flow", "is_auto_fund")},
    }

    def taken(side: str, names: list[str]) -> list[Column]:
        return [special.get(name, F.col(f"{side}.{name}")).alias(name) for name in names]

    return [
        *taken("b", S.LOAN_BASE_PASS), *taken("h", S.LOAN_HEADER_PASS),
        F.lit(V.LMS_CODE).alias("lms_code"), F.col("e.entity_name"), F.col("e.organization_id"), F.col("o.organization_name"),
        F.col("h.status").alias("lms_status"), F.col("r.risk_code"),
        F.col("r.description").alias("risk_level_description"), F.col("f.agent_open_time"),
        moment(now).alias("process_timestamp"),
    ]


def _base_facts(side: str = "") -> list[Column]:
    return [F.lit(True).alias("_in_base"), *[F.col(f"{side}{c}").alias(f"_base_{c}") for c in BASE_FACTS]]


FACTS = ["_in_base", *[f"_base_{c}" for c in BASE_FACTS]]
CHANGED = "_changed"


def landed_loans(landing: Tables, window: ChangeWindow, now: str) -> DataFrame:
    """The rows of the base loans: what the merge writes if the loan or its header changed, and the facts corrections need.

    Columns of loans that did not change are null, so that they weigh little in the shuffle.
    """
    base, header = landing["lms_base_loans"].alias("b"), landing["lms_loan_header"].alias("h")
    joined = base.join(header, F.col("b.loan_header_id") == F.col("h.loan_header_id"), "left")
    is_changed = F.col("h.loan_header_id").isNotNull() & changed(window, "h.last_update", "b.updated_datetime")
    rows = _with_lookups(landing, joined, first_open_time(landing)).select(
        *_loan_columns(now), *_base_facts("b."), F.coalesce(is_changed, F.lit(False)).alias(CHANGED))
    written = [c for c in rows.columns if c not in (*KEYS, *FACTS, CHANGED)]
    return rows.select(*KEYS, CHANGED, *[F.when(F.col(CHANGED), F.col(c)).alias(c) for c in written], *FACTS)


def loan_merge(landing: Tables, target: DataFrame, window: ChangeWindow, now: str, small_source: bool = False) -> DataFrame:
    return merge_upsert(
        target, loan_source(landing, window, now), KEYS, S.INSERT_ONLY["dim_loan"],
        small_source=small_source, op_column=OP,
    )


# --- staged interest rates -------------------------------------------------------------

def _line_of_credit_loans(landing: Tables, window: ChangeWindow, first_risk_level: bool) -> DataFrame:
    """Line-of-credit loans of the interest organizations, by the risk level of their header."""
    loans = landing["lms_base_loans"].filter(F.col("loan_type") == "loc").select("base_loan_id", "customer_id", "loan_header_id")
    customers = landing["lms_customer_info_flat"].filter(
        F.col("organization_id").isin(*V.INTEREST_ORGANIZATIONS)
    ).select("customer_id")
    level = F.col("risk_level_id")
    headers = landing["lms_loan_header"].filter(
        window.since_start("created_date") & ((level == 1) if first_risk_level else (level != 1))
    ).select("loan_header_id")
    return loans.join(headers, "loan_header_id").join(customers, "customer_id").select("base_loan_id")


def _parameters(landing: Tables) -> DataFrame:
    return landing["lms_loan_entity_parameters"].select("base_loan_id", "id", "parameter_name", "value")


def _rates(landing: Tables, loans: DataFrame, codes: DataFrame) -> DataFrame:
    rates = eav_by_column(
        _parameters(landing), codes, "base_loan_id", "daily_interest_code", "parameter_name", "value"
    )
    return loans.join(rates, "base_loan_id").select("base_loan_id", F.col("parameter_value").alias("loan_interest_pct"))


def latest_fee_code(landing: Tables) -> DataFrame:
    """Interest code of the newest fee-structure row per loan."""
    fees = landing["loc_fee_structure"].select("base_loan_id", "id", "daily_interest_code")
    return latest_by(fees, ["base_loan_id"], "id").select("base_loan_id", "daily_interest_code")


def interest_fee_other_risk(landing: Tables, window: ChangeWindow) -> DataFrame:
    """Scenario 1: other risk levels, the rate named by the newest fee structure."""
    return _rates(landing, _line_of_credit_loans(landing, window, False), latest_fee_code(landing))


def interest_no_fee(landing: Tables, window: ChangeWindow) -> DataFrame:
    """Scenario 2: risk level 1 without a fee structure, the rate named by the loan's model."""
    loans = only_in_left(_line_of_credit_loans(landing, window, True), landing["loc_fee_structure"], ["base_loan_id"])
    rates = eav_indirect(_parameters(landing), "base_loan_id", V.INTEREST_MODEL, V.INTEREST_PREFIX, "parameter_name", "value")
    return loans.join(rates, "base_loan_id").select("base_loan_id", F.col("parameter_value").alias("loan_interest_pct"))


def interest_fee_first_risk(landing: Tables, window: ChangeWindow, parity: bool = False) -> DataFrame:
    """Scenario 3: risk level 1 with a fee structure.

    `parity` takes the fee row whose id equals the loan's greatest parameter id, though
    the two ids number different tables; otherwise the newest fee row is taken.
    """
    if parity:
        newest = _parameters(landing).groupBy("base_loan_id").agg(F.max("id").alias("id"))
        fees = landing["loc_fee_structure"].select("base_loan_id", "id", "daily_interest_code")
        codes = fees.join(newest, ["base_loan_id", "id"]).select("base_loan_id", "daily_interest_code")
    else:
        codes = latest_fee_code(landing)
    return _rates(landing, _line_of_credit_loans(landing, window, True), codes)


def staged_interest(landing: Tables, window: ChangeWindow, parity: bool = False) -> DataFrame:
    """The distinct rates of the three scenarios."""
    return (
        interest_fee_other_risk(landing, window)
        .unionByName(interest_no_fee(landing, window))
        .unionByName(interest_fee_first_risk(landing, window, parity))
        .distinct()
    )


# --- corrections ------------------------------------------------------------------------

def newest_collection(landing: Tables) -> DataFrame:
    """The newest collection entry per loan."""
    entries = landing["collection_lms_loan_map"].select(
        "base_loan_id", "update_timestamp", "collection_id", "delinquency_date", "create_timestamp", "fully_defaulted_date"
    )
    return dedupe_latest(entries, ["base_loan_id"], ["update_timestamp"])


def last_status_changes(landing: Tables) -> DataFrame:
    """Last change to delinquent and to default per header, in one pass."""
    status = F.col("to_status")
    return max_by_key(landing["loan_status_change_history"], ["loan_header_id"], {
        "_last_delinquent": (status == "Delinquent", "change_date"),
        "_last_default": (status.like(V.DEFAULT_PREFIX), "change_date"),
    })


def _join(extra: DataFrame, key: str, target: DataFrame) -> DataFrame:
    return target.join(extra, key, "left")


def loan_attachments(
    landing: Tables, window: ChangeWindow, parity: bool, rates: DataFrame | None = None
) -> dict[str, Attach]:
    """What corrections read, by loan, header and campaign. `rates`: the staged interest rates, if they are written already."""
    base = landing["lms_base_loans"].select("base_loan_id", *_base_facts())
    header = landing["lms_loan_header"].select(
        "loan_header_id", F.lit(True).alias("_in_header"), F.col("status").alias("_header_status"),
        F.col("last_update").alias("_header_updated"),
    )
    collection = newest_collection(landing).select(
        "base_loan_id", F.lit(True).alias("_in_collection"),
        *[F.col(c).alias(f"_col_{c}") for c in ("delinquency_date", "create_timestamp", "fully_defaulted_date")],
    )
    # A loan may have several staged rates; the greatest readable one is taken.
    rates = staged_interest(landing, window, parity) if rates is None else rates
    staged = rates.groupBy("base_loan_id").agg(
        F.max(F.col("loan_interest_pct").try_cast("decimal(18,6)")).alias("_staged_rate")
    )
    leads = landing["lead_source"].select(
        F.col("lead_source_id").alias("campaign_id"), F.col("description").alias("_lead_description")
    )
    return {
        "base": attach_latest(base, ["base_loan_id"], ["_base_updated_datetime"]),
        "collection": partial(_join, collection, "base_loan_id"),
        "staged": partial(_join, staged, "base_loan_id"),
        "header": attach_latest(header, ["loan_header_id"], ["_header_updated"]),
        "history": partial(_join, last_status_changes(landing), "loan_header_id"),
        "leads": attach_latest(leads, ["campaign_id"]),
    }


def loan_updates(window: ChangeWindow, now: str, parity: bool = False, campaign_start: str = V.CAMPAIGN_START) -> list[Update]:
    """The corrections in the order they run.

    Without `parity` the status copy keeps a loan withdrawn while its header is, where
    the plain copy would undo the withdrawal set one step before.
    """
    processed = window.since_start("process_timestamp")
    changed_base = window.since_start("_base_updated_datetime")
    new_status = F.col("_base_loan_status") if parity else C.loan_status("_header_status", "_base_loan_status")
    both_known = F.col("_in_base") & F.col("_in_header")
    differs = diverges([(F.col("lms_status"), F.col("_header_status")), (F.col("loan_status"), new_status)])
    copied = {"lms_status": F.col("_header_status"), "loan_status": new_status}
    updates = [
        Update("campaign", ("leads",),
               processed & (F.col("process_timestamp") >= moment(campaign_start))
               & (F.col("campaign_id") > 0) & F.col("campaign_name").isNull(),
               {"campaign_name": F.col("_lead_description")}),
        Update("withdraw", (), processed & C.withdrawable("lms_status", "loan_status"), {"loan_status": F.lit(V.WITHDRAW)}),
        Update("status_sync", ("base", "header"), processed & both_known & differs, copied),
        Update("withdrawn_ts", (),
               processed & (F.col("loan_status") == V.WITHDRAW) & F.col("withdrawn_timestamp").isNull(),
               {"withdrawn_timestamp": F.col("last_update")}),
        Update("amount_sync", ("base",), diverges([(F.col("loan_amount"), F.col("_base_loan_amount"))]),
               {"loan_amount": F.col("_base_loan_amount")}),
        Update("clear_dates", ("base",), processed & (F.col("_base_loan_status") == "Originated"),
               {"delinquent_date": F.lit(None), "default_date": F.lit(None)}),
        Update("delinquent_date", ("base", "collection"),
               F.col("_in_collection") & (F.col("_base_loan_status") == "Delinquent") & changed_base,
               {"delinquent_date": C.date_of("_col_delinquency_date", "_col_create_timestamp"), "default_date": F.lit(None)}),
        Update("default_dates", ("base", "collection", "history"),
               F.col("_in_collection") & F.col("_base_loan_status").like(V.DEFAULT_PREFIX) & changed_base,
               {"delinquent_date": C.date_of("_col_delinquency_date", "_last_delinquent"),
                "default_date": C.date_of("_col_fully_defaulted_date", "_last_default")}),
        Update("interest_installment", ("base",),
               (F.col("organization_id") == V.INSTALLMENT_ORGANIZATION) & (F.col("_base_loan_type") == "install")
               & window.since_start("_base_effective_date"),
               {"loan_interest_pct": F.col("_base_loan_interest_pct")}),
        Update("interest_loc", ("staged",),
               F.col("organization_id").isin(*V.INTEREST_ORGANIZATIONS) & (F.col("loan_type") == "loc")
               & F.col("_staged_rate").isNotNull(),
               {"loan_interest_pct": F.col("_staged_rate")}),
    ]
    if int(now[11:13]) == V.NIGHTLY_HOUR:
        nightly = Update("status_sync_nightly", ("base", "header"), both_known & differs, copied)
        updates.insert(3, nightly)
    return updates


def correct_loans(
    landing: Tables, target: DataFrame, window: ChangeWindow, now: str, parity: bool = False,
    only: tuple[str, ...] | None = None, campaign_start: str = V.CAMPAIGN_START,
) -> tuple[DataFrame, list[Update]]:
    """The target after its corrections, or after the named ones only."""
    updates = [u for u in loan_updates(window, now, parity, campaign_start) if only is None or u.name in only]
    return apply_updates(target, updates, loan_attachments(landing, window, parity)), updates


# --- reject log -------------------------------------------------------------------------

def orphan_headers(landing: Tables, window: ChangeWindow, now: str, reject_log: DataFrame | None = None) -> DataFrame:
    """Headers created since the start that have no base loan, as reject rows.

    Given the reject log, headers that are open in it are not logged again.
    """
    headers = landing["lms_loan_header"].filter(window.since_start("created_date")).select("loan_header_id")
    orphans = only_in_left(headers, landing["lms_base_loans"], ["loan_header_id"], right_unique=True)
    rows = orphans.select(
        F.lit(V.ORPHAN_TABLE).alias("table_name"), F.lit(V.ORPHAN_COLUMN).alias("column_name"),
        F.col("loan_header_id").cast("string").alias("column_value"),
        F.lit(V.ORPHAN_REASON).alias("reject_reason"), F.lit(now).cast("timestamp_ntz").cast("date").alias("process_datetime"),
    )
    if reject_log is None:
        return rows
    still_open = reject_log.filter(_about_headers() & (F.coalesce("is_fixed", F.lit(0)) != 1))
    return only_in_left(rows, still_open, ["column_value"])


def _about_headers():
    return (F.col("table_name") == V.ORPHAN_TABLE) & (F.col("column_name") == V.ORPHAN_COLUMN)


LOGGED_ID = "_logged_id"


def logged_headers(reject_log: DataFrame) -> DataFrame:
    """The log with the header id each row names as a number; null where its text is not that of one."""
    number = F.col("column_value").try_cast("bigint")
    return reject_log.withColumn(LOGGED_ID, F.when(number.cast("string") == F.col("column_value"), number))


def mark_logged(logged: DataFrame, table: DataFrame, flag: str) -> DataFrame:
    """`logged` with a flag telling whether `table` has the header.

    The table's ids are cut down to those of the log before anything is shuffled: a log below the broadcast limit
    leaves a table of any size where it is.
    """
    known = logged.select(F.col(LOGGED_ID).alias("loan_header_id")).filter(F.col(LOGGED_ID).isNotNull()).distinct()
    met = only_in_both(table.select("loan_header_id"), known, ["loan_header_id"], right_unique=True)
    return mark_present(logged, met.select(F.col("loan_header_id").alias(LOGGED_ID)), [LOGGED_ID], flag)


def without_header(landing: Tables, reject_log: DataFrame) -> DataFrame:
    """The rows of the log whose header is gone."""
    marked = mark_logged(logged_headers(reject_log), landing["lms_loan_header"], "_header")
    return marked.filter(~F.col("_header")).select(*reject_log.columns)


def resolve_rejects(landing: Tables, reject_log: DataFrame, now: str, parity: bool = False) -> DataFrame:
    """Mark logged headers as fixed once the header is gone, or a base loan has arrived.

    `parity` looks at the header alone and stamps rows that are fixed already again.
    """
    marked = mark_logged(logged_headers(reject_log), landing["lms_loan_header"], "_header")
    fixed = ~F.col("_header")
    if not parity:
        marked = mark_logged(marked, landing["lms_base_loans"], "_loan")
        fixed = (fixed | F.col("_loan")) & (F.coalesce("is_fixed", F.lit(0)) != 1)
    changes = {"is_fixed": F.lit(1), "fixed_date": F.lit(now).cast("timestamp_ntz").cast("date")}
    return update_where(marked, _about_headers() & fixed, changes).select(*reject_log.columns)


def loan_job(
    landing: Tables, target: DataFrame, reject_log: DataFrame, window: ChangeWindow, now: str,
    parity: bool = False, campaign_start: str = V.CAMPAIGN_START, rates: DataFrame | None = None,
    landed: DataFrame | None = None, part: Part = WHOLE,
) -> JobResult:
    """Merge and corrections in one pass over the target and over each landing table.

    Loans meet their landing rows once, by a full outer join that updates, inserts and brings what corrections need of the
    base row; the other tables are reduced to small ones keyed by loan, header or campaign and joined onto the result.
    The header is read a second time, by two columns, for a loan's row may name another header than its landing row.
    `rates`: `staged_interest` as written before the job (see `Warehouse.staged`), else it is planned here and appended.
    `landed`: `landed_loans` likewise. `part`: the slice of loans to load; side tables are whole and come with the first.
    """
    landed = landed_loans(landing, window, now) if landed is None else landed
    single = one_landed_row(slice_of(landed, KEYS, part), KEYS, CHANGED, FACTS, ["_base_updated_datetime"])
    merged = merge_landed(
        slice_of(target, KEYS, part), single, KEYS, CHANGED, FACTS, S.INSERT_ONLY["dim_loan"], op_column=OP)
    updates = loan_updates(window, now, parity, campaign_start)
    own_rates = None if rates is None else slice_of(rates, KEYS, part)
    attach = loan_attachments(SlicedTables(landing, BY_LOAN, part), window, parity, own_rates)
    del attach["base"]
    flagged = apply_updates(merged, updates, attach).select(*target.columns, OP, *[update.flag for update in updates])
    side = {}
    if part[0] == 0:
        resolved = resolve_rejects(landing, reject_log, now, parity)
        orphans = orphan_headers(landing, window, now, None if parity else resolved)
        side["reject_log"] = append_rows(resolved, orphans)
        if rates is None:
            side["stg_loan_interest_pct"] = staged_interest(landing, window, parity)
    return JobResult(flagged, target.columns, (merge_step(), *update_steps(updates)), side, tuple(KEYS))
