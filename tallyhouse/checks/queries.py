"""One query per operator, over the derived lending tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import values as V
from tallyhouse.functions import cleaning as C
from tallyhouse.functions.change_window import ChangeWindow, changed, changed_keys, moment, recent
from tallyhouse.functions.flatten import flatten_json
from tallyhouse.functions.standardize import standardize, unreadable_money
from tallyhouse.operators import lookup as L
from tallyhouse.operators import modify as M
from tallyhouse.operators.presence import only_in_both, only_in_left
from tallyhouse.plans import audit, collection, customer, insurance, job, loan, marts, payment, reconcile, rules
from tallyhouse.plans.job import OP
from tallyhouse.sources import reports, scan, store
from tallyhouse.sources import schemas as S
from tallyhouse.sources.derived import END, NIGHT, NOW, START, DerivedTables

W = ChangeWindow(START, END)
ITEM = "payment_schedule_item_id"
# The run is dated before the engine's fixed campaign start, so the queries use the window's.
CAMPAIGN_START = START

Query = Callable[[DerivedTables], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def presented(df: DataFrame) -> DataFrame:
    """Results as other engines hand them out: decimals as doubles, dates as timestamps."""
    def column(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        return F.col(field.name)

    return df.select(*[column(f) for f in df.schema.fields])


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under the checkpoint folder, else under the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/tables-{uuid.uuid4().hex}"


def item_slices(t: DerivedTables) -> int:
    return store.slices_of(t["lms_payment_schedule_items"].count())


def sliced(t: DerivedTables, count: int, build: Callable[[store.Part], DataFrame]) -> DataFrame:
    return store.in_slices(t.spark, f"{scratch(t.spark)}/slices", count, build)


# --- sources and sinks ------------------------------------------------------------------------

@query("scan_landing")
def _(t):
    loans = t["lms_base_loans"]
    return scan.plain_names(loans.toDF(*[f'"{c.upper()}"' for c in loans.columns]))


@query("scan_rdbms_window")
def _(t):
    return scan.read_source(t["lms_base_loans"], "created_datetime", START, END)


@query("scan_target_window")
def _(t):
    return scan.read_source(t["dim_loan"], "created_datetime", START, END)


@query("scan_add_cdc_columns")
def _(t):
    return scan.add_landing_columns(t["lms_loanheader_state"])


# Landing tables that are compared, in order, with their time column where they have one.
LANDING_MAP = {
    "collection_lms_loan_map": "create_timestamp",
    "collections": "created_timestamp",
    "lms_payment_schedules": None,
    "lms_base_loans": "created_datetime",
    "lms_payment_schedule_items": "created_datetime",
    "lms_collection_cure_info": "created_datetime",
    "lms_deferred_outgoing_email": "created_datetime",
    "lms_customer_info_flat": "created_date",
    "ach_transactions": "created_datetime",
    "funding_payment_return": "created_datetime",
    "lms_payment_schedule_item_metadata": "created_datetime",
    "upm_organizations": "created_datetime",
    "lms_loan_header": "created_date",
    "lms_entities": None,
    "risk_level": "created_datetime",
    "lms_loanheader_state": None,
    "lead_source": "start_datetime",
    "loan_status_change_history": None,
    "protection_plan": "created_datetime",
    "insurance_policy": "created_datetime",
    "insurance_provider": "created_datetime",
    "protection_plan_status": None,
    "protection_plan_status_log": "created_datetime",
}
# Warehouse tables that are compared, with the key of their rows.
DIMENSION_MAP = {
    "fct_collection_detail": "collection_id",
    "dim_payment_schedule": "payment_schedule_id",
    "dim_customer": "customer_id",
    "dim_payment_schedule_removed": "payment_schedule_id",
    "dim_loan": "base_loan_id",
    "dim_insurance_protection_plan": "protection_plan_id",
    "dim_insurance_protection_plan_status": "base_loan_id",
}


def landing_pairs(t: DerivedTables) -> list[reconcile.TablePair]:
    """Each landing table against its rows up to the end of the window, or against itself."""
    def target(name: str, column: str | None) -> DataFrame:
        return t[name].filter(F.col(column) <= moment("1999-06-30 00:00:00")) if column else t[name]

    return [
        reconcile.TablePair(f"source.{n}", f"landing.{n}", partial(t.__getitem__, n), partial(target, n, c), c, c)
        for n, c in LANDING_MAP.items()
    ]


def dimension_pairs(t: DerivedTables) -> list[reconcile.TablePair]:
    return [
        reconcile.TablePair(f"old.{n}", f"dwh.{n}", partial(t.__getitem__, n), partial(t.__getitem__, f"{n}_copy"), keys=(key,))
        for n, key in DIMENSION_MAP.items()
    ]


def query_pairs(t: DerivedTables) -> list[reconcile.TablePair]:
    """The join each warehouse table is built from, against the table."""
    def plans():
        return t["protection_plan"].join(t["insurance_policy"].select(F.col("id").alias("policy_id"), "insurance_provider_id"), "policy_id").join(
            t["insurance_provider"].select(F.col("id").alias("insurance_provider_id")), "insurance_provider_id")

    def statuses():
        return t["protection_plan_status"].join(
            t["protection_plan_status_log"].select(F.col("id").alias("protection_plan_status_log_id")), "protection_plan_status_log_id")

    sources = {
        "dim_insurance_protection_plan": plans,
        "dim_insurance_protection_plan_status": statuses,
        "fct_collection_detail": lambda: t["collection_lms_loan_map"].join(t["collections"].select("collection_id"), "collection_id"),
        "dim_payment_schedule": lambda: payment.payment_items(t),
        "dim_customer": lambda: t["lms_customer_info_flat"].join(t["upm_organizations"].select("organization_id"), "organization_id"),
        "dim_loan": lambda: t["lms_base_loans"].join(t["lms_loan_header"].select("loan_header_id"), "loan_header_id"),
    }
    return [reconcile.TablePair("query", f"dwh.{n}", s, partial(t.__getitem__, n)) for n, s in sources.items()]


@query("config_table_map")
def _(t):
    return reconcile.reconcile_all(landing_pairs(t), reconcile.count_summary, START, END)


@query("config_query_vs_table")
def _(t):
    return reconcile.reconcile_all(query_pairs(t), reconcile.count_summary)


@query("sink_snapshot")
def _(t):
    house = audit.Warehouse(t.spark, scratch(t.spark))
    table = "dim_insurance_protection_plan_status"
    house.write(table, t[table], tuple(insurance.STATUS_KEYS))
    # The second state is computed from the first one; partitions without a change stay as they are.
    house.load(table, insurance.status_job(t, house.read(table), NOW))
    return house.read(table)


@query("sink_append")
def _(t):
    path = f"{scratch(t.spark)}/reject_log"
    store.append(t["reject_log"], path)
    orphans = loan.orphan_headers(t, W, NOW)
    store.append(M.append_rows(t["reject_log"].limit(0), orphans), path)
    return t.spark.read.parquet(path)


@query("sink_truncate_load")
def _(t):
    path = f"{scratch(t.spark)}/stg_loan_interest_pct"
    store.truncate_load(loan.interest_no_fee(t, W), path)
    store.truncate_load(loan.staged_interest(t, W), path)
    return t.spark.read.parquet(path)


@query("sink_ctas")
def _(t):
    return collection.purged_pairs(t, t["fct_collection_detail"])


@query("sink_csv_report")
def _(t):
    path = f"{scratch(t.spark)}/summary"
    report = reconcile.reconcile_all(query_pairs(t), reconcile.count_summary)
    reports.write_csv_report(report, path)
    return t.spark.read.option("header", True).schema(report.schema).csv(path)


@query("sink_text_report")
def _(t):
    path = f"{scratch(t.spark)}/diff"
    diff = reconcile.keyed_diff(t["dim_customer"], t["dim_customer_copy"], ["customer_id"])
    reports.write_text_report(reconcile.diff_lines(diff, ["customer_id"]), path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


# --- projections and filters --------------------------------------------------------------

@query("project_rename")
def _(t):
    return M.project(t["lms_loan_header"], {**{c: c for c in S.LOAN_HEADER_PASS}, "header_id": "loan_header_id", "lms_status": "status"})


@query("project_literal")
def _(t):
    return t["lms_customer_info_flat"].select("customer_id", F.lit(V.LMS_CODE).alias("lms_code"))


@query("case_item_type")
def _(t):
    return t["lms_payment_schedule_items"].select(ITEM, "status", C.item_type("item_type", "total_amount", "status").alias("item_type"))


@query("case_loan_status")
def _(t):
    headers = t["lms_loan_header"].select("loan_header_id", "status")
    return t["lms_base_loans"].join(headers, "loan_header_id").select(
        "base_loan_id", C.loan_status("status", "loan_status").alias("loan_status"))


@query("case_paycheck_amount")
def _(t):
    return t["lms_customer_info_flat"].select(
        "customer_id", C.paycheck("paycheck_amount", "nmi", "payfrequency").cast("string").alias("paycheck_amount"))


@query("filter_change_window")
def _(t):
    return _changed_items(t).select(ITEM, *S.CHANGE_COLUMNS)


def _changed_items(t) -> DataFrame:
    """The items changed in the window, from landing files that are laid out by change, once a session and data folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in LANDED:
        path = f"{scratch(t.spark)}/lms_payment_schedule_items"
        scan.land_by_change(t["lms_payment_schedule_items"], path, S.CHANGE_COLUMNS, ["payment_schedule_id"], item_slices(t))
        LANDED[key] = path
    return scan.read_changed(t.spark, LANDED[key], W, S.CHANGE_COLUMNS)


LANDED: dict[tuple[str, str], str] = {}


@query("filter_change_window_two_tables")
def _(t):
    base = t["lms_base_loans"].select("base_loan_id", "loan_header_id", "updated_datetime")
    header = t["lms_loan_header"].select("loan_header_id", "last_update")
    keys = changed_keys(W, "loan_header_id", (header, ["last_update"]), (base, ["updated_datetime"]))
    base, header = (only_in_both(x, keys, ["loan_header_id"], right_unique=True) for x in (base, header))
    return base.join(header, "loan_header_id").filter(changed(W, "last_update", "updated_datetime"))


@query("filter_recent_guard")
def _(t):
    return t["dim_payment_schedule"].filter(recent(W, "item_date", "process_timestamp")).select(ITEM, "item_date", "process_timestamp")


@query("filter_org_slices")
def _(t):
    return t["lms_customer_info_flat"].groupBy(C.org_slice("organization_id").alias("org_slice")).agg(F.count(F.lit(1)).alias("row_count"))


@query("filter_in_lists")
def _(t):
    return t["lms_payment_schedule_items"].filter(
        F.col("status").isin(*V.FAILED_ITEM) & ~F.col("payment_mode").isin("ACH")
    ).select(ITEM, "status", "payment_mode")


@query("filter_like")
def _(t):
    return t["lms_payment_schedule_items"].filter(F.col("payment_mode").like(V.CARD_PATTERN)).select(ITEM, "payment_mode")


@query("filter_null_tests")
def _(t):
    return t["lms_payment_schedule_items"].filter(
        F.col("payment_failed_date").isNull() & F.col("item_type").isNotNull()
    ).select(ITEM, "item_type")


def _divergence(t, null_safe: bool) -> DataFrame:
    base = t["lms_base_loans"].select("base_loan_id", F.col("loan_status").alias("new_status"))
    differs = M.diverges([(F.col("loan_status"), F.col("new_status"))], null_safe)
    return t["dim_loan"].join(base, "base_loan_id").filter(differs).select("base_loan_id", "loan_status", "new_status")


QUERIES["filter_divergence"] = partial(_divergence, null_safe=False)
QUERIES["filter_divergence_null_safe"] = partial(_divergence, null_safe=True)


@query("filter_regex")
def _(t):
    return t["dim_customer"].filter(C.only_numeric("grossmonthly")).select("customer_id", "grossmonthly")


# --- joins and lookups -----------------------------------------------------------------------

@query("join_inner_lookup")
def _(t):
    names = t["upm_organizations"].select("organization_id", "organization_name")
    return t["lms_customer_info_flat"].select("customer_id", "organization_id").join(names, "organization_id")


@query("join_inner_chain")
def _(t):
    return payment.payment_items(t).select(ITEM, "payment_schedule_id", "base_loan_id", "organization_id")


@query("join_inner_left_chain")
def _(t):
    entities = t["lms_entities"].select("lms_entity_id", "entity_name", "organization_id")
    organizations = t["upm_organizations"].select("organization_id", "organization_name")
    levels = t["risk_level"].select(F.col("id").alias("risk_level_id"), "risk_code")
    header = t["lms_loan_header"].select("loan_header_id", "lms_entity_id", "risk_level_id")
    return (
        t["lms_base_loans"].select("base_loan_id", "loan_header_id").join(header, "loan_header_id")
        .join(entities, "lms_entity_id", "left").join(organizations, "organization_id", "left").join(levels, "risk_level_id", "left")
        .select("base_loan_id", "entity_name", "organization_name", "risk_code")
    )


@query("join_left_then_inner")
def _(t):
    plans = t["protection_plan"].select("id", "protection_plan_application_id")
    logs = t["protection_plan_status_log"].select("protection_plan_application_id", F.col("id").alias("protection_plan_status_log_id"))
    return plans.join(logs, "protection_plan_application_id", "left").join(
        t["protection_plan_status"], "protection_plan_status_log_id"
    ).select("id", "protection_plan_status_log_id", "base_loan_id")


@query("join_on_extra_predicate")
def _(t):
    items = t["lms_payment_schedule_items"].select(ITEM, F.col("payment_schedule_id").alias("item_schedule_id"))
    schedules = t["lms_payment_schedules"].select("payment_schedule_id", "base_loan_id", "is_collections")
    on = (F.col("payment_schedule_id") == F.col("item_schedule_id")) & (F.col("is_collections") == 1)
    return items.join(schedules, on).select(ITEM, "base_loan_id")


@query("join_implicit_where")
def _(t):
    loans = t["lms_base_loans"].filter(F.col("loan_status").isin(*V.ACTIVE_LOAN)).select("base_loan_id", "loan_status")
    entries = t["collection_lms_loan_map"].select("base_loan_id", F.col("collection_id").alias("map_collection_id"))
    return t["fct_collection_detail"].select("collection_id", "base_loan_id").join(loans, "base_loan_id").join(entries, "base_loan_id")


@query("anti_join_purged")
def _(t):
    return collection.purged_pairs(t, t["fct_collection_detail"])


@query("anti_join_removed")
def _(t):
    return only_in_left(t["dim_payment_schedule"].select(ITEM), t["lms_payment_schedule_items"], [ITEM], right_unique=True)


@query("anti_join_double")
def _(t):
    return payment.removed_items(t, t["dim_payment_schedule"], t["dim_payment_schedule_removed"], W).select(ITEM, "item_date")


@query("anti_join_orphan_header")
def _(t):
    return loan.orphan_headers(t, W, NOW).select("column_value")


@query("anti_not_exists")
def _(t):
    return only_in_left(t["lms_base_loans"].select("base_loan_id"), t["loc_fee_structure"], ["base_loan_id"])


@query("anti_count_zero")
def _(t):
    return loan.without_header(t, t["reject_log"]).select("column_value", "column_name")


@query("semi_in_subquery")
def _(t):
    gone = collection.purged_pairs(t, t["fct_collection_detail"])
    return only_in_both(t["fct_collection_detail"].select("collection_id", "base_loan_id"), gone, ["collection_id"])


@query("lookup_latest_by_max_id")
def _(t):
    cures = t["lms_collection_cure_info"].select("base_loan_id", "lms_collection_cure_info_id", "default_time", "is_cured")
    return L.latest_by(cures, ["base_loan_id"], "lms_collection_cure_info_id")


@query("lookup_first_by_order")
def _(t):
    return loan.first_open_time(t)


@query("lookup_correlated_max")
def _(t):
    return loan.last_status_changes(t).withColumnsRenamed({"_last_delinquent": "last_delinquent", "_last_default": "last_default"})


@query("lookup_scalar")
def _(t):
    leads = t["lead_source"].select(F.col("lead_source_id").alias("campaign_id"), "description")
    return M.update_from(
        t["lms_loan_header"].select("loan_header_id", "campaign_id", "campaign_name"), leads, ["campaign_id"],
        {"campaign_name": F.col("src_description")},
    )


@query("lookup_eav")
def _(t):
    return L.eav(
        t["lms_payment_schedule_item_metadata"], [ITEM], {"tracking_id": V.TRACKING_NAME, "channel": "channel"}, "name", "value")


@query("lookup_eav_indirect")
def _(t):
    return L.eav_indirect(
        t["lms_loan_entity_parameters"], "base_loan_id", V.INTEREST_MODEL, V.INTEREST_PREFIX, "parameter_name", "value")


@query("lookup_eav_by_column")
def _(t):
    return L.eav_by_column(
        t["lms_loan_entity_parameters"], t["loc_fee_structure"].select("base_loan_id", "daily_interest_code"), "base_loan_id",
        "daily_interest_code", "parameter_name", "value")


@query("keyed_full_outer_diff")
def _(t):
    return reconcile.keyed_diff(t["dim_insurance_protection_plan"], t["dim_insurance_protection_plan_copy"], ["protection_plan_id"])


# --- aggregates, order, sets -----------------------------------------------------------------

for _active, _parity, _name in (
    (True, False, "agg_collected_active"), (False, False, "agg_collected_inactive"), (False, True, "agg_collected_inactive_parity"),
):
    QUERIES[_name] = partial(lambda t, active, parity: collection.collected_amounts(t, W, active, parity), active=_active, parity=_parity)


@query("agg_max_per_key")
def _(t):
    return t["loc_fee_structure"].groupBy("base_loan_id").agg(F.max("id").alias("max_id"))


@query("agg_min_global")
def _(t):
    gone = only_in_left(t["dim_payment_schedule"].select(ITEM), t["lms_payment_schedule_items"], [ITEM], right_unique=True)
    return gone.agg(F.min(ITEM).alias("min_id"))


@query("agg_watermark")
def _(t):
    return audit.watermarks(t["etl_job_batches"])


@query("agg_count_rows")
def _(t):
    return scan.read_source(t["dim_loan"], "created_datetime", START, END).agg(F.count(F.lit(1)).alias("row_count"))


@query("agg_null_counts")
def _(t):
    return reconcile.null_counts(t["dim_loan"], "nulls")


@query("agg_rule_violations")
def _(t):
    return rules.all_rules(t["dim_payment_schedule"], t["dim_customer"])


@query("agg_dml_row_count")
def _(t):
    merged = customer.customer_job(t, t["dim_customer"], NOW)
    return merged.flagged.groupBy(F.col(OP).alias("op")).agg(F.count(F.lit(1)).alias("row_count"))


@query("dedupe_latest")
def _(t):
    return L.dedupe_latest(t["ach_transactions"].drop("created_datetime"), ["lms_payment_schedule_item_id"], ["update_datetime"])


@query("topk_first_per_key")
def _(t):
    states = t["lms_loanheader_state"]
    return L.first_by(states, ["loan_header_id"], "id")


@query("sample_ordered_100")
def _(t):
    return scan.read_source(t["dim_customer"], order_by=["customer_id"], limit=100)


@query("canonical_sort_equality")
def _(t):
    return reconcile.data_equal(t["dim_loan"], t["dim_loan_copy"])


@query("union_distinct_scenarios")
def _(t):
    return loan.staged_interest(t, W)


def _altered(t, table: str) -> DataFrame:
    """A table's copy that lost a column and holds others in another type."""
    lost, retyped = ALTERED[table]
    copy = t[f"{table}_copy"]
    return copy.drop(*lost).withColumns({c: F.col(c).cast("double") for c in retyped})


ALTERED = {
    "dim_customer": (("city",), ()), "dim_loan": (("first_name",), ("loan_amount",)), "dim_payment_schedule": ((), ("amount_fee",)),
}


def _schemas(t, *tables: str) -> DataFrame:
    """Each table against its copy, and against a copy that was altered."""
    pairs = []
    for n in tables:
        pairs.append(reconcile.TablePair(n, f"{n}_copy", partial(t.__getitem__, n), partial(t.__getitem__, f"{n}_copy")))
        pairs.append(reconcile.TablePair(n, f"{n}_altered", partial(t.__getitem__, n), partial(_altered, t, n)))
    return reconcile.reconcile_all(pairs, reconcile.schema_and_rows)


QUERIES["column_set_equality"] = lambda t: _schemas(t, "dim_customer")


# --- scalar functions ---------------------------------------------------------------------------

@query("clean_money")
def _(t):
    return t["lms_customer_info_flat"].select(
        "customer_id", C.money_text("grossmonthly").alias("grossmonthly"), C.money("nmi").alias("nmi_amount"))


@query("divide_round")
def _(t):
    return t["lms_customer_info_flat"].select(
        "customer_id", F.round(C.money("nmi").cast("decimal(24,2)") / F.lit(2), 2).cast(C.MONEY).alias("half_amount"))


@query("lower_email")
def _(t):
    return t["lms_customer_info_flat"].select("customer_id", F.lower("email").alias("email"))


@query("date_cast_coalesce")
def _(t):
    headers = t["lms_loan_header"].select("loan_header_id", "origination_timestamp")
    return t["lms_base_loans"].join(headers, "loan_header_id").select(
        "base_loan_id", C.date_of("origination_date", "origination_timestamp").alias("origination_date"))


@query("date_add_days")
def _(t):
    return t["lms_payment_schedule_items"].select(ITEM, F.date_add("item_date", V.CARD_FAILURE_DAYS).alias("failed_date"))


@query("try_timestamp")
def _(t):
    return t["funding_payment_return"].select(ITEM, "return_time", C.failure_time("return_time").alias("return_at"))


@query("surrogate_key")
def _(t):
    return t["lms_customer_info_flat"].select("customer_id", C.surrogate_key("customer_id", "payfrequency", "lastname").alias("row_key"))


@query("binary_to_hex")
def _(t):
    return t["lms_customer_info_flat"].select("customer_id", C.binary_to_hex(F.col("lastname").cast("binary")).alias("lastname_hex"))


@query("arith_outstanding")
def _(t):
    return t["fct_collection_detail"].select(
        "collection_id", "base_loan_id",
        *[C.remaining(f"{a}_amount", f"collected_{a}_amount", a != "total").alias(f"outstanding_{a}_amount") for a in S.AMOUNTS])


# --- table modification ------------------------------------------------------------------------

@query("merge_upsert")
def _(t):
    return M.merge_upsert(t["dim_insurance_protection_plan_status"], insurance.status_source(t, NOW), ["base_loan_id"],
                          on_duplicate="latest", order_by=["protection_plan_status_log_id"], op_column="op")


@query("merge_insert_only_columns")
def _(t):
    merged = customer.customer_job(t, t["dim_customer"], NOW)
    return merged.flagged.select("customer_id", "rent_amount", "nmi", F.col(OP).alias("op"))


@query("merge_composite_key")
def _(t):
    merged = M.merge_upsert(t["dim_customer"], customer.customer_source(t, NOW), customer.KEYS, S.INSERT_ONLY["dim_customer"], small_source=True)
    return merged.select("customer_id", "lms_code", "lastname", "process_timestamp")


@query("merge_sliced")
def _(t):
    return payment.merged_per_slice(payment.payment_merge(t, t["dim_payment_schedule"], W, NOW))


@query("merge_full_refresh")
def _(t):
    return insurance.status_job(t, t["dim_insurance_protection_plan_status"], NOW).table


@query("update_where")
def _(t):
    return M.update_where(
        t["dim_loan"].select("base_loan_id", "loan_status", "lms_status", "process_timestamp"),
        W.since_start("process_timestamp") & C.withdrawable("lms_status", "loan_status"), {"loan_status": F.lit(V.WITHDRAW)})


@query("update_from_join")
def _(t):
    ach = t["ach_transactions"].withColumnRenamed("lms_payment_schedule_item_id", ITEM)
    return M.update_from(
        t["dim_payment_schedule"].select(ITEM, "status", "payment_failed_date"), ach, [ITEM],
        {"payment_failed_date": F.col("src_update_datetime").cast("date")},
        F.col("status").isin(*V.FAILED_ITEM) & F.col("payment_failed_date").isNull(), order_by=["update_datetime"])


@query("update_from_scalar_subquery")
def _(t):
    return _corrected_loans(t, ("campaign",)).select("base_loan_id", "campaign_name")


@query("update_all_columns_expr")
def _(t):
    return _corrected_collections(t, ("outstanding",))


@query("delete_by_keys")
def _(t):
    return collection.collection_purge(t, t["fct_collection_detail"], parity=True)


@query("delete_by_keys_min_guard")
def _(t):
    return M.purge(t["dim_payment_schedule"], t["lms_payment_schedule_items"], [ITEM])[0].select(ITEM, "status")


@query("insert_select")
def _(t):
    gone = payment.removed_items(t, t["dim_payment_schedule"], t["dim_payment_schedule_removed"], W)
    return M.append_rows(t["dim_payment_schedule_removed"], gone)


# --- customers ------------------------------------------------------------------------------------

QUERIES["dim_customer_source"] = lambda t: customer.customer_source(t, NOW)
QUERIES["dim_customer_merge"] = lambda t: customer.customer_job(t, t["dim_customer"], NOW).table
QUERIES["job_dim_customer"] = QUERIES["dim_customer_merge"]

# --- loans -----------------------------------------------------------------------------------------

LOAN_STEP_COLUMNS = (
    "base_loan_id", "loan_status", "lms_status", "campaign_name", "withdrawn_timestamp", "loan_amount",
    "delinquent_date", "default_date", "loan_interest_pct",
)


def _corrected_loans(t, only, parity: bool = False, now: str = NOW) -> DataFrame:
    corrected, _ = loan.correct_loans(t, t["dim_loan"], W, now, parity, only, CAMPAIGN_START)
    return corrected.select(*LOAN_STEP_COLUMNS)


QUERIES["dim_loan_source"] = lambda t: loan.loan_source(t, W, NOW)
QUERIES["dim_loan_merge"] = lambda t: loan.loan_merge(t, t["dim_loan"], W, NOW).select(*t["dim_loan"].columns)
for _step in ("campaign", "withdraw", "status_sync", "withdrawn_ts", "amount_sync", "clear_dates", "delinquent_date",
              "default_dates", "interest_installment", "interest_loc"):
    QUERIES[f"dim_loan_{_step}"] = partial(_corrected_loans, only=(_step,))
QUERIES["dim_loan_status_sync_nightly"] = partial(_corrected_loans, only=("status_sync_nightly",), now=NIGHT)
QUERIES["dim_loan_status_sync_parity"] = partial(_corrected_loans, only=("status_sync",), parity=True)
QUERIES["reject_log_resolve"] = lambda t: loan.resolve_rejects(t, t["reject_log"], NOW)
QUERIES["reject_log_resolve_parity"] = lambda t: loan.resolve_rejects(t, t["reject_log"], NOW, parity=True)
QUERIES["reject_log_orphans"] = lambda t: M.append_rows(t["reject_log"], loan.orphan_headers(t, W, NOW, t["reject_log"]))
QUERIES["reject_log_orphans_parity"] = lambda t: M.append_rows(t["reject_log"], loan.orphan_headers(t, W, NOW))
QUERIES["stg_interest_s1"] = lambda t: loan.interest_fee_other_risk(t, W)
QUERIES["stg_interest_s2"] = lambda t: loan.interest_no_fee(t, W)
QUERIES["stg_interest_s3"] = lambda t: loan.interest_fee_first_risk(t, W)
QUERIES["stg_interest_s3_parity"] = lambda t: loan.interest_fee_first_risk(t, W, parity=True)
QUERIES["stg_interest_union"] = lambda t: loan.staged_interest(t, W)


def _loan_job(t, parity: bool) -> DataFrame:
    rates = audit.Warehouse(t.spark, scratch(t.spark)).staged("stg_loan_interest_pct", loan.staged_interest(t, W, parity))
    count = store.slices_of(t["lms_base_loans"].count())
    # Landing rows meet by header, then the loans they give meet the target by loan.
    landed = sliced(t, count, lambda part: loan.landed_loans(job.SlicedTables(t, loan.BY_HEADER, part), W, NOW))
    return sliced(t, count, lambda part: loan.loan_job(
        t, t["dim_loan"], t["reject_log"], W, NOW, parity, CAMPAIGN_START, rates, landed, part).table)


QUERIES["job_dim_loan"] = partial(_loan_job, parity=False)
QUERIES["job_dim_loan_parity"] = partial(_loan_job, parity=True)

# --- payments --------------------------------------------------------------------------------------

PAYMENT_STEP_COLUMNS = (ITEM, "status", "payment_failed_date", "auxiliary_type", "subid_tracking_id")


def _corrected_payments(t, only) -> DataFrame:
    return payment.correct_payments(t, t["dim_payment_schedule"], W, only)[0].select(*PAYMENT_STEP_COLUMNS)


@query("payment_source")
def _(t):
    names = ("lms_base_loans", "lms_customer_info_flat", "lms_payment_schedules")
    landing = {name: t[name] for name in names} | {"lms_payment_schedule_items": _changed_items(t)}
    return sliced(t, item_slices(t), lambda part: payment.payment_source(job.SlicedTables(landing, payment.BY_SCHEDULE, part), W, NOW))


@query("payment_merge")
def _(t):
    target = t["dim_payment_schedule"]
    return sliced(t, item_slices(t), lambda part: payment.payment_merge(t, target, W, NOW, part=part).select(*target.columns))


for _step in ("failed_clear", "failed_card", "failed_ach", "failed_missed", "failed_funding", "auxiliary_sync", "tracking_id"):
    QUERIES[f"payment_{_step}"] = partial(_corrected_payments, only=(_step,))
QUERIES["payment_failed_cascade"] = lambda t: payment.failed_cascade(t, t["dim_payment_schedule"], W).select(*PAYMENT_STEP_COLUMNS)


def _payment_archive(t, parity: bool) -> DataFrame:
    gone = payment.removed_items(t, t["dim_payment_schedule"], t["dim_payment_schedule_removed"], W, parity)
    return M.append_rows(t["dim_payment_schedule_removed"], gone).select(ITEM, "item_date", "status", "process_timestamp")


QUERIES["payment_archive_removed"] = partial(_payment_archive, parity=False)
QUERIES["payment_archive_removed_parity"] = partial(_payment_archive, parity=True)
QUERIES["payment_delete_removed"] = lambda t: M.purge(t["dim_payment_schedule"], t["lms_payment_schedule_items"], [ITEM])[0]
QUERIES["job_dim_payment_schedule"] = lambda t: sliced(t, item_slices(t), lambda part: payment.payment_job(
    t, t["dim_payment_schedule"], t["dim_payment_schedule_removed"], W, NOW, part=part).table)

# --- collections -----------------------------------------------------------------------------------

COLLECTION_STEP_COLUMNS = (
    "collection_id", "base_loan_id", *S.COLLECTED, *S.OUTSTANDING, "open_cure_info_id", "open_rtc_notice_id",
    "rtc_outgoing_date", "rtc_default_date", "rtc_sent_flag", "rtc_cured_flag", "rtc_cure_date", "status_code",
    "sub_status_code", "process_timestamp",
)


def _corrected_collections(t, only, parity: bool = False) -> DataFrame:
    corrected, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, parity, only)
    return corrected.select(*COLLECTION_STEP_COLUMNS)


QUERIES["collection_source"] = lambda t: collection.collection_source(t, W, NOW)
QUERIES["collection_merge"] = lambda t: collection.collection_merge(t, t["fct_collection_detail"], W, NOW).select(*t["fct_collection_detail"].columns)
QUERIES["collection_purge"] = lambda t: collection.collection_purge(t, t["fct_collection_detail"])
QUERIES["collection_purge_parity"] = lambda t: collection.collection_purge(t, t["fct_collection_detail"], parity=True)
for _step in ("collected_active", "collected_inactive", "outstanding", "rtc_cure", "status_sync"):
    QUERIES[f"collection_{_step}"] = partial(_corrected_collections, only=(_step,))
QUERIES["collection_collected_active_parity"] = partial(_corrected_collections, only=("collected_active",), parity=True)
QUERIES["collection_collected_inactive_parity"] = partial(_corrected_collections, only=("collected_inactive",), parity=True)
QUERIES["job_fct_collection_detail"] = lambda t: collection.collection_job(t, t["fct_collection_detail"], W, NOW).table
QUERIES["job_fct_collection_detail_parity"] = lambda t: collection.collection_job(t, t["fct_collection_detail"], W, NOW, parity=True).table

# --- insurance -------------------------------------------------------------------------------------

QUERIES["insurance_plan_source"] = lambda t: insurance.plan_join(t, W, NOW)
QUERIES["insurance_plan_merge"] = lambda t: insurance.plan_job(t, t["dim_insurance_protection_plan"], W, NOW).table
QUERIES["insurance_status_merge"] = lambda t: insurance.status_job(t, t["dim_insurance_protection_plan_status"], NOW).table


@query("job_dim_insurance")
def _(t):
    """The rows of both tables after the job, each with the name of its table and what became of it."""
    plans = insurance.plan_job(t, t["dim_insurance_protection_plan"], W, NOW).flagged
    statuses = insurance.status_job(t, t["dim_insurance_protection_plan_status"], NOW).flagged
    both = plans.withColumn("table_name", F.lit("plan")).unionByName(
        statuses.withColumn("table_name", F.lit("status")), allowMissingColumns=True)
    return both.withColumnRenamed(OP, "op")


# --- audit -----------------------------------------------------------------------------------------

JOB = 2


@query("audit_next_window")
def _(t):
    return audit.next_windows(t["etl_jobs"], t["etl_job_batches"], NOW)


@query("audit_job_lookup")
def _(t):
    # The jobs found by name, with the batches they have run.
    runs = t["etl_job_batches"].groupBy("job_id").agg(F.count(F.lit(1)).alias("batches"))
    return audit.job_id_of(t["etl_jobs"], "dim_payment_schedule").join(runs, "job_id", "left")


@query("audit_batch_open")
def _(t):
    batches = t["etl_job_batches"]
    return batches.unionByName(audit.open_batch(batches, 100000000, JOB, "Populate dim_loan", W, NOW))


@query("audit_step_log")
def _(t):
    """The log a load of the customer dimension leaves behind."""
    house = audit.Warehouse(t.spark, scratch(t.spark))
    house.record("etl_job_batches", t["etl_job_batches"])
    audit.run_job(house, "dim_customer", 100000000, 1, NOW, lambda *_: customer.customer_job(t, t["dim_customer"], NOW))
    return house.step_log().select("log_type", "log_label", "log_message")


@query("audit_step_log_slices")
def _(t):
    """The log of the merge of a payment load: a row per tenant slice."""
    house = audit.Warehouse(t.spark, scratch(t.spark), slices=item_slices(t))
    house.record("etl_job_batches", t["etl_job_batches"])
    house.write("dim_payment_schedule", t["dim_payment_schedule"], tuple(payment.KEYS))
    audit.run_job(house, "dim_payment_schedule", 100000000, 3, NOW, lambda w, _: payment.payment_job(
        t, w.read_part("dim_payment_schedule"), t["dim_payment_schedule_removed"], W, NOW, part=w.part),
        appended=("dim_payment_schedule_removed",))
    return house.step_log().filter("log_type = 'Merge'").select("log_type", "log_label", "log_message")


QUERIES["audit_batch_close"] = lambda t: audit.close_batch(t["etl_job_batches"], 42, NOW, True)


@query("audit_job_status")
def _(t):
    # The status of every job as its last batch left it.
    last = L.latest_by(t["etl_job_batches"].select("job_id", "batch_id", "is_success", "check_point_start", "check_point_end"), ["job_id"], "batch_id")
    return M.update_from(t["etl_jobs"], last, ["job_id"], {
        c: F.col(f"src_{c}") for c in ("is_success", "check_point_start", "check_point_end")})


@query("audit_failure")
def _(t):
    """A failed load: the error is logged, the batch closed and the watermark left alone."""
    house = audit.Warehouse(t.spark, scratch(t.spark))
    house.record("etl_jobs", t["etl_jobs"])
    house.record("etl_job_batches", t["etl_job_batches"])

    def fails(warehouse, window):
        raise RuntimeError("source is not readable")

    try:
        audit.run_job(house, "dim_loan", 100000000, JOB, NOW, fails)
    except RuntimeError:
        pass
    batches = house.batches()
    logged = house.step_log().filter("log_message = 'Merge failed'").groupBy("batch_id", "error_message").agg(
        F.count(F.lit(1)).alias("logged"))
    failed = batches.join(logged, "batch_id").filter("end_datetime IS NOT NULL").select("job_id", "is_success", "error_message", "logged")
    return audit.watermarks(batches).join(failed, "job_id", "left")


# --- reconciliation and rules ----------------------------------------------------------------

QUERIES["recon_row_count"] = lambda t: reconcile.row_count(t["dim_loan"], t["dim_loan_copy"])
QUERIES["recon_schema"] = lambda t: _schemas(t, "dim_loan", "dim_customer")
QUERIES["recon_dtypes"] = lambda t: _schemas(t, "dim_payment_schedule", "dim_loan")
QUERIES["recon_null_counts"] = lambda t: reconcile.null_report(t["dim_loan"], t["dim_loan_copy"])
QUERIES["recon_data_equal"] = lambda t: reconcile.data_equal(t["dim_payment_schedule_removed"], t["dim_payment_schedule_removed_copy"])
QUERIES["recon_keyed_diff"] = lambda t: reconcile.keyed_diff(t["fct_collection_detail"], t["fct_collection_detail_copy"], ["collection_id"])
QUERIES["recon_keyed_diff_schedule"] = lambda t: reconcile.diff_totals(
    reconcile.keyed_diff(t["dim_payment_schedule"], t["dim_payment_schedule_copy"], ["payment_schedule_id"]))
QUERIES["recon_column_mismatches"] = lambda t: reconcile.column_mismatches(t["dim_customer"], t["dim_customer_copy"], ["customer_id"])
QUERIES["recon_summary"] = lambda t: reconcile.reconcile_all(dimension_pairs(t))
QUERIES["recon_pair_diffs"] = lambda t: reconcile.reconcile_all(dimension_pairs(t), reconcile.pair_diff)
QUERIES["recon_pair_columns"] = lambda t: reconcile.reconcile_all(
    dimension_pairs(t), partial(reconcile.pair_columns, folder=scratch(t.spark)))
QUERIES["recon_landing_summary"] = lambda t: reconcile.reconcile_all(landing_pairs(t), reconcile.landing_summary, START, END)
QUERIES["recon_query_vs_table"] = QUERIES["config_query_vs_table"]
QUERIES["rule_item_type"] = lambda t: reconcile.check_rules(t["dim_payment_schedule"], rules.payment_rules())
for _parity, _tail in ((False, ""), (True, "_parity")):
    for _rule, _key in (("grossmonthly", "rule_gross_monthly"), ("paycheck_amount", "rule_paycheck_amount")):
        QUERIES[_key + _tail] = partial(
            lambda t, rule, parity: reconcile.check_rules(t["dim_customer"], {rule: rules.customer_rules(parity)[rule]}),
            rule=_rule, parity=_parity)
QUERIES["rule_report"] = lambda t: rules.rule_lines(rules.all_rules(t["dim_payment_schedule"], t["dim_customer"]))

# --- layers described without code ---------------------------------------------------------------

QUERIES["prepare_flatten_json"] = lambda t: flatten_json(t["events"].select("event_id", "event_type", "props"), "props", "k long")
QUERIES["normalize_standardize"] = lambda t: standardize(
    t["dim_customer"].select("customer_id", "grossmonthly", "email"), amounts=["grossmonthly"], emails=["email"])
QUERIES["normalize_standardize_times"] = lambda t: standardize(t["funding_payment_return"].select(ITEM, "return_time"), times=["return_time"])
QUERIES["normalize_unreadable_money"] = lambda t: unreadable_money(t["dim_customer"], "customer_id", "grossmonthly", "dim_customer")
QUERIES["star_and_marts"] = lambda t: marts.payments_by_status(t["dim_payment_schedule"], t["dim_customer"])


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as a function of a session and a data folder."""
    def run(build: Query, spark: SparkSession, folder: str) -> DataFrame:
        return presented(build(DerivedTables(spark, folder)))

    return {name: partial(run, build) for name, build in QUERIES.items()}
