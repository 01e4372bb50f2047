"""The defective or surprising rules of the load jobs, on a few rows each."""

import re
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow
from tallyhouse.plans import collection, customer, insurance, loan, payment

START, END, NOW = "1998-01-01 00:00:00", "1998-02-01 00:00:00", "1998-02-01 00:00:00"
W = ChangeWindow(START, END)
ITEM = "payment_schedule_item_id"
NEW, OLD = "1998-01-15 00:00:00", "1997-01-01 00:00:00"


def test_customer_refresh_ignores_the_window_and_drops_unknown_organizations(tables):
    t = (
        tables.add("upm_organizations", {"organization_id": 1, "organization_name": "One"})
        .add("lms_customer_info_flat",
             {"customer_id": 1, "organization_id": 1, "grossmonthly": "$1,000", "nmi": "$2", "email": "A@B", "rent_amount": 5, "last_update": OLD},
             {"customer_id": 2, "organization_id": 8, "nmi": "$2"})
        .add("dim_customer", {"customer_id": 1, "lms_code": "JAG", "rent_amount": 7, "nmi": "9.00", "lastname": "x"},
             {"customer_id": 1, "lms_code": "OTHER", "rent_amount": 8})
    )
    job = customer.customer_job(t, t["dim_customer"], NOW)
    assert rows(job.table, "customer_id", "lms_code", "grossmonthly", "email", "rent_amount", "nmi", "lastname", "organization_name") == [
        ("1", "JAG", "1000.00", "a@b", "7.00", "9.00", None, "One"), ("1", "OTHER", None, None, "8.00", None, None, None)]
    assert job.flagged.agg(*job.step_counts()).first()["merge"] == 1


# --- loans ---------------------------------------------------------------------------------

def loans(tables, **base):
    return (
        tables.add("lms_base_loans", {"base_loan_id": 1, "loan_header_id": 11, "updated_datetime": NEW, "loan_status": "Pending", **base})
        .add("lms_loan_header", {"loan_header_id": 11, "status": "Withdraw", "last_update": OLD, "created_date": NEW})
        .add("dim_loan", {"base_loan_id": 1, "loan_header_id": 11, "loan_status": "Pending", "lms_status": "Withdraw",
                          "last_update": OLD, "process_timestamp": NEW})
    )


def corrected(t, parity=False, **kwargs):
    return loan.correct_loans(t, t["dim_loan"], W, NOW, parity, **kwargs)[0]


def test_withdrawal_survives_the_status_copy_but_for_parity(tables):
    t = loans(tables)
    assert rows(corrected(t), "loan_status", "withdrawn_timestamp") == [("Withdraw", OLD)]
    assert rows(corrected(t, parity=True), "loan_status", "withdrawn_timestamp") == [("Pending", None)]


def test_loan_source_takes_a_change_on_either_table(tables):
    t = (
        tables.add("lms_base_loans", *[{"base_loan_id": i, "loan_header_id": 10 + i, "updated_datetime": u} for i, u in ((1, NEW), (2, OLD), (3, OLD), (4, START))])
        .add("lms_loan_header", *[{"loan_header_id": 10 + i, "last_update": u} for i, u in ((1, OLD), (2, END), (3, OLD), (4, None))])
        .add("lms_loanheader_state", {"id": 2, "loan_header_id": 11, "action": "open", "action_time": NEW},
             {"id": 1, "loan_header_id": 11, "action": "open"}, {"id": 1, "loan_header_id": 12, "action": "open", "action_time": NEW})
    )
    for narrow in (True, False):
        assert rows(loan.loan_source(t, W, NOW, narrow), "base_loan_id", "agent_open_time", "is_auto_fund") == [("1", None, "0"), ("2", NEW, "0")]


def test_nightly_copy_runs_at_its_hour_only(tables):
    t = loans(tables, loan_status="Originated")
    t.add("dim_loan", {"base_loan_id": 1, "loan_header_id": 11, "loan_status": "Pending", "lms_status": "x", "process_timestamp": OLD})
    assert rows(corrected(t), "loan_status") == [("Pending",)]
    at_night = loan.correct_loans(t, t["dim_loan"], W, "1998-02-01 03:30:00")[0]
    assert rows(at_night, "loan_status", "lms_status") == [("Originated", "Withdraw")]


def test_a_stored_null_status_is_never_copied_over(tables):
    t = loans(tables, loan_status="Originated")
    t.add("dim_loan", {"base_loan_id": 1, "loan_header_id": 11, "lms_status": None, "process_timestamp": NEW})
    assert rows(corrected(t), "loan_status", "lms_status") == [(None, None)]


def test_default_dates_come_from_the_newest_entry_else_from_history(tables):
    t = loans(tables, loan_status="DEFAULT-PIF")
    t.add("collection_lms_loan_map",
          {"collection_id": 1, "base_loan_id": 1, "update_timestamp": OLD, "delinquency_date": "1990-01-01"},
          {"collection_id": 2, "base_loan_id": 1, "update_timestamp": NEW, "fully_defaulted_date": "1998-01-03"})
    t.add("loan_status_change_history", {"loan_header_id": 11, "to_status": "Delinquent", "change_date": "1997-05-05"},
          {"loan_header_id": 11, "to_status": "Delinquent", "change_date": "1997-06-06"})
    assert rows(corrected(t), "delinquent_date", "default_date") == [("1997-06-06", "1998-01-03")]


def interest(tables, risk, fees, parameters):
    return (
        tables.add("lms_base_loans", {"base_loan_id": 1, "loan_header_id": 11, "customer_id": 5, "loan_type": "loc"})
        .add("lms_customer_info_flat", {"customer_id": 5, "organization_id": 1})
        .add("lms_loan_header", {"loan_header_id": 11, "risk_level_id": risk, "created_date": NEW})
        .add("loc_fee_structure", *[{"base_loan_id": 1, "id": i, "daily_interest_code": c} for i, c in fees])
        .add("lms_loan_entity_parameters", *[{"base_loan_id": 1, "id": i, "parameter_name": n, "value": v} for i, n, v in parameters])
    )


PARAMETERS = [(1, "interest_0", "0.1"), (2, "interest_1", "0.2"), (7, "default_calculation_model", "interest_1")]


def test_interest_scenarios(tables):
    t = interest(tables, 2, [(3, "interest_1"), (4, "interest_0")], PARAMETERS)
    assert rows(loan.staged_interest(t, W), "base_loan_id", "loan_interest_pct") == [("1", "0.1")]
    t = interest(tables, 1, [], PARAMETERS)
    assert rows(loan.staged_interest(t, W), "loan_interest_pct") == [("0.2",)]
    t = interest(tables, None, [(3, "interest_1")], PARAMETERS)
    assert rows(loan.staged_interest(t, W), "loan_interest_pct") == []


def test_third_scenario_parity_matches_ids_of_two_tables(tables):
    t = interest(tables, 1, [(3, "interest_1"), (4, "interest_0")], PARAMETERS)
    assert rows(loan.interest_fee_first_risk(t, W), "loan_interest_pct") == [("0.1",)]
    assert rows(loan.interest_fee_first_risk(t, W, parity=True), "loan_interest_pct") == []
    t = interest(tables, 1, [(3, "interest_0"), (7, "interest_1"), (8, "interest_0")], PARAMETERS)
    assert rows(loan.interest_fee_first_risk(t, W, parity=True), "loan_interest_pct") == [("0.2",)]


def test_rejects_are_logged_once_and_fixed_when_the_loan_arrives(tables):
    t = tables.add("lms_loan_header", {"loan_header_id": 1, "created_date": NEW}, {"loan_header_id": 2, "created_date": OLD}, {"loan_header_id": 4, "created_date": NEW})
    t.add("lms_base_loans", {"base_loan_id": 40, "loan_header_id": 4})
    log = t.build("reject_log", [])
    first = loan.orphan_headers(t, W, NOW, log)
    assert rows(first, "column_value", "process_datetime") == [("1", "1998-02-01")]

    def entry(value, **more):
        return {"table_name": "lms_loan_header", "column_name": "loan_header_id", "column_value": value, **more}

    log = t.build("reject_log", [entry(1), entry(4), entry(9), entry(8, is_fixed=1, fixed_date="1990-01-01"), {"table_name": "other", "column_value": 9}])
    assert rows(loan.orphan_headers(t, W, NOW, log), "column_value") == []
    assert rows(loan.orphan_headers(t, W, NOW), "column_value") == [("1",)]
    assert rows(loan.resolve_rejects(t, log, NOW), "column_value", "is_fixed", "fixed_date") == [
        ("1", None, None), ("4", "1", "1998-02-01"), ("8", "1", "1990-01-01"), ("9", None, None), ("9", "1", "1998-02-01")]
    assert rows(loan.resolve_rejects(t, log, NOW, parity=True), "column_value", "is_fixed", "fixed_date") == [
        ("1", None, None), ("4", None, None), ("8", "1", "1998-02-01"), ("9", None, None), ("9", "1", "1998-02-01")]


@pytest.mark.parametrize("doubled", ["lms_base_loans", "lms_loan_header", "lead_source"])
def test_repeated_landing_rows_never_multiply_loans(tables, doubled):
    t = loans(tables, loan_status="Originated")
    t.add("lead_source", {"lead_source_id": 3, "description": "radio"})
    t.add("dim_loan", {"base_loan_id": 1, "loan_header_id": 11, "campaign_id": 3, "process_timestamp": NEW})
    before = corrected(t)
    t.given[doubled] = t[doubled].unionAll(t[doubled])
    assert rows(before, *before.columns) == rows(corrected(t), *before.columns) and before.count() == 1


def test_the_latest_of_several_landing_rows_counts(tables):
    t = loans(tables, loan_status="Originated", updated_datetime=NEW, loan_amount=5)
    late = t["lms_base_loans"]
    early = loans(tables, loan_status="Originated", updated_datetime=OLD, loan_amount=4)["lms_base_loans"]
    t.given["lms_base_loans"] = late.unionAll(early)
    t.add("dim_loan", {"base_loan_id": 1, "loan_header_id": 11, "loan_amount": 1, "process_timestamp": NEW})
    assert rows(corrected(t), "loan_amount") == [("5.00",)]


def scans(df):
    """How often a plan reads each table."""
    return Counter(re.findall(r"/written/(\w+)", df._jdf.queryExecution().executedPlan().toString()))


@pytest.fixture
def written(spark, tables, folder):
    """Every landing and target table as files, so that plans show what they read."""
    class Written(dict):
        def __missing__(self, name):
            path = f"{folder}/written/{name}"
            tables[name].write.parquet(path)
            self[name] = spark.read.parquet(path)
            return self[name]

    return Written()


def test_the_loan_job_reads_each_table_once(spark, written):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rates = written["rates_of"] = spark.createDataFrame([(1, "0.1")], "base_loan_id long, loan_interest_pct string")
        job = loan.loan_job(written, written["dim_loan"], written["reject_log"], W, NOW, rates=rates)
        read = scans(job.table)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["dim_loan"] == read["lms_base_loans"] == 1 and read["lms_loan_header"] == 2
    assert max(n for name, n in read.items() if name != "lms_loan_header") == 1 and "loc_fee_structure" not in read
    assert "stg_loan_interest_pct" not in job.appends


def test_the_collection_job_reads_items_once(spark, written):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = scans(collection.collection_job(written, written["fct_collection_detail"], W, NOW).table)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["lms_payment_schedule_items"] == read["lms_payment_schedules"] == read["lms_base_loans"] == 1


def test_a_reject_log_leaves_landing_where_it_is(spark, written):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = loan.resolve_rejects(written, written["reject_log"], NOW)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    at = [i for i, line in enumerate(lines) if "FileScan" in line and re.search("written/lms_(loan_header|base_loans)", line)]
    assert len(at) == 2
    for i in at:  # from the scan up to the semi join with the log nothing is shuffled
        join = max(k for k in range(i) if "LeftSemi" in lines[k])
        assert "BroadcastHashJoin" in lines[join] and not any("Exchange hashpartitioning" in line for line in lines[join:i])


def test_landed_rows_with_several_changes_fail_and_facts_come_from_the_latest(tables):
    t = loans(tables, loan_status="Originated", updated_datetime=NEW, loan_amount=5)
    twice = t["lms_base_loans"]
    t.given["lms_base_loans"] = twice.unionAll(twice)
    with pytest.raises(Exception, match="several rows"):
        loan.loan_job(t, t["dim_loan"], t["reject_log"], W, NOW).table.collect()
    # The changed row is merged; a later row outside the window only brings facts.
    late = loans(tables, loan_status="Pending", updated_datetime="1999-01-01 00:00:00", loan_amount=7)["lms_base_loans"]
    t.given["lms_base_loans"] = twice.unionAll(late)
    job = loan.loan_job(t, t["dim_loan"], t["reject_log"], W, NOW)
    assert rows(job.table, "base_loan_id", "loan_amount") == [("1", "7.00")]
    assert job.flagged.agg(*job.step_counts()).first()["merge"] == 1
    t.given["lms_base_loans"] = late.withColumn("base_loan_id", F.lit(None).cast("long"))
    assert rows(loan.loan_job(t, t["dim_loan"], t["reject_log"], W, NOW).table, "base_loan_id") == [("1",)]


# --- payments ------------------------------------------------------------------------------

CASCADE = [  # id, status, mode, set before, ach, funding, date expected
    ("clear", "Cleared", "ACH", "1998-01-09", None, None, None),
    ("card", "Return", "debit card", None, "1998-01-20", None, "1998-01-13 00:00:00"),
    ("ach", "Return", "ACH", None, "1998-01-20 05:00:00", "1998-01-25 10:00:00", "1998-01-20 00:00:00"),
    ("missed", "MISSED", "ACH", None, None, "1998-01-25 10:00:00", "1998-01-10 00:00:00"),
    ("funding", "Return", "ACH", None, None, "1998-01-25 10:00:00", "1998-01-25 10:00:00"),
    ("bad", "Return", "ACH", None, None, "bad", None),
    ("kept", "Return", "ACH", "1998-01-09", "1998-01-20", None, "1998-01-09 00:00:00"),
    ("upper", "Return", "CARD", None, None, None, None),
    ("scheduled", "scheduled", "NON-ACH", None, None, None, None),
]


def cascade(tables):
    t = tables.add("dim_payment_schedule", *[
        {ITEM: i, "status": s, "payment_mode": m, "payment_failed_date": d, "item_date": "1998-01-10", "process_timestamp": OLD} for i, s, m, d, *_ in CASCADE
    ], {ITEM: "old", "status": "MISSED", "payment_mode": "NON-ACH", "item_date": "1997-01-10", "process_timestamp": OLD})
    t.add("ach_transactions", *[{"lms_payment_schedule_item_id": i, "update_datetime": a} for i, *_, a, _, _ in CASCADE if a],
          {"lms_payment_schedule_item_id": "ach", "update_datetime": OLD})
    return t.add("funding_payment_return", *[{ITEM: i, "return_time": f} for i, *_, f, _ in CASCADE if f])


def test_failure_dates_step_by_step_and_as_one_expression(tables):
    t = cascade(tables)
    expected = sorted([(i, e) for i, *_, e in CASCADE] + [("old", None)])
    stepwise, _ = payment.correct_payments(t, t["dim_payment_schedule"], W)
    assert rows(stepwise, ITEM, "payment_failed_date") == expected
    assert rows(payment.failed_cascade(t, t["dim_payment_schedule"], W), ITEM, "payment_failed_date") == expected


def test_removed_items_are_archived_before_they_are_deleted(tables):
    t = tables.add("dim_payment_schedule", {ITEM: "here", "item_date": "1998-01-10"}, {ITEM: "new", "item_date": "1998-01-10"},
                   {ITEM: "old", "item_date": "1997-01-10"}, {ITEM: "done", "item_date": "1998-01-10"})
    t.add("lms_payment_schedule_items", {ITEM: "here"})
    archive = t.build("dim_payment_schedule", [{ITEM: "done"}])
    job = payment.payment_job(t, t["dim_payment_schedule"], archive, W, NOW)
    assert rows(job.table, ITEM) == [("here",)]
    assert rows(job.appends["dim_payment_schedule_removed"], ITEM) == [("new",), ("old",)]
    assert job.flagged.agg(*job.step_counts()).first()["delete_removed"] == 3
    parity = payment.payment_job(t, t["dim_payment_schedule"], archive, W, NOW, parity=True)
    assert rows(parity.appends["dim_payment_schedule_removed"], ITEM) == [("new",)]


def test_payment_slices_and_item_window(tables):
    t = (
        tables.add("lms_payment_schedules", *[{"payment_schedule_id": i, "base_loan_id": i, "customer_id": 99} for i in range(4)])
        .add("lms_base_loans", *[{"base_loan_id": i, "customer_id": i} for i in range(4)])
        .add("lms_customer_info_flat", *[{"customer_id": i, "organization_id": o} for i, o in enumerate((1, 4, 9, None))])
        .add("lms_payment_schedule_items", *[{ITEM: f"i{i}", "payment_schedule_id": i, "_snowflake_updated_at": NEW, "total_amount": -1, "status": "Cleared"} for i in range(4)],
             {ITEM: "stale", "payment_schedule_id": 0, "_snowflake_inserted_at": START})
        .add("dim_payment_schedule", {ITEM: "i0", "theoretical_sep_amt": 3})
    )
    merged = payment.payment_merge(t, t["dim_payment_schedule"], W, NOW)
    assert rows(payment.merged_per_slice(merged), "org_slice", "op", "row_count") == [("1", "update", "1"), ("3", "insert", "1"), ("4", "insert", "1")]
    assert rows(merged, ITEM, "item_type", "is_active", "theoretical_sep_amt", "customer_id")[0] == ("i0", "C", "0", "3.00", "99")


def test_repeated_items_never_multiply_the_schedule(tables):
    t = cascade(tables)
    item = {ITEM: "ach", "auxiliary_type": "x", "updated_datetime": NEW}
    t.add("lms_payment_schedule_items", item, item, {**item, "auxiliary_type": "y", "updated_datetime": OLD})
    done, _ = payment.correct_payments(t, t["dim_payment_schedule"], W)
    assert done.count() == len(CASCADE) + 1


# --- collections -----------------------------------------------------------------------------

def pairs(tables):
    return (
        tables.add("collection_lms_loan_map", {"collection_id": 1, "base_loan_id": 11, "_snowflake_inserted_at": NEW}, {"collection_id": 1, "base_loan_id": 12, "_snowflake_inserted_at": OLD})
        .add("collections", {"collection_id": 1, "status_code": "OPEN", "created_by_user_id": 8})
        .add("fct_collection_detail", {"collection_id": 1, "base_loan_id": 10}, {"collection_id": 1, "base_loan_id": 11, "created_by_user_id": 7})
    )


def test_collections_are_kept_per_loan(tables):
    t = pairs(tables)
    merged = collection.collection_merge(t, t["fct_collection_detail"], W, NOW)
    assert rows(merged, "collection_id", "base_loan_id", "status_code", "created_by_user_id") == [("1", "10", None, None), ("1", "11", "OPEN", "7")]
    assert rows(collection.collection_purge(t, merged), "base_loan_id") == [("11",)]
    assert rows(collection.collection_purge(t, merged, parity=True), "base_loan_id") == []
    assert rows(collection.collection_job(t, t["fct_collection_detail"], W, NOW).table, "base_loan_id") == [("11",)]
    assert rows(collection.collection_job(t, t["fct_collection_detail"], W, NOW, parity=True).table, "base_loan_id") == []


def amounts(tables, status):
    item = {"payment_schedule_id": 5, "status": "Cleared", "item_type": "D", "total_amount": 10, "amount_fee": 1, "amount_prin": 2, "amount_int": 3, "amount_other": 4}
    return (
        tables.add("lms_base_loans", {"base_loan_id": 1, "loan_status": status})
        .add("collection_lms_loan_map", {"collection_id": 7, "base_loan_id": 1}, {"collection_id": 8, "base_loan_id": 1})
        .add("lms_payment_schedules", {"payment_schedule_id": 5, "base_loan_id": 1, "is_collections": 1}, {"payment_schedule_id": 6, "base_loan_id": 1, "is_collections": 0})
        .add("lms_payment_schedule_items", {**item, "item_date": "1997-06-01"}, {**item, "item_date": "1998-01-15"},
             {**item, "item_date": "1997-06-01", "item_type": "C"}, {**item, "item_date": "1997-06-01", "payment_schedule_id": 6})
        .add("fct_collection_detail", {"collection_id": 7, "base_loan_id": 1, "total_amount": 100, "process_timestamp": OLD})
    )


COLLECTED = ["collected_total_amount", "collected_principal_amount", "collected_interest_amount", "collected_fees_amount", "process_timestamp"]


def test_collected_amounts_go_to_the_column_they_name(tables):
    t = amounts(tables, "Originated")
    active, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, only=("collected_active",))
    assert rows(active, *COLLECTED) == [("10.00", "2.00", "3.00", "1.00", START)]
    parity, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, True, ("collected_active",))
    assert rows(parity, *COLLECTED) == [("10.00", "1.00", "2.00", "3.00", START)]


def test_inactive_amounts_are_whole_but_for_parity(tables):
    t = amounts(tables, "Void")
    whole, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, only=("collected_inactive",))
    assert rows(whole, "collected_total_amount", "process_timestamp") == [("20.00", NOW)]
    part, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, True, ("collected_inactive",))
    assert rows(part, "collected_total_amount") == [("10.00",)]


@pytest.mark.parametrize("doubled", ["lms_base_loans", "collections", "lms_deferred_outgoing_email"])
def test_repeated_landing_rows_never_multiply_collections(tables, doubled):
    t = amounts(tables, "Originated").add("collections", {"collection_id": 7, "status_code": "OPEN"})
    t.add("lms_collection_cure_info", {"base_loan_id": 1, "is_enabled": 1, "is_cured": 0, "lms_collection_cure_info_id": 1, "rtc_notice": 100})
    t.add("lms_deferred_outgoing_email", {"lms_deferred_outgoing_email_id": 100, "is_sent": 1})
    before, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW)
    t.given[doubled] = t[doubled].unionAll(t[doubled])
    after, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW)
    assert rows(before, *before.columns) == rows(after, *before.columns) and before.count() == 1


def test_active_rows_stamped_with_the_start_still_get_their_outstanding(tables):
    t = amounts(tables, "DEFAULT")
    done, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW)
    assert rows(done, "outstanding_total_amount", "outstanding_other_amount", "process_timestamp") == [("90.00", "-4.00", NOW)]
    t.add("fct_collection_detail", {"collection_id": 7, "base_loan_id": 2, "process_timestamp": NEW})
    done, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW)
    assert rows(done, "outstanding_total_amount", "outstanding_fees_amount") == [(None, "0.00")]


def test_open_cure_is_the_newest_uncured_of_an_active_loan(tables):
    cure = {"base_loan_id": 1, "is_enabled": 1, "is_cured": 0}
    t = (
        tables.add("lms_base_loans", {"base_loan_id": 1, "loan_status": "Originated"})
        .add("lms_collection_cure_info", {**cure, "lms_collection_cure_info_id": 1, "rtc_notice": 100}, {**cure, "lms_collection_cure_info_id": 2, "rtc_notice": 200},
             {**cure, "lms_collection_cure_info_id": 3, "is_cured": 1, "rtc_notice": 100})
        .add("lms_deferred_outgoing_email", {"lms_deferred_outgoing_email_id": 100, "is_sent": 1}, {"lms_deferred_outgoing_email_id": 200, "is_sent": 0})
        .add("fct_collection_detail", {"collection_id": 7, "base_loan_id": 1, "process_timestamp": NEW}, {"collection_id": 8, "base_loan_id": 1, "process_timestamp": OLD})
    )
    done, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, only=("rtc_cure",))
    assert rows(done, "collection_id", "open_cure_info_id", "rtc_sent_flag") == [("7", "2", "0"), ("8", None, None)]
    t.add("lms_deferred_outgoing_email", {"lms_deferred_outgoing_email_id": 100, "is_sent": 1})
    done, _ = collection.correct_collections(t, t["fct_collection_detail"], W, NOW, only=("rtc_cure",))
    assert rows(done, "open_cure_info_id") == [(None,), (None,)]


# --- insurance -------------------------------------------------------------------------------

def test_a_plan_with_several_status_logs_takes_the_newest(tables):
    t = (
        tables.add("protection_plan", {"id": 1, "protection_plan_application_id": 5, "policy_id": 3, "_snowflake_inserted_at": NEW},
                   {"id": 2, "protection_plan_application_id": 6, "policy_id": 3, "_snowflake_inserted_at": NEW})
        .add("insurance_policy", {"id": 3, "insurance_provider_id": 4})
        .add("insurance_provider", {"id": 4, "name": "P"})
        .add("protection_plan_status_log", {"id": 50, "protection_plan_application_id": 5}, {"id": 51, "protection_plan_application_id": 5}, {"id": 60, "protection_plan_application_id": 6})
        .add("protection_plan_status", {"base_loan_id": 7, "protection_plan_status_log_id": 50}, {"base_loan_id": 8, "protection_plan_status_log_id": 51})
    )
    assert len(rows(insurance.plan_join(t, W, NOW), "protection_plan_id")) == 2
    job = insurance.plan_job(t, t["dim_insurance_protection_plan"], W, NOW)
    assert rows(job.table, "protection_plan_id", "base_loan_id", "insurance_provider_name") == [("1", "8", "P")]


@pytest.mark.parametrize("small", [True, False])
def test_loading_a_window_twice_gives_the_same_table(tables, small):
    t = amounts(pairs(tables), "Void")
    once = collection.collection_job(t, t["fct_collection_detail"], W, NOW, small_source=small).table
    twice = collection.collection_job(t, once, W, NOW, small_source=small).table
    assert rows(once, *once.columns) == rows(twice, *twice.columns)
