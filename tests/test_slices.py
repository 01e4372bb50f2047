"""Jobs that run slice by slice give the rows of the whole, and leave no shuffle behind."""

import time
from functools import partial, reduce

import pytest
from conftest import rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow
from tallyhouse.plans import audit, loan, payment, reconcile
from tallyhouse.plans.job import SlicedTables
from tallyhouse.sources import scan, store

START, NOW = "2000-01-01 00:00:00", "2001-01-01 00:00:00"
W = ChangeWindow(START, NOW)
ITEM = "payment_schedule_item_id"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def left_behind(spark, held):
    """Shuffle files that a run left; they are removed in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - held):
            break
        time.sleep(0.1)
    return left


def union(frames):
    return reduce(DataFrame.unionByName, frames)


def test_slices_hold_every_row_once(spark):
    df = spark.createDataFrame([(k, f"v{k}") for k in [*range(50), None, None]], "k long, v string")
    cut = [store.slice_of(df, ["k"], part) for part in store.parts(8)]
    assert sum(c.count() for c in cut) == 52 and sum(c.filter("k IS NULL").count() > 0 for c in cut) == 1
    assert [store.slices_of(n) for n in (0, store.SLICE_ROWS, store.SLICE_ROWS + 1, 100 * store.SLICE_ROWS)] == [1, 1, 2, store.MOST_SLICES]


def test_what_a_write_shuffled_goes_with_it(spark, folder):
    df = spark.range(1000).withColumn("v", F.col("id") * 2)
    at = F.timestamp_seconds("id").cast("timestamp_ntz")
    held = shuffle_files(spark)
    store.write_table(df, f"{folder}/table", ["id"], 4, 2)
    store.append(df.groupBy("v").count(), f"{folder}/log")
    scan.land_by_change(df.withColumn("at", at), f"{folder}/landed", ["at"], ["id"], 2)
    read = store.in_slices(spark, f"{folder}/slices", 2, lambda part: store.slice_of(df, ["id"], part).groupBy("id").agg(F.max("v").alias("v")))
    assert not left_behind(spark, held) and spark.conf.get(store.FREE_SHUFFLES) == "false"
    assert store.read_table(spark, f"{folder}/table").count() == 1000 and rows(read, "id", "v") == rows(df, "id", "v")
    assert sum(store.read_table(spark, f"{folder}/table", part).count() for part in store.parts(2)) == 1000
    assert spark.read.parquet(f"{folder}/landed").count() == 1000


@pytest.fixture
def payments(tables):
    ids = range(1, 13)
    tables.add("lms_payment_schedule_items", *[
        {ITEM: f"i{i}", "payment_schedule_id": i % 3 + 1, "status": "MISSED" if i % 2 else "Cleared", "item_date": "2000-02-01",
         "auxiliary_type": f"a{i}", "_snowflake_inserted_at": "2000-06-01" if i % 3 else "1999-01-01"} for i in ids])
    tables.add("lms_payment_schedules", *[{"payment_schedule_id": i, "base_loan_id": i} for i in (1, 2, 3)])
    tables.add("lms_base_loans", *[{"base_loan_id": i, "customer_id": i} for i in (1, 2, 3)])
    tables.add("lms_customer_info_flat", *[{"customer_id": i, "organization_id": i} for i in (1, 2, 3)])
    tables.add("ach_transactions", *[{"lms_payment_schedule_item_id": f"i{i}", "update_datetime": "2000-03-03"} for i in ids if i % 4 == 1])
    target = [{ITEM: f"i{i}", "item_date": "1999-01-01", "theoretical_sep_amt": i} for i in (1, 2, 3, 6)]
    gone = [{ITEM: f"g{i}", "item_date": "2000-01-02"} for i in range(4)]
    tables.add("dim_payment_schedule", *target, *gone, {"item_date": "2000-01-02"})
    return tables


def test_a_payment_job_in_slices_is_the_whole_job(payments):
    archive = payments.build("dim_payment_schedule", [{ITEM: "g1"}])
    job = partial(payment.payment_job, payments, payments["dim_payment_schedule"], archive, W, NOW)
    whole, parts = job(), [job(part=part) for part in store.parts(4)]
    columns = whole.columns
    assert rows(union(p.table for p in parts), *columns) == rows(whole.table, *columns)
    side = "dim_payment_schedule_removed"
    assert rows(union(p.appends[side] for p in parts), *columns) == rows(whole.appends[side], *columns)
    source = [payment.payment_source(SlicedTables(payments, payment.BY_SCHEDULE, part), W, NOW) for part in store.parts(4)]
    assert rows(union(source), ITEM, "organization_id") == rows(payment.payment_source(payments, W, NOW), ITEM, "organization_id")


def test_a_slice_of_a_merge_shuffles_its_source_once(spark, payments):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = payment.payment_merge(payments, payments["dim_payment_schedule"], W, NOW, part=(1, 4))
        merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_and_null_items_fail_in_slices_too(payments):
    for bad in ("i1", None):
        items = payments["lms_payment_schedule_items"].unionByName(payments.build("lms_payment_schedule_items", [
            {ITEM: bad, "payment_schedule_id": 1, "_snowflake_inserted_at": "2000-06-01"}]))
        landing = {n: payments[n] for n in ("lms_payment_schedules", "lms_base_loans", "lms_customer_info_flat")} | {"lms_payment_schedule_items": items}
        with pytest.raises(Exception, match="several rows|is null"):
            union(payment.payment_merge(landing, payments["dim_payment_schedule"], W, NOW, part=part) for part in store.parts(4)).collect()


def test_a_load_in_slices_logs_and_writes_what_the_whole_does(spark, folder, payments):
    def run(slices):
        house = audit.Warehouse(spark, f"{folder}/{slices}", buckets=8, slices=slices)
        house.write("dim_payment_schedule", payments["dim_payment_schedule"], tuple(payment.KEYS))
        empty = payments.build("dim_payment_schedule", [])
        counts = audit.run_job(house, "dim_payment_schedule", 1, 3, NOW, lambda w, _: payment.payment_job(
            payments, w.read_part("dim_payment_schedule"), empty, W, NOW, part=w.part), appended=("dim_payment_schedule_removed",))
        table, archive = house.read("dim_payment_schedule"), spark.read.parquet(house.path("dim_payment_schedule_removed"))
        return counts, rows(table, *table.columns), rows(archive, *archive.columns), rows(house.step_log(), "log_label", "log_message")

    whole = run(1)
    assert run(4) == whole and {name: n for name, _, n in whole[0]}["delete_removed"] == 5
    with pytest.raises(ValueError, match="cannot be cut"):
        audit.Warehouse(spark, folder, buckets=8, slices=3)


def test_slices_do_not_replace_a_side_table_in_turn(spark, folder, payments):
    house = audit.Warehouse(spark, folder, slices=2)
    house.write("dim_payment_schedule", payments["dim_payment_schedule"], tuple(payment.KEYS))
    with pytest.raises(ValueError, match="would replace dim_payment_schedule_removed"):
        audit.run_job(house, "dim_payment_schedule", 1, 3, NOW, lambda w, _: payment.payment_job(
            payments, w.read_part("dim_payment_schedule"), payments.build("dim_payment_schedule", []), W, NOW, part=w.part))


@pytest.mark.parametrize("parity", [False, True])
def test_a_loan_job_in_slices_is_the_whole_job(spark, tables, parity):
    tables.add("lms_base_loans", *[
        {"base_loan_id": i, "loan_header_id": 100 + i // 2 if i % 5 else None, "customer_id": i, "loan_status": "Delinquent" if i % 2 else "Pending",
         "loan_amount": i, "updated_datetime": "2000-05-01" if i % 3 else "1999-01-01"} for i in range(1, 13)])
    tables.add("lms_loan_header", *[{"loan_header_id": 100 + i, "status": "Withdraw" if i % 2 else "Approved", "created_date": "2000-02-01",
                                     "last_update": "1999-06-01", "first_name": f"n{i}"} for i in range(8)])
    tables.add("lms_loanheader_state", *[{"loan_header_id": 100 + i, "id": i, "action": "open", "action_time": "2000-02-02"} for i in range(8)])
    tables.add("collection_lms_loan_map", *[{"base_loan_id": i, "update_timestamp": "2000-04-04", "delinquency_date": "2000-03-03"} for i in range(1, 9)])
    target = tables.build("dim_loan", [{"base_loan_id": i, "loan_header_id": 100, "loan_status": "Pending", "process_timestamp": "2000-06-01"} for i in (1, 2, 3, 20)])
    rates = spark.createDataFrame([(i, "0.1") for i in range(1, 13)], "base_loan_id long, loan_interest_pct string")
    job = partial(loan.loan_job, tables, target, tables["reject_log"], W, NOW, parity, START, rates)
    landed = union(loan.landed_loans(SlicedTables(tables, loan.BY_HEADER, part), W, NOW) for part in store.parts(2))
    whole, parts = job(), [job(landed, part) for part in store.parts(2)]
    assert rows(union(p.table for p in parts), *whole.columns) == rows(whole.table, *whole.columns)
    assert [sorted(p.appends) for p in parts] == [["reject_log"], []]


def test_a_large_pair_is_compared_in_slices(spark, folder, monkeypatch):
    source = spark.createDataFrame([(i, f"a{i % 4}", i) for i in range(40)] + [(None, "x", 1), (7, "y", 2)], "k long, a string, b long")
    target = spark.createDataFrame([(i, f"a{i % 5}", i + i % 2) for i in range(3, 44)] + [(None, "z", 1), (7, "y", 3)], "k long, a string, b long")
    pair = reconcile.TablePair("s", "t", None, None, keys=("k",))
    whole = reconcile.pair_columns(pair, source, target)
    monkeypatch.setattr(store, "SLICE_ROWS", 10)
    held = shuffle_files(spark)
    sliced = reconcile.pair_columns(pair, source, target, f"{folder}/counts")
    assert not left_behind(spark, held)
    assert sliced.dtypes == whole.dtypes and rows(sliced, *whole.columns) == rows(whole, *whole.columns)
    assert spark.read.parquet(f"{folder}/counts/t").count() > 3 * whole.count()
