import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow
from tallyhouse.plans import audit, customer, payment
from tallyhouse.plans.job import JobResult, Step
from tallyhouse.session import build_session
from tallyhouse.sources import reports, scan, store
from tallyhouse.streaming.upsert import not_late, stream_landing, upsert_stream

NOW = "2001-01-01 00:00:00"


def numbers(spark, *values):
    return spark.createDataFrame([(k, f"v{k}") for k in values], "k long, v string")


def test_a_table_is_replaced_by_rows_computed_from_it(spark, folder):
    path = f"{folder}/t"
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, path)
    store.replace(numbers(spark, 1, 2), path, f"{folder}/s1")
    store.replace(store.read_table(spark, path).filter("k = 1"), path, f"{folder}/s2")
    assert rows(store.read_table(spark, path), "k") == [("1",)]
    with pytest.raises(Exception, match="broken"):
        store.replace(numbers(spark, 2).withColumn("v", F.raise_error(F.lit("broken")).cast("string")), path, f"{folder}/s3")
    assert rows(store.read_table(spark, path), "k") == [("1",)]


def test_append_truncate_and_reports(spark, folder):
    store.append(numbers(spark, 1), f"{folder}/log")
    store.append(numbers(spark, 2), f"{folder}/log")
    store.truncate_load(numbers(spark, 1, 2), f"{folder}/stage")
    store.truncate_load(numbers(spark, 3), f"{folder}/stage")
    assert rows(spark.read.parquet(f"{folder}/log"), "k") == [("1",), ("2",)]
    assert rows(spark.read.parquet(f"{folder}/stage"), "k") == [("3",)]
    reports.write_csv_report(numbers(spark, 1), f"{folder}/csv")
    assert rows(spark.read.option("header", True).csv(f"{folder}/csv"), "k", "v") == [("1", "v1")]
    reports.write_text_report(numbers(spark, 1).select("v"), f"{folder}/text")
    assert rows(spark.read.text(f"{folder}/text"), "value") == [("v1",)]


def test_changes_rewrite_only_the_partitions_they_touch(spark, folder):
    path, buckets, stages = f"{folder}/t", 8, iter(range(9))
    store.write_table(numbers(spark, *range(100), None), path, ["k"], buckets)

    def files():
        read = spark.read.parquet(path).select(store.BUCKET, F.input_file_name().alias("file")).distinct().collect()
        return {r[0]: r[1] for r in read}

    def apply(*changes):
        stage = f"{folder}/changes{next(stages)}"
        spark.createDataFrame(list(changes), "k long, v string, gone boolean").write.parquet(stage)
        return store.apply_changes(spark, path, spark.read.parquet(stage), ["k"], buckets, "gone")

    before = files()
    touched = apply((5, "new", None), (1000, "new", False), (7, "v7", True))
    after = files()
    assert {b for b in before if before[b] != after[b]} == set(touched) and 0 < len(touched) <= 3
    table = store.read_table(spark, path)
    assert table.columns == ["k", "v"] and table.count() == 101 and table.filter("k = 7").count() == 0
    assert rows(table.filter("v = 'new'"), "k") == [("1000",), ("5",)]
    held = rows(table, "k", "v")
    # The same changes again, and none, change nothing.
    assert apply((5, "new", None), (1000, "new", False), (7, "v7", True)) == touched and apply() == []
    assert rows(store.read_table(spark, path), "k", "v") == held
    assert apply((None, "null", False)) and rows(store.read_table(spark, path).filter("k IS NULL"), "v") == [("null",)]


def test_a_partition_whose_rows_all_go_is_empty_to_readers(spark, folder):
    path = f"{folder}/t"
    store.write_table(numbers(spark, 1, 2), path, ["k"], 1)
    for k, stage in ((1, "a"), (2, "b")):
        spark.createDataFrame([(k, "x", True)], "k long, v string, gone boolean").write.parquet(f"{folder}/{stage}")
        store.apply_changes(spark, path, spark.read.parquet(f"{folder}/{stage}"), ["k"], 1, "gone")
    assert store.read_table(spark, path).count() == 0 and spark.read.parquet(path).count() == 1


def test_scan_helpers(spark, folder):
    df = spark.createDataFrame([(1, "1999-01-01"), (2, "1999-01-02"), (2, "1999-01-03"), (3, "1999-01-04")], '`"ID"` int, At string')
    plain = scan.plain_names(df).withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert plain.columns == ["id", "at"]
    inside = scan.read_source(plain, "at", "1999-01-01 00:00:00", "1999-01-04 00:00:00", ["id"], 1)
    assert rows(inside, "id", "at") == [("2", "1999-01-02 00:00:00")]
    assert scan.add_landing_columns(plain).columns[2:] == list(scan.LANDING_ONLY)


def test_a_window_prunes_landing_laid_out_by_change(spark, folder):
    stamps = [("a", "1998-01-10", None), ("b", "1997-05-05", "1998-01-20"), ("c", "1997-05-05", "1997-06-01"),
              ("d", None, None), ("e", "1998-01-15", "1998-03-01"), ("f", "1998-02-02", None)]
    df = spark.createDataFrame(stamps, "k string, i string, u string").select("k", *[F.col(c).cast("timestamp_ntz").alias(c) for c in "iu"])
    scan.land_by_change(df, f"{folder}/t", ["i", "u"])
    window = ChangeWindow("1998-01-01 00:00:00", "1998-02-01 00:00:00")
    read = scan.read_changed(spark, f"{folder}/t", window, ["i", "u"])
    assert read.columns == ["k", "i", "u"] and rows(read, "k") == [("a",), ("b",), ("e",)]
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*_changed_on[^]]*>= ", plan) and re.search(r"PushedFilters: \[Or\(And\(", plan)


def test_both_window_queries_push_their_window_down(spark):
    from tallyhouse.checks.queries import all_queries

    for key in ("filter_change_window", "payment_source"):
        plan = all_queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*_changed_on", plan) and re.search(r"PushedFilters: \[[^]]*_snowflake_", plan), key


def test_shuffle_partitions_follow_the_input(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert build_session(input_bytes=100 << 40).conf.get("spark.sql.shuffle.partitions") == str(100 * 8192)
        assert build_session(input_bytes=5).conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)


def test_landing_is_read_with_declared_types(spark, folder):
    spark.createDataFrame([(1, "x")], "lead_source_id long, description string").write.parquet(f"{folder}/lead_source.parquet")
    read = scan.read_landing(spark, folder, "lead_source")
    assert read.dtypes == [("description", "string"), ("lead_source_id", "bigint"), ("start_datetime", "timestamp_ntz")]


def test_watermark_counts_successful_batches_only(spark):
    batches = spark.createDataFrame(
        [(1, "1999-01-01", 1), (1, "1999-06-01", 0), (1, "1999-07-01", None), (2, "1999-01-01", 0)], "job_id long, e string, is_success int"
    ).withColumn("check_point_end", F.col("e").cast("timestamp_ntz"))
    assert rows(audit.watermarks(batches), "job_id", "watermark") == [("1", "1999-01-01 00:00:00"), ("2", "2000-01-01 12:00:00")]
    assert audit.next_window(batches, 1, NOW) == ChangeWindow("1999-01-01 00:00:00", NOW)
    assert audit.next_window(batches, 9, NOW).start == "2000-01-01 12:00:00"


@pytest.fixture
def house(spark, folder, tables):
    tables.add("upm_organizations", {"organization_id": 1}).add("lms_customer_info_flat", {"customer_id": 1, "organization_id": 1}, {"customer_id": 2, "organization_id": 1})
    tables.add("dim_customer", {"customer_id": 2, "lms_code": "JAG"}, {"customer_id": 3, "lms_code": "JAG"})
    warehouse = audit.Warehouse(spark, folder)
    warehouse.write("dim_customer", tables["dim_customer"], tuple(customer.KEYS))
    warehouse.record("etl_jobs", spark.createDataFrame([(7, "dim_customer", None, None, None)], audit.JOBS))
    return warehouse


def test_a_job_writes_its_table_and_logs_every_step(house, tables):
    def job(warehouse, window):
        return customer.customer_job(tables, warehouse.read("dim_customer"), NOW)

    assert audit.run_job(house, "dim_customer", 1, 7, NOW, job) == [("merge", "Merge", 2)]
    assert rows(house.read("dim_customer"), "customer_id") == [("1",), ("2",), ("3",)]
    assert rows(house.step_log(), "batch_id", "log_type", "log_message") == [("1", "Merge", "Merge succeeded, row count = 2")]
    assert rows(house.batches(), "batch_id", "is_success", "check_point_start") == [("1", "1", "2000-01-01 12:00:00")]
    assert rows(house.jobs(), "job_id", "is_success", "check_point_end") == [("7", "1", NOW)]
    assert audit.run_job(house, "dim_customer", 2, 7, "2001-01-02 00:00:00", job) == [("merge", "Merge", 2)]
    assert audit.next_window(house.batches(), 7, "2001-01-03 00:00:00").start == "2001-01-02 00:00:00"


def test_a_failure_is_logged_and_moves_nothing(house):
    def job(warehouse, window):
        raise RuntimeError("x" * 900)

    with pytest.raises(RuntimeError):
        audit.run_job(house, "dim_customer", 1, 7, NOW, job)
    log = house.step_log().first()
    assert log["log_message"] == "Merge failed" and len(log["error_message"]) == 500
    assert rows(house.batches(), "is_success") == [("0",)]
    assert rows(house.read("dim_customer"), "customer_id") == [("2",), ("3",)]
    assert audit.next_window(house.batches(), 7, NOW).start == "2000-01-01 12:00:00"


def test_overlapping_jobs_keep_each_others_batches(house, tables):
    def load(warehouse, window):
        return customer.customer_job(tables, warehouse.read("dim_customer"), NOW)

    def during(warehouse, window):
        result = load(warehouse, window)
        warehouse.write("other", warehouse.read("dim_customer"))
        audit.run_job(warehouse, "other", 2, 8, NOW, lambda w, _: JobResult(w.read("other"), w.read("other").columns, (Step("all", "Update", F.lit(True)),)))
        return result

    audit.run_job(house, "dim_customer", 1, 7, NOW, during)
    assert rows(house.batches(), "batch_id", "is_success") == [("1", "1"), ("2", "1")]
    assert audit.next_window(house.batches(), 8, "2001-01-03 00:00:00").start == NOW


def test_a_load_leaves_other_partitions_alone_and_logs_each_slice(spark, folder, tables):
    items = [{"payment_schedule_item_id": str(i), "payment_schedule_id": i, "item_date": "2000-01-01", "_snowflake_inserted_at": "2000-06-01"} for i in range(1, 7)]
    tables.add("lms_payment_schedule_items", *items[:5]).add("lms_payment_schedules", *[{"payment_schedule_id": i, "base_loan_id": i} for i in range(1, 6)])
    tables.add("lms_base_loans", *[{"base_loan_id": i, "customer_id": i} for i in range(1, 6)])
    tables.add("lms_customer_info_flat", *[{"customer_id": i, "organization_id": o} for i, o in enumerate((1, 3, 4, 9, None), 1)])
    many = [{"payment_schedule_item_id": str(i), "item_date": "1990-01-01"} for i in range(1000, 1040)]
    kept = tables["lms_payment_schedule_items"].unionByName(tables.build("lms_payment_schedule_items", [{"payment_schedule_item_id": str(i)} for i in range(1000, 1040)]))
    tables.given["lms_payment_schedule_items"] = kept
    house = audit.Warehouse(spark, folder, buckets=64)
    house.write("dim_payment_schedule", tables.build("dim_payment_schedule", [*many, {"payment_schedule_item_id": "gone", "item_date": "1990-01-01"}]), tuple(payment.KEYS))

    def files():
        return {r[0] for r in spark.read.parquet(house.path("dim_payment_schedule")).select(F.input_file_name()).distinct().collect()}

    def job(warehouse, window):
        table = warehouse.read("dim_payment_schedule")
        return payment.payment_job(tables, table, tables.build("dim_payment_schedule", []), window, NOW)

    before = files()
    counts = {name: n for name, _, n in audit.run_job(house, "dim_payment_schedule", 1, 3, NOW, job, appended=("dim_payment_schedule_removed",))}
    assert [counts[f"merge slice {k}"] for k in (1, 2, 3, 4)] == [1, 0, 2, 1] and counts["delete_removed"] == 1
    assert len(before & files()) >= len(before) - 5
    table = house.read("dim_payment_schedule")
    assert table.count() == 44 and table.filter("payment_schedule_item_id = 'gone'").count() == 0
    assert house.step_log().filter("log_type = 'Merge'").count() == 4


def test_staged_rows_are_written_once_and_logged(spark, folder):
    house = audit.Warehouse(spark, folder)
    read = house.staged("stg", numbers(spark, 1, 2), 5)
    assert rows(read, "k") == [("1",), ("2",)] and "FileScan" in read._jdf.queryExecution().executedPlan().toString()
    assert rows(house.step_log(), "batch_id", "log_message") == [("5", "Insert succeeded, row count = 2")]


def test_side_tables_grow_or_are_replaced(house, spark):
    def job(warehouse, window):
        table = warehouse.read("dim_customer")
        return JobResult(table, table.columns, (Step("all", "Update", F.lit(True)),), {"archive": numbers(spark, 1), "stage": numbers(spark, 2), "log": numbers(spark, 3)})

    for batch in (1, 2):
        audit.run_job(house, "dim_customer", batch, 7, NOW, job, appended=("archive",), staged=("stage",))
    assert spark.read.parquet(house.path("archive")).count() == 2
    assert spark.read.parquet(house.path("stage")).count() == 1
    assert house.read("log").count() == 1
    side = house.step_log().filter("log_label LIKE 'write %'")
    assert rows(side.filter("batch_id = 2"), "log_label", "log_message") == [
        ("write archive", "Insert succeeded, row count = 1"), ("write log", "Update succeeded, row count = 1"),
        ("write stage", "Insert succeeded, row count = 1")]
    assert side.filter("end_datetime <= start_datetime").count() == 0


def test_a_late_row_of_the_stream_changes_nothing(spark):
    target = spark.createDataFrame([(1, 5, "new")], "k long, t int, v string")
    batch = spark.createDataFrame([(1, 4, "late"), (1, 5, "again"), (2, 1, "first")], "k long, t int, v string")
    assert rows(not_late(batch, target, ["k"], ["t"]), "k", "v") == [("1", "again"), ("2", "first")]


def test_stream_of_landing_files_merges_like_batches(spark, folder):
    landing, table = f"{folder}/landing", f"{folder}/table"
    schema = "k long, t int, v string"
    data = [[(1, 1, "a"), (2, 1, "b")], [(1, 2, "c"), (1, 3, "d"), (3, 1, "e")]]
    for part in data:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(landing)
        stream = stream_landing(spark, landing, spark.createDataFrame([], schema).schema)
        query = upsert_stream(stream, table, f"{folder}/checkpoint", ["k"], ["t"])
        query.awaitTermination(120)
    assert rows(store.read_table(spark, table), "k", "v") == [("1", "d"), ("2", "b"), ("3", "e")]
