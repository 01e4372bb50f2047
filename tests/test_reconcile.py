import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.plans import reconcile as R
from tallyhouse.plans import rules

SCHEMA = "k int, a string, b int"
DATA = [(1, "x", 1), (2, "y", None), (2, "y", None), (3, None, 3)]


def frame(spark, data=DATA, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def pair(source, target):
    return R.TablePair("s", "t", lambda: source, lambda: target)


def summary(source, target):
    return R.reconcile_all([pair(source, target)]).first().asDict()


def test_a_table_matches_itself_in_any_order_and_case(spark):
    same = frame(spark, DATA[::-1]).repartition(3).toDF("K", '"A"', "B").select('"A"', "B", "K")
    line = summary(frame(spark), same)
    assert line == {
        "source_table": "s", "target_table": "t", "source_count": 4, "target_count": 4, "count_match": "Match",
        "schema_match": "Match", "datatype_match": "Match", "null_match": "Match", "data_match": "Match",
    }
    assert R.data_equal(frame(spark), same).first()["data_match"] == "Match"


@pytest.mark.parametrize("data, count, nulls", [
    ([(1, "x", 1), (2, "y", None), (3, None, 3)], "Mismatch", "Mismatch"),          # a copy is missing
    ([(1, "x", 2), (2, "y", None), (2, "y", None), (3, None, 3)], "Match", "Match"),  # a value differs
    ([(1, None, 1), (2, "y", None), (2, "y", None), (3, "x", 3)], "Match", "Match"),  # values swapped with nulls
    ([(1, "x", 1), (1, "x", 1), (2, "y", None), (3, None, 3)], "Match", "Mismatch"),  # copies moved
])
def test_differences_are_seen(spark, data, count, nulls):
    line = summary(frame(spark), frame(spark, data))
    assert (line["count_match"], line["null_match"], line["data_match"]) == (count, nulls, "Mismatch")
    assert R.data_equal(frame(spark), frame(spark, data)).first()["data_match"] == "Mismatch"


def test_null_moved_between_columns_is_seen(spark):
    left = spark.createDataFrame([("a", None)], "x string, y string")
    right = spark.createDataFrame([(None, "a")], "x string, y string")
    assert summary(left, right)["data_match"] == "Mismatch"


def test_types_and_columns(spark):
    wider = frame(spark).withColumn("b", F.col("b").cast("bigint"))
    line = summary(frame(spark), wider)
    assert (line["datatype_match"], line["schema_match"], line["data_match"]) == ("Equivalent", "Match", "Match")
    assert summary(frame(spark), wider.withColumn("c", F.lit(1)))["schema_match"] == "Mismatch"
    binary = spark.createDataFrame([(bytearray(b"\x01"),)], "x binary")
    assert rows(R.aligned(binary, binary)[0], "x") == [("01",)]


def test_null_report_names_the_columns(spark):
    report = R.null_report(frame(spark), frame(spark, [(1, None, None)]).toDF("K", "A", "B"))
    assert rows(report, "column_name", "source_nulls", "target_nulls", "null_match") == [
        ("a", "1", "1", "Match"), ("b", "2", "1", "Mismatch"), ("k", "0", "0", "Match")]


def test_keyed_difference_with_repeated_keys(spark):
    target = frame(spark, [(1, "x", 9), (2, "y", None), (2, "z", 5), (2, "z", 5), (4, "n", 4), (None, "q", 1)])
    diff = R.keyed_diff(frame(spark), target, ["k"])
    columns = ("k", "source_rows", "target_rows", "equal_rows", "differing_rows", "only_in_source", "only_in_target")
    assert rows(diff, *columns) == [
        (None, "0", "1", "0", "0", "0", "1"), ("1", "1", "1", "0", "1", "0", "0"), ("2", "2", "3", "1", "1", "0", "1"),
        ("3", "1", "0", "0", "0", "1", "0"), ("4", "0", "1", "0", "0", "0", "1")]
    assert rows(R.column_mismatches(frame(spark), target, ["k"]), "column_name", "mismatched_rows") == [("a", "1"), ("b", "2")]
    assert ("k=2: 1 differing, 0 only in source, 1 only in target",) in rows(R.diff_lines(diff, ["k"]), "line")
    totals = R.diff_totals(diff).first()
    assert (totals["keys_differing"], totals["keys_only_in_source"], totals["keys_only_in_target"]) == (2, 1, 2)


def test_one_hot_key_is_compared_without_ranking_it(spark):
    hot = spark.range(3000).select(F.lit(1).alias("k"), (F.col("id") % 1000).cast("string").alias("a"))
    moved = hot.withColumn("a", F.when(F.col("a") == "7", "x").otherwise(F.col("a")))
    diff = R.keyed_diff(hot, moved, ["k"]).first()
    assert (diff["equal_rows"], diff["differing_rows"]) == (2997, 3)
    assert R.column_mismatches(hot, moved, ["k"]).first()["mismatched_rows"] == 3


def test_windows_apply_per_side(spark):
    stamped = frame(spark, [(1, "1999-01-01", 1), (2, "1999-01-05", 1)]).withColumn("at", F.col("a").cast("timestamp_ntz"))
    with_filter = R.TablePair("s", "t", lambda: stamped, lambda: stamped, "at", None)
    line = R.reconcile_all([with_filter], R.count_summary, "1999-01-01 00:00:00", "1999-01-05 00:00:00").first()
    assert (line["source_count"], line["target_count"]) == (0, 2)


@pytest.mark.parametrize("parity, expected", [(False, [("grossmonthly", "1"), ("paycheck_amount", "1")]), (True, [("grossmonthly", "3"), ("paycheck_amount", "1")])])
def test_number_rules(spark, parity, expected):
    df = spark.createDataFrame([(None, None), ("5", None), ("12.50", None), ("abc", "-5")], "grossmonthly string, paycheck_amount string")
    assert rows(R.check_rules(df, rules.customer_rules(parity)), "rule", "violations") == expected


def test_rule_report(spark):
    payments = spark.createDataFrame([("C",), ("X",), (None,)], "item_type string")
    customers = spark.createDataFrame([("5", "x")], "grossmonthly string, paycheck_amount string")
    lines = rows(rules.rule_lines(rules.all_rules(payments, customers)), "line")
    assert ("Invalid count: item_type -> 1.",) in lines and len(lines) == 6
