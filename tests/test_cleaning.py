import hashlib

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as C
from tallyhouse.functions.standardize import standardize, unreadable_money


def one(spark, expression, **values):
    row = tuple(values.values())
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([row], schema).select(expression.alias("x")).first()[0]


@pytest.mark.parametrize("text, expected", [
    ("$1,234.5", "1234.50"), ("$", None), ("", None), (None, None), ("1.005", "1.01"), ("-$5", None), ("7", "7.00"),
])
def test_money_text(spark, text, expected):
    strict = text != "-$5"
    assert one(spark, C.money_text("m", strict), m=text) == expected


def test_bad_money_raises_when_strict_and_is_null_otherwise(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, C.money_text("m"), m="abc")
    assert one(spark, C.money_text("m", strict=False), m="abc") is None


@pytest.mark.parametrize("amount, monthly, frequency, expected", [
    ("$500", "$1,000", "B", "500.00"), ("$0", "$1,000", "B", "461.54"), (None, "1000", "W", "230.77"),
    ("0", "1000.01", "S", "500.01"), ("-1", "1000", "M", "1000.00"), (None, "1000", None, "1000.00"), (None, None, "B", None),
])
def test_paycheck(spark, amount, monthly, frequency, expected):
    assert one(spark, C.paycheck("a", "m", "f").cast("string"), a=amount, m=monthly, f=frequency) == expected


@pytest.mark.parametrize("kind, amount, status, expected", [
    (None, "1", "Cleared", "D"), (None, "0", "Cleared", "D"), (None, "-1", "Cleared", "C"), (None, "1", "scheduled", None),
    (None, "-1", "cancelled", None), (None, "1", None, None), ("X", "1", "Cleared", "X"), (None, None, "Cleared", None),
])
def test_item_type(spark, kind, amount, status, expected):
    assert one(spark, C.item_type("k", F.col("a").cast("decimal(38,2)"), "s"), k=kind, a=amount, s=status) == expected


@pytest.mark.parametrize("header, status, expected", [
    ("Withdraw", "Pending", "Withdraw"), ("Withdraw", "Originated", "Originated"), ("Approved", "Pending", "Pending"),
    (None, "Pending", "Pending"), ("Withdraw", None, None),
])
def test_loan_status(spark, header, status, expected):
    assert one(spark, C.loan_status("h", "s"), h=header, s=status) == expected


def test_org_slices(spark):
    orgs = spark.createDataFrame([(o,) for o in (1, 2, 3, 4, 5, 9, 0, -1, None)], "o int")
    assert [r[0] for r in orgs.select(C.org_slice("o")).collect()] == [1, 2, 3, 3, 4, 4, None, None, None]


def test_surrogate_key_writes_nulls_out(spark):
    key = one(spark, C.surrogate_key("a", "b"), a="7", b=None)
    assert key == hashlib.md5(b"7-_dbt_null_").hexdigest()


def test_binary_to_hex(spark):
    assert one(spark, C.binary_to_hex(F.col("a").cast("binary")), a="Az") == "417a"


def test_remaining_defaults_all_but_the_total(spark):
    assert one(spark, C.remaining(F.col("a").cast("decimal(38,2)"), F.lit(None).cast("int")).cast("string"), a=None) == "0.00"
    assert one(spark, C.remaining(F.col("a").cast("decimal(38,2)"), F.lit(1), zero_default=False), a=None) is None


def test_failure_time_is_null_for_bad_text(spark):
    assert one(spark, C.failure_time("t"), t="bad") is None
    assert str(one(spark, C.failure_time("t"), t="1999-01-02 03:04:05")) == "1999-01-02 03:04:05"


def test_standardize_and_rejects(spark):
    df = spark.createDataFrame([("1", "$1,0", "1999-01-02", " A@B "), ("2", "abc", "x", None), ("3", "$", None, None)], "k string, m string, d string, e string")
    out = standardize(df, amounts=["m"], dates=["d"], emails=["e"])
    assert rows(out, "k", "m", "d", "e") == [("1", "10.00", "1999-01-02", "a@b"), ("2", None, None, None), ("3", None, None, None)]
    assert rows(unreadable_money(df, "k", "m", "t"), "column_value", "column_name") == [("2", "m")]
