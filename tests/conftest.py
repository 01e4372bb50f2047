import tempfile

import pytest

from tallyhouse.session import build_session
from tallyhouse.sources import schemas as S
from tallyhouse.sources.derived import TARGET_TYPES

TARGETS = {
    "dim_customer": S.DIM_CUSTOMER,
    "dim_loan": [*S.DIM_LOAN, *S.DIM_LOAN_LATER],
    "dim_payment_schedule": [*S.DIM_PAYMENT_SCHEDULE, *S.DIM_PAYMENT_SCHEDULE_LATER],
    "fct_collection_detail": [*S.FCT_COLLECTION_DETAIL, *S.FCT_COLLECTION_DETAIL_LATER],
    "dim_insurance_protection_plan": S.DIM_INSURANCE_PROTECTION_PLAN,
    "dim_insurance_protection_plan_status": S.DIM_INSURANCE_PROTECTION_PLAN_STATUS,
}
REJECT_LOG = (
    "table_name string, column_name string, column_value string, reject_reason string, "
    "process_datetime date, is_fixed int, fixed_date date"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "local[4]", app="tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


class Tables:
    """Landing and warehouse tables of a few rows; columns a row leaves out are null."""

    def __init__(self, spark):
        self.spark = spark
        self.given = {}

    def add(self, name, *rows):
        self.given[name] = self.build(name, rows)
        return self

    def build(self, name, rows):
        ddl = S.LANDING_DDL.get(name) or (
            REJECT_LOG if name == "reject_log" else ", ".join(f"{c} {TARGET_TYPES[c]}" for c in TARGETS[name])
        )
        fields = [f.strip() for f in " ".join(ddl.split()).replace("(38,2)", "(38;2)").replace("(18,6)", "(18;6)").split(",")]
        typed = [(f.split(" ", 1)[0], f.split(" ", 1)[1].replace(";", ",")) for f in fields]
        strings = ", ".join(f"`{c}` string" for c, _ in typed)
        data = [tuple(None if row.get(c) is None else str(row[c]) for c, _ in typed) for row in rows]
        return self.spark.createDataFrame(data, strings).selectExpr(*[f"CAST(`{c}` AS {t}) AS `{c}`" for c, t in typed])

    def __getitem__(self, name):
        return self.given.setdefault(name, None) or self.build(name, [])


@pytest.fixture
def tables(spark):
    return Tables(spark)


def rows(df, *columns):
    """Rows as sorted tuples, values as plain text or None."""
    out = [tuple(None if v is None else str(v) for v in row) for row in df.select(*columns).collect()]
    return sorted(out, key=lambda r: tuple("" if v is None else v for v in r))
