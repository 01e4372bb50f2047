"""dim_customer: a full refresh from the flat customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions import cleaning as C
from tallyhouse.functions.change_window import moment
from tallyhouse.operators.modify import merge_upsert
from tallyhouse.plans.job import merge_step, OP, JobResult, Tables
from tallyhouse.sources import schemas as S

KEYS = ["customer_id", "lms_code"]


def customer_source(landing: Tables, now: str) -> DataFrame:
    """Customers of known organizations, money cleaned, emails in lower case."""
    cleaned = {
        "grossmonthly": C.money_text("grossmonthly"),
        "nmi": C.money_text("nmi"),
        "paycheck_amount": C.paycheck("paycheck_amount", "nmi", "payfrequency").cast("string"),
        "email": F.lower("email"),
        "email2": F.lower("email2"),
        "created_date": F.col("created_date").cast("timestamp_ntz"),
    }
    organizations = landing["upm_organizations"].select(
        "organization_id", "organization_name", "is_active", "email_domain"
    )
    return (
        landing["lms_customer_info_flat"]
        .join(organizations, "organization_id")
        .select(
            *[cleaned[name].alias(name) if name in cleaned else name for name in S.CUSTOMER_PASS],
            F.lit(V.LMS_CODE).alias("lms_code"),
            "organization_name", "is_active", "email_domain",
            moment(now).alias("process_timestamp"),
        )
    )


def customer_job(landing: Tables, target: DataFrame, now: str, small_source: bool = False) -> JobResult:
    merged = merge_upsert(
        target, customer_source(landing, now), KEYS, S.INSERT_ONLY["dim_customer"],
        small_source=small_source, op_column=OP,
    )
    return JobResult(merged, target.columns, (merge_step(),), keys=tuple(KEYS))
