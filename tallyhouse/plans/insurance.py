"""dim_insurance_protection_plan and dim_insurance_protection_plan_status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.change_window import ChangeWindow, changed, moment
from tallyhouse.operators.modify import merge_upsert
from tallyhouse.plans.job import merge_step, OP, JobResult, Tables
from tallyhouse.sources import schemas as S

PLAN_KEYS = ["protection_plan_id"]
STATUS_KEYS = ["base_loan_id"]


def plan_join(landing: Tables, window: ChangeWindow, now: str) -> DataFrame:
    """Plans changed in the window with policy, provider and status rows.

    A plan with several status logs comes out once per log; `status_log_id` tells them apart.
    """
    policies = landing["insurance_policy"].select(
        F.col("id").alias("policy_id"), "policy_number", "product_code", "policy_document_url", "insurance_provider_id"
    )
    providers = landing["insurance_provider"].select(
        F.col("id").alias("insurance_provider_id"), F.col("name").alias("insurance_provider_name"),
        F.col("code").alias("insurance_provider_code"), "enquiry_email", "enquiry_phone", "customer_dashboard_url",
    )
    logs = landing["protection_plan_status_log"].select("protection_plan_application_id", F.col("id").alias("status_log_id"))
    statuses = landing["protection_plan_status"].select(F.col("protection_plan_status_log_id").alias("status_log_id"), "base_loan_id")
    plans = landing["protection_plan"].filter(changed(window, *S.CHANGE_COLUMNS)).withColumnRenamed("id", "protection_plan_id")
    return (
        plans.join(policies, "policy_id")
        .join(providers, "insurance_provider_id")
        .join(logs.join(statuses, "status_log_id"), "protection_plan_application_id")
        .select(
            *[c for c in S.DIM_INSURANCE_PROTECTION_PLAN if c != "process_timestamp"],
            moment(now).alias("process_timestamp"), "status_log_id",
        )
    )


def status_source(landing: Tables, now: str) -> DataFrame:
    """Status rows with their log, whole tables."""
    logs = landing["protection_plan_status_log"].select(
        F.col("id").alias("protection_plan_status_log_id"), "attempted_status", "status", "span_id", "created_datetime"
    )
    return (
        landing["protection_plan_status"].join(logs, "protection_plan_status_log_id")
        .withColumn("process_timestamp", moment(now))
        .select(*S.DIM_INSURANCE_PROTECTION_PLAN_STATUS)
    )


def plan_job(landing: Tables, target: DataFrame, window: ChangeWindow, now: str, small_source: bool = False) -> JobResult:
    """A plan with several status logs takes the newest."""
    merged = merge_upsert(
        target, plan_join(landing, window, now), PLAN_KEYS, on_duplicate="latest",
        order_by=["status_log_id"], small_source=small_source, op_column=OP,
    )
    return JobResult(merged, target.columns, (merge_step(),), keys=tuple(PLAN_KEYS))


def status_job(landing: Tables, target: DataFrame, now: str, small_source: bool = False) -> JobResult:
    """A loan with several status rows takes the one with the newest log."""
    merged = merge_upsert(
        target, status_source(landing, now), STATUS_KEYS, on_duplicate="latest",
        order_by=["protection_plan_status_log_id"], small_source=small_source, op_column=OP,
    )
    return JobResult(merged, target.columns, (merge_step(),), keys=tuple(STATUS_KEYS))
