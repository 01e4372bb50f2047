"""Aggregates over the dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payments_by_status(payments: DataFrame, customers: DataFrame) -> DataFrame:
    """Item counts and amounts per organization name and status.

    Items are summed per customer first, so the join moves one row per customer and
    status even where one customer holds a large part of all items.
    """
    per_customer = payments.groupBy("customer_id", "status").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("total_amount").alias("total_amount")
    )
    names = customers.select("customer_id", "organization_name")
    return per_customer.join(names, "customer_id").groupBy("organization_name", "status").agg(
        F.sum("item_count").alias("item_count"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount")
    )


def collections_by_status(collections: DataFrame) -> DataFrame:
    return collections.groupBy("status_code").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("total_amount").cast("decimal(38,2)").alias("total_amount"),
        F.sum("outstanding_total_amount").cast("decimal(38,2)").alias("outstanding_total_amount"),
    )
