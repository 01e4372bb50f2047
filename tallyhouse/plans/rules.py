"""Business rules over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions.cleaning import only_numeric
from tallyhouse.plans.reconcile import check_rules

# Report text per rule, the test case and the counted column.
RULE_TEXT = {
    "item_type": ("dwh.dim_payment_schedule", "item_type values should only be in C, D, NULL."),
    "grossmonthly": ("dwh.dim_customer", "grossmonthly values should only be in numbers and periods."),
    "paycheck_amount": ("dwh.dim_customer", "paycheck_amount values should only be in numbers and periods."),
}


def bad_item_type(column: str = "item_type") -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*V.ITEM_TYPES)


def bad_number_text(column: str, parity: bool = False, pattern: str = V.NUMERIC_TEXT) -> Column:
    """Text that is not made of digits and periods.

    `parity` joins its two tests by OR, which every non-null value meets.
    """
    present, wrong = F.col(column).isNotNull(), ~only_numeric(column, pattern)
    return present | wrong if parity else present & wrong


def customer_rules(parity: bool = False) -> dict[str, Column]:
    return {
        "grossmonthly": bad_number_text("grossmonthly", parity, V.NUMERIC_FIRST_CHARACTER if parity else V.NUMERIC_TEXT),
        "paycheck_amount": bad_number_text("paycheck_amount", parity),
    }


def payment_rules() -> dict[str, Column]:
    return {"item_type": bad_item_type()}


def all_rules(payments: DataFrame, customers: DataFrame, parity: bool = False) -> DataFrame:
    return check_rules(payments, payment_rules()).unionByName(check_rules(customers, customer_rules(parity)))


def rule_lines(violations: DataFrame) -> DataFrame:
    """Two report lines per rule, in rule order."""
    def by_rule(value) -> Column:
        result = F.lit(None).cast("string")
        for rule, text in RULE_TEXT.items():
            result = F.when(F.col("rule") == rule, F.lit(value(text))).otherwise(result)
        return result

    test = F.concat(F.lit("Test Case: "), by_rule(lambda t: t[0]), F.lit(" -> "), by_rule(lambda t: t[1]))
    count = F.concat(F.lit("Invalid count: "), F.col("rule"), F.lit(" -> "), F.col("violations").cast("string"), F.lit("."))
    return violations.select(F.explode(F.array(test, count)).alias("line"))
