"""Column expressions: money text, dates, keys and the lending case rules."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse import values as V

MONEY = "decimal(38,2)"


def col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def money(column: str | Column, strict: bool = True) -> Column:
    """Text such as `$1,234.5` as a decimal; empty text is null.

    Text that is no number raises under ANSI mode, or becomes null when not `strict`.
    """
    digits = F.nullif(F.btrim(F.replace(col(column), F.lit(","), F.lit("")), F.lit("$")), F.lit(""))
    return digits.cast(MONEY) if strict else digits.try_cast(MONEY)


def money_text(column: str | Column, strict: bool = True) -> Column:
    return money(column, strict).cast("string")


def paycheck(amount: str | Column, monthly: str | Column, frequency: str | Column) -> Column:
    """The stated paycheck if positive, else monthly income over the pay periods of a month."""
    periods = F.lit(Decimal(1))
    for code, count in V.PAY_PERIODS.items():
        periods = F.when(col(frequency) == code, F.lit(Decimal(count))).otherwise(periods)
    # 24 digits leave the quotient nine decimals, so rounding to cents is not a second rounding.
    share = F.round(money(monthly).cast("decimal(24,2)") / periods, 2).cast(MONEY)
    return F.when(money(amount) > 0, money(amount)).otherwise(share)


def item_type(type_: str | Column, amount: str | Column, status: str | Column) -> Column:
    """A missing item type is debit or credit by sign, for items that are past scheduling."""
    settled = col(type_).isNull() & ~col(status).isin(*V.OPEN_ITEM)
    return (
        F.when(settled & (col(amount) >= 0), "D").when(settled & (col(amount) < 0), "C").otherwise(col(type_))
    )


def loan_status(header_status: str | Column, status: str | Column) -> Column:
    """A withdrawn header overrides the loan statuses that can still be withdrawn."""
    return F.when(withdrawable(header_status, status), V.WITHDRAW).otherwise(col(status))


def withdrawable(header_status: str | Column, status: str | Column) -> Column:
    return (col(header_status) == V.WITHDRAW) & col(status).isin(*V.WITHDRAWABLE)


def org_slice(organization: str | Column) -> Column:
    """The tenant slice of an organization; null for organizations in none."""
    org = col(organization)
    return F.when(org == 1, 1).when(org == 2, 2).when(org.isin(3, 4), 3).when(org >= 5, 4)


def or_zero(column: str | Column) -> Column:
    return F.coalesce(col(column), F.lit(0))


def date_of(*columns: str | Column) -> Column:
    """The date of the first non-null column."""
    return F.coalesce(*[col(c) for c in columns]).cast("date")


def failure_time(column: str | Column) -> Column:
    """Text as a timestamp without zone, null where it is none."""
    return col(column).try_cast("timestamp_ntz")


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the columns as text, null written out so it takes part in the key."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(V.NULL_KEY_TEXT)) for c in columns]
    return F.md5(F.concat_ws(V.NULL_KEY_SEPARATOR, *parts))


def binary_to_hex(column: str | Column) -> Column:
    return F.lower(F.hex(col(column)))


def only_numeric(column: str | Column, pattern: str = V.NUMERIC_TEXT) -> Column:
    return col(column).rlike(pattern)


def remaining(amount: str | Column, collected: str | Column, zero_default: bool = True) -> Column:
    """Amount less what was collected; a missing amount counts as zero only if asked."""
    left = or_zero(amount) if zero_default else col(amount)
    return (left - or_zero(collected)).cast(MONEY)


def any_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


def all_of(conditions: list[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result & condition
    return result
