"""The change window of an incremental load and predicates over it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import any_of, col


def moment(text: str | Column) -> Column:
    """A timestamp without zone; text is folded into the plan as a literal."""
    return text if isinstance(text, Column) else F.lit(str(text)).cast("timestamp_ntz")


@dataclass(frozen=True)
class ChangeWindow:
    """Changes after `start` up to and including `end`."""

    start: str
    end: str

    def __post_init__(self):
        if str(self.start) > str(self.end):
            raise ValueError(f"the window starts at {self.start}, after its end at {self.end}")

    def holds(self, column: str | Column) -> Column:
        return (col(column) > moment(self.start)) & (col(column) <= moment(self.end))

    def since_start(self, column: str | Column) -> Column:
        return col(column) >= moment(self.start)


def changed(window: ChangeWindow, *columns: str | Column) -> Column:
    """Any of the change columns falls into the window.

    Over columns of one table the condition reaches the parquet scan.
    """
    return any_of([window.holds(c) for c in columns])


def changed_keys(window: ChangeWindow, key: str, *tables: tuple[DataFrame, list[str]]) -> DataFrame:
    """Keys changed in any of several tables.

    Each table is filtered at its own scan, which one OR over a join cannot do.
    """
    parts = [table.filter(changed(window, *columns)).select(key) for table, columns in tables]
    keys = parts[0]
    for part in parts[1:]:
        keys = keys.unionByName(part)
    return keys.distinct()


def recent(window: ChangeWindow, item_date: str | Column, processed: str | Column) -> Column:
    """Dated or processed since the start of the window."""
    return window.since_start(item_date) | window.since_start(processed)
