"""What a load job returns: the next state of its table and a flag column per step."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.correct import Update
from tallyhouse.operators.modify import INSERT, UPDATE
from tallyhouse.sources.store import Part, slice_of

Tables = Mapping[str, DataFrame]
DELETED = "_deleted"
OP = "_op"


@dataclass(frozen=True)
class SlicedTables:
    """`tables`, of which those named in `keys` are cut down to the rows whose key falls into one slice."""

    tables: Tables
    keys: Mapping[str, str]
    part: Part

    def __getitem__(self, name: str) -> DataFrame:
        table = self.tables[name]
        return slice_of(table, [self.keys[name]], self.part) if name in self.keys else table


@dataclass(frozen=True)
class Step:
    """A logged step: the rows it touched are those whose `counts` holds."""

    name: str
    kind: str
    counts: Column


@dataclass(frozen=True)
class JobResult:
    """`flagged` holds every row, deleted ones included, with the step columns.

    `keys`: what tells its rows apart; a job without them has its table replaced as a whole.
    """

    flagged: DataFrame
    columns: list[str]
    steps: tuple[Step, ...]
    appends: dict[str, DataFrame] = field(default_factory=dict)
    keys: tuple[str, ...] = ()

    @property
    def table(self) -> DataFrame:
        rows = self.flagged.filter(~F.col(DELETED)) if DELETED in self.flagged.columns else self.flagged
        return rows.select(*self.columns)

    def changes(self) -> DataFrame:
        """The rows that a step touched, with the flag of deleted ones."""
        touched = [F.coalesce(step.counts, F.lit(False)) for step in self.steps]
        gone = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in self.flagged.columns else F.lit(False)
        rows = self.flagged.filter(reduce(or_, touched))
        return rows.select(*self.columns, gone.alias(DELETED))

    def step_counts(self) -> list[Column]:
        """One aggregate per step, for an observation on the plan that writes the table."""
        return [F.count_if(step.counts).alias(step.name) for step in self.steps]


def merged_rows() -> Column:
    """Rows a merge inserted or updated."""
    return F.col(OP).isin(INSERT, UPDATE)


def merge_step() -> Step:
    return Step("merge", "Merge", merged_rows())


def update_steps(updates: list[Update]) -> tuple[Step, ...]:
    return tuple(Step(update.name, "Update", F.col(update.flag)) for update in updates)
