"""A chain of correction steps over one table, each table they read joined once."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from tallyhouse.operators.lookup import dedupe_latest
from tallyhouse.operators.modify import update_where

Attach = Callable[[DataFrame], DataFrame]


def attach_latest(extra: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> Attach:
    """A left join of the latest row per key, so that repeated rows of `extra` never multiply the table.

    The pick is partitioned by the key as the join is, so it adds no shuffle.
    """
    return lambda target: target.join(dedupe_latest(extra, keys, order_by), list(keys), "left")


@dataclass(frozen=True)
class Update:
    """A conditional update of a table to which `needs` have been joined."""

    name: str
    needs: tuple[str, ...]
    condition: Column
    changes: dict[str, Column]

    @property
    def flag(self) -> str:
        """Name of the column that tells which rows the update touched."""
        return f"_did_{self.name}"


def apply_updates(target: DataFrame, updates: Sequence[Update], attach: dict[str, Attach]) -> DataFrame:
    """Run the updates in order; each sees what the ones before it wrote.

    A table needed by several updates is joined a single time, before the first of them,
    so the chain costs as many joins as it reads tables, not as it has steps. The joins
    run in the order of `attach`: with those on one key side by side, the target is
    shuffled once per key.
    """
    needed = {need for update in updates for need in update.needs}
    for need, join in attach.items():
        if need in needed:
            target = join(target)
    for update in updates:
        target = update_where(target, update.condition, update.changes, update.flag)
    return target
