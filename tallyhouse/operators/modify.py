"""Insert, update and delete of keyed tables as dataflow.

Parquet tables have no row-level writes, so every operator takes the table and returns
its next state; `sources.store` writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.cleaning import all_of, col
from tallyhouse.operators.lookup import dedupe_latest, ordered
from tallyhouse.operators.presence import only_in_both, only_in_left
from tallyhouse.sources.store import Part, slice_of, WHOLE

INSERT, UPDATE, KEEP = "insert", "update", "keep"


def one_row_per_key(df: DataFrame, keys: Sequence[str], on_duplicate: str, order_by: Sequence[str] = ()) -> DataFrame:
    """A merge source with each key once.

    `error` fails the job on the second row of a key, `latest` keeps the latest row. The rows come out partitioned and sorted by key, as the
    merge needs them, so the check costs no shuffle of its own. A null key is an error:
    it could never match and would be inserted again by every run.
    """
    for key in keys:
        df = df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"merge key {key} is null"))))
    df = df.filter(all_of([F.col(key).isNotNull() for key in keys]))
    if on_duplicate == "latest":
        return dedupe_latest(df, keys, order_by)
    if on_duplicate == "error":
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
        message = F.lit(f"merge source has several rows for one {', '.join(keys)}")
        single = F.when(F.col("_place") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
        return df.withColumn("_place", place).filter(single).drop("_place")
    raise ValueError(f"unknown policy for duplicates: {on_duplicate}")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    insert_only: Sequence[str] = (),
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    small_source: bool = False,
    op_column: str | None = None,
    part: Part = WHOLE,
) -> DataFrame:
    """`target` after a keyed merge of `source`, or one slice of its keys.

    A matched row takes every source column, nulls included, but for `insert_only`;
    columns the source lacks keep their value. Unmatched source rows are inserted.

    Matched rows come from one left join, inserts from one anti join against the target's
    keys alone; both sides end up partitioned by key, so joins on the key that follow
    need no further shuffle of the target. With `small_source` (an increment of a large
    table) the matched keys are found first: Spark then broadcasts the increment, if its
    size allows, and does not shuffle the target at all.
    """
    keys = list(keys)
    # Cut here and not by the caller: both joins then read the source by the same plan, and share its shuffle.
    target, source = slice_of(target, keys, part), slice_of(one_row_per_key(source, keys, on_duplicate, order_by), keys, part)
    written = set(source.columns)
    t, s = target.alias("t"), source.withColumn("_in_source", F.lit(True)).alias("s")

    def after(name: str) -> str:
        if name in keys or name not in written:
            return f"t.`{name}`"
        if name in insert_only:
            return f"CASE WHEN t.`{keys[0]}` IS NOT NULL THEN t.`{name}` ELSE s.`{name}` END AS `{name}`"
        return f"CASE WHEN s._in_source THEN s.`{name}` ELSE t.`{name}` END AS `{name}`"

    kept = [after(name) for name in target.columns]
    new = [f"CAST({f'`{name}`' if name in written else 'NULL'} AS {dtype}) AS `{name}`" for name, dtype in target.dtypes]
    if op_column:
        kept.append(f"CASE WHEN s._in_source THEN '{UPDATE}' ELSE '{KEEP}' END AS {op_column}")
        new.append(f"'{INSERT}' AS {op_column}")

    on = all_of([F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    updated = t.join(s, on, "left").selectExpr(*kept)
    known_keys = target.select(*keys)
    if small_source:
        known_keys = only_in_both(known_keys, source, keys, right_unique=True)
    return updated.unionByName(only_in_left(source, known_keys, keys, right_unique=True).selectExpr(*new))


def one_landed_row(
    landed: DataFrame, keys: Sequence[str], changed: str, facts: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """One row per key for `merge_landed`: the changed row where there is one, with the `facts` of the latest row.

    Several changed rows of a key, or a changed row with a null key, fail the job; unchanged rows without a key go.
    """
    for key in keys:
        refused = F.raise_error(F.lit(f"merge key {key} is null")).cast(landed.schema[key].dataType)
        landed = landed.withColumn(key, F.when(F.col(key).isNull() & F.col(changed), refused).otherwise(F.col(key)))
    landed = landed.filter(all_of([F.col(key).isNotNull() for key in keys]))
    latest = ordered(order_by, facts)
    of_key = Window.partitionBy(*keys)
    message = F.lit(f"merge source has several rows for one {', '.join(keys)}")
    single = F.when(F.col("_place") == 1, True).when(F.col(changed), F.raise_error(message).cast("boolean")).otherwise(False)
    placed = landed.select(
        "*", F.first(F.struct(*facts)).over(of_key.orderBy(*latest)).alias("_facts"),
        F.row_number().over(of_key.orderBy(F.desc(changed), *latest)).alias("_place"),
    ).filter(single)
    others = [c for c in landed.columns if c not in facts]
    return placed.select(*others, *[F.col(f"_facts.{c}").alias(c) for c in facts])


def merge_landed(
    target: DataFrame, landed: DataFrame, keys: Sequence[str], changed: str, facts: Sequence[str],
    insert_only: Sequence[str] = (), op_column: str | None = None,
) -> DataFrame:
    """`target` after a keyed merge of the `landed` rows whose `changed` flag is set, with the `facts` of all landed rows.

    For tables whose change window no scan can apply, and whose corrections need every landing row anyway: one full outer
    join updates, inserts and brings the facts, so the target and each landing table are read and shuffled once. `landed`
    has one row per key (see `one_landed_row`); its other columns are written as by `merge_upsert`.
    """
    keys = list(keys)
    types = dict(target.dtypes)
    written = [c for c in landed.columns if c in types and c not in keys and c not in facts]
    t = target.withColumn("_in_target", F.lit(True)).alias("t")

    def after(name: str) -> str:
        new = f"CAST(l.`{name}` AS {types[name]})"
        if name in keys:
            return f"coalesce(t.`{name}`, {new}) AS `{name}`"
        if name not in written:
            return f"t.`{name}`"
        takes = "t._in_target IS NULL" if name in insert_only else f"l.`{changed}`"
        return f"CASE WHEN {takes} THEN {new} ELSE t.`{name}` END AS `{name}`"

    on = all_of([F.col(f"t.{k}") == F.col(f"l.{k}") for k in keys])
    op = f"CASE WHEN t._in_target IS NULL THEN '{INSERT}' WHEN l.`{changed}` THEN '{UPDATE}' ELSE '{KEEP}' END AS {op_column}"
    joined = t.join(landed.alias("l"), on, "full").filter(F.coalesce("t._in_target", f"l.{changed}"))
    return joined.selectExpr(*[after(c) for c in target.columns], *([op] if op_column else []), *[f"l.`{c}`" for c in facts])


def update_where(target: DataFrame, condition: Column, changes: dict[str, Column], flag: str | None = None) -> DataFrame:
    """Set columns on the rows that meet a condition; a null condition changes nothing.

    With `flag`, a column of that name tells which rows were touched.
    """
    touched = F.coalesce(condition, F.lit(False))
    updates = {
        name: F.when(touched, value.cast(target.schema[name].dataType)).otherwise(F.col(name))
        for name, value in changes.items()
    }
    if flag:
        updates[flag] = touched
    return target.withColumns(updates)


def update_from(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    changes: dict[str, Column],
    condition: Column | None = None,
    order_by: Sequence[str] | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Set columns from the source row with the same key.

    Source columns are read in `changes` and `condition` under the prefix `src_`.
    Where a key has several source rows, `order_by` picks the latest; without it the
    source must hold each key once.
    """
    single = one_row_per_key(source.dropna(subset=list(keys)), keys, "error" if order_by is None else "latest", order_by or ())
    renamed = single.select(*keys, *[F.col(c).alias(f"src_{c}") for c in single.columns if c not in keys])
    joined = target.join(renamed.withColumn("_found", F.lit(True)), list(keys), "left")
    found = F.col("_found").isNotNull()
    touched = found if condition is None else found & condition
    updated = update_where(joined, touched, changes, flag)
    return updated.select(*target.columns, *([flag] if flag else []))


def delete_keys(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`target` without the rows whose key is in `gone`."""
    return only_in_left(target, gone, keys)


def purge(
    target: DataFrame,
    landing: DataFrame,
    keys: Sequence[str],
    archive: DataFrame | None = None,
    archive_where: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split off the rows whose key left landing: (kept rows, rows to archive).

    Rows already archived are not returned again, nor rows outside `archive_where`.
    """
    kept = only_in_both(target, landing, keys, right_unique=True)
    removed = only_in_left(target, landing, keys, right_unique=True)
    if archive_where is not None:
        removed = removed.filter(archive_where)
    if archive is not None:
        removed = only_in_left(removed, archive, keys, right_unique=True)
    return kept, removed


def append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT ... SELECT by column name; columns the rows lack are null."""
    return target.unionByName(rows, allowMissingColumns=True).select(*target.columns)


def project(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """A renaming projection: {new name: column}."""
    return df.select(*[col(c).alias(name) for name, c in mapping.items()])


def diverges(pairs: Sequence[tuple[Column, Column]], null_safe: bool = False) -> Column:
    """Any pair differs. Plain `<>` ignores a null on either side; `null_safe` sees it."""
    tests = [~a.eqNullSafe(b) if null_safe else a != b for a, b in pairs]
    result = tests[0]
    for test in tests[1:]:
        result = result | test
    return result
