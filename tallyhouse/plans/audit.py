"""Control tables around a job: windows, batches, step log, failures."""

from __future__ import annotations

import copy
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyhouse import values as V
from tallyhouse.functions.change_window import ChangeWindow, moment
from tallyhouse.operators.lookup import latest_by
from tallyhouse.operators.modify import update_where
from tallyhouse.plans.job import DELETED, JobResult
from tallyhouse.sources import store

JOBS = "job_id long, job_name string, is_success int, check_point_start timestamp_ntz, check_point_end timestamp_ntz"
BATCHES = (
    "batch_id long, job_id long, batch_type string, batch_label string, check_point_type string, "
    "check_point_start timestamp_ntz, check_point_end timestamp_ntz, is_success int, "
    "start_datetime timestamp_ntz, end_datetime timestamp_ntz"
)
STEP_LOG = (
    "batch_id long, log_type string, log_label string, log_message string, error_message string, "
    "start_datetime timestamp_ntz, end_datetime timestamp_ntz"
)


def watermarks(batches: DataFrame) -> DataFrame:
    """End of the last successful window per job, or the first-run default."""
    succeeded = F.when(F.col("is_success") == 1, F.col("check_point_end"))
    return batches.groupBy("job_id").agg(F.coalesce(F.max(succeeded), moment(V.FIRST_WATERMARK)).alias("watermark"))


def next_windows(jobs: DataFrame, batches: DataFrame, now: str) -> DataFrame:
    """The window each job would load now; failed batches do not move it."""
    return jobs.select("job_id", "job_name").join(watermarks(batches), "job_id", "left").select(
        "job_id", "job_name",
        F.coalesce("watermark", moment(V.FIRST_WATERMARK)).alias("check_point_start"),
        moment(now).alias("check_point_end"),
    )


def next_window(batches: DataFrame, job_id: int, now: str) -> ChangeWindow:
    """The next window of one job, as values for its plan."""
    mark = watermarks(batches.filter(F.col("job_id") == job_id)).select(F.col("watermark").cast("string")).first()
    return ChangeWindow(mark[0] if mark else V.FIRST_WATERMARK, now)


def job_id_of(jobs: DataFrame, name: str) -> DataFrame:
    return jobs.filter(F.col("job_name") == name).select("job_id")


def open_batch(like: DataFrame, batch_id: int, job_id: int, label: str, window: ChangeWindow, now: str) -> DataFrame:
    """One batch row, still without result and end."""
    return like.sparkSession.range(1).select(
        F.lit(batch_id).cast("long").alias("batch_id"), F.lit(job_id).cast("long").alias("job_id"),
        F.lit("DELTA").alias("batch_type"), F.lit(label).alias("batch_label"),
        F.lit("TIMESTAMP").alias("check_point_type"),
        moment(window.start).alias("check_point_start"), moment(window.end).alias("check_point_end"),
        F.lit(None).cast("int").alias("is_success"),
        moment(now).alias("start_datetime"), F.lit(None).cast("timestamp_ntz").alias("end_datetime"),
    )


def close_batch(batches: DataFrame, batch_id: int, end: str, success: bool) -> DataFrame:
    return update_where(batches, F.col("batch_id") == batch_id, {
        "end_datetime": moment(end), "is_success": F.lit(int(success)),
    })


def set_job_status(jobs: DataFrame, job_id: int, window: ChangeWindow, success: bool) -> DataFrame:
    return update_where(jobs, F.col("job_id") == job_id, {
        "is_success": F.lit(int(success)), "check_point_start": moment(window.start), "check_point_end": moment(window.end),
    })


def step_rows(
    spark: SparkSession, batch_id: int, table: str, counts: list[tuple[str, str, int]], start: str, end: str
) -> DataFrame:
    """One log row per step: (name, kind, rows touched)."""
    rows = [
        (batch_id, kind, f"{name} {table}", f"{kind} succeeded, row count = {count}", None) for name, kind, count in counts
    ]
    return _stamped(spark, rows, start, end)


def failure_row(spark: SparkSession, batch_id: int, table: str, error: str, start: str, end: str) -> DataFrame:
    row = (batch_id, "Merge", f"Merge data into {table} table", "Merge failed", error[: V.ERROR_TEXT_LENGTH])
    return _stamped(spark, [row], start, end)


def _stamped(spark: SparkSession, rows: list[tuple], start: str, end: str) -> DataFrame:
    schema = "batch_id long, log_type string, log_label string, log_message string, error_message string"
    return spark.createDataFrame(rows, schema).select(
        "*", moment(start).alias("start_datetime"), moment(end).alias("end_datetime")
    )


def state_of(events: DataFrame, schema: str, key: str, end: str) -> DataFrame:
    """The last event per key; a row without its end is older than one that has it."""
    columns = [c.split()[0] for c in schema.split(", ")]
    return latest_by(events, [key], F.struct(end)).select(*columns)


class Warehouse:
    """The tables of one warehouse folder and the control tables beside them. `buckets`: the hash partitions of a keyed
    table, the same for as long as the folder lives; a partition should hold a few files.

    Control tables are logs: jobs only ever add event rows, so jobs that overlap never undo
    each other's, and the state is the last event per batch or job.

    `slices`: keyed tables are written and loaded slice by slice of their keys (`store.slices_of`), so that the disk holds the
    shuffles of one slice at a time; a divisor of `buckets`. A job then runs once a slice and gives the rows of `part` alone.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16, slices: int = 1):
        if buckets % slices:
            raise ValueError(f"{buckets} partitions cannot be cut into {slices} slices")
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.buckets = buckets
        self.slices = slices
        self.part = store.WHOLE

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def read(self, table: str) -> DataFrame:
        return store.read_table(self.spark, self.path(table))

    def read_part(self, table: str) -> DataFrame:
        """The rows of a keyed table that belong to the slice being loaded; other partitions are not read."""
        return store.read_table(self.spark, self.path(table), self.part)

    def at(self, part: store.Part) -> Warehouse:
        """The warehouse as the job of one slice sees it."""
        seen = copy.copy(self)
        seen.part = part
        return seen

    def stage(self, table: str) -> str:
        """A new folder for rows on their way into a table; it may go once they are there."""
        return f"{self.folder}/_stage/{table}/{uuid.uuid4().hex}"

    def write(self, table: str, df: DataFrame, keys: tuple[str, ...] = ()) -> None:
        """A table as a whole, partitioned by its key if it has one."""
        if keys:
            store.write_table(df, self.path(table), keys, self.buckets, self.slices)
        else:
            store.replace(df, self.path(table), self.stage(table))

    def load(self, table: str, *results: JobResult) -> None:
        """The next state of a table: what changed is written once, then the partitions that it touches are rewritten.

        `results`: one for each slice; the changes of all are written before a partition is touched.
        """
        keys = results[0].keys
        if not keys:
            self.write(table, results[0].table)
            return
        stages = [f"{self.stage(table)}/{index}" for index in range(len(results))]
        for stage, result in zip(stages, results, strict=True):
            with store.shuffles_freed(self.spark):
                result.changes().write.options(**store.COMPACT).parquet(stage)
        if store.read_if_exists(self.spark, self.path(table)) is None:
            self.write(table, self.spark.read.parquet(*stages).filter(~F.col(DELETED)).drop(DELETED), keys)
            return
        for stage in stages:
            store.apply_changes(self.spark, self.path(table), self.spark.read.parquet(stage), keys, self.buckets, DELETED)

    def staged(self, table: str, rows: DataFrame, batch_id: int | None = None) -> DataFrame:
        """Rows that a job reads again, written once to a staging table and read back; logged if a batch is given."""
        began = clock_time()
        watched, watch = _counted(rows)
        store.truncate_load(watched, self.path(table))
        if batch_id is not None:
            self.record("etl_step_log", step_rows(
                self.spark, batch_id, table, [("write", "Insert", watch.get["rows"])], began, clock_time()))
        return self.spark.read.schema(rows.schema).parquet(self.path(table))

    def record(self, table: str, events: DataFrame) -> None:
        store.append(events, self.path(table))

    def _events(self, table: str, schema: str) -> DataFrame:
        log = store.read_if_exists(self.spark, self.path(table), schema)
        return self.spark.createDataFrame([], schema) if log is None else log

    def batches(self) -> DataFrame:
        return state_of(self._events("etl_job_batches", BATCHES), BATCHES, "batch_id", "end_datetime")

    def jobs(self) -> DataFrame:
        return state_of(self._events("etl_jobs", JOBS), JOBS, "job_id", "check_point_end")

    def step_log(self) -> DataFrame:
        return self._events("etl_step_log", STEP_LOG)


def clock_time() -> str:
    return datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S.%f")


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    watch = Observation()
    return rows.observe(watch, F.count(F.lit(1)).alias("rows")), watch


def run_job(
    warehouse: Warehouse, table: str, batch_id: int, job_id: int, now: str,
    job: Callable[[Warehouse, ChangeWindow], JobResult], appended: tuple[str, ...] = (), staged: tuple[str, ...] = (),
    clock: Callable[[], str] = clock_time,
) -> list[tuple[str, str, int]]:
    """Load the next window of a job: open a batch, write the table, log every step, close.

    Step counts are observed by the write itself, which holds the changed rows alone. Side tables are written and logged before
    the main table: those in `appended` grow, those in `staged` are replaced, others are replaced by way of a stage. A failure is logged, closes the batch without moving the
    watermark, and is raised again. The steps of the main table run in one plan and share its
    start and end. `clock` stamps log rows and the batch's end; rows of data only hold `now`.
    In a warehouse with slices the job is called for each of them; a side table that does not grow may come from one alone.
    """
    spark = warehouse.spark
    window = next_window(warehouse.batches(), job_id, now)
    opened = open_batch(spark.range(1), batch_id, job_id, f"Populate {table}", window, now)
    warehouse.record("etl_job_batches", opened)
    error, began = None, clock()
    try:
        results = [job(warehouse.at(part), window) for part in store.parts(warehouse.slices)]
        sides = {name: [r.appends[name] for r in results if name in r.appends] for r in results for name in r.appends}
        if again := [name for name, frames in sides.items() if len(frames) > 1 and name not in appended]:
            raise ValueError(f"each slice would replace {', '.join(again)}")
        for name, frames in sides.items():
            began, count = clock(), 0
            for rows in frames:
                watched, watch = _counted(rows)
                if name in appended:
                    store.append(watched, warehouse.path(name))
                elif name in staged:
                    store.truncate_load(watched, warehouse.path(name))
                else:
                    warehouse.write(name, watched)
                count += watch.get["rows"]
            kind = "Update" if name not in appended and name not in staged else "Insert"
            warehouse.record("etl_step_log", step_rows(spark, batch_id, name, [("write", kind, count)], began, clock()))
        began = clock()
        observed = [Observation() for _ in results]
        warehouse.load(table, *[
            replace(r, flagged=r.flagged.observe(seen, *r.step_counts())) for r, seen in zip(results, observed, strict=True)])
        counts = [(step.name, step.kind, sum(seen.get[step.name] for seen in observed)) for step in results[0].steps]
        warehouse.record("etl_step_log", step_rows(spark, batch_id, table, counts, began, clock()))
        return counts
    except Exception as raised:
        error = raised
        warehouse.record("etl_step_log", failure_row(spark, batch_id, table, str(raised), began, clock()))
        raise
    finally:
        warehouse.record("etl_job_batches", close_batch(opened, batch_id, clock(), error is None))
        status = set_job_status(warehouse.jobs().filter(F.col("job_id") == job_id), job_id, window, error is None)
        warehouse.record("etl_jobs", status.coalesce(1))
