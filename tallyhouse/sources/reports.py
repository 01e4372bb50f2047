"""Report files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv_report(report: DataFrame, path: str) -> None:
    """One csv file with a header; a report has one row per compared pair."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_text_report(lines: DataFrame, path: str) -> None:
    """A one-column frame as text lines; large difference reports stay in many files."""
    lines.write.mode("overwrite").text(path)
