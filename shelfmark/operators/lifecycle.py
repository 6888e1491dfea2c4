"""Catalog versions as rows of a history table: reindex, snapshot, retention, restore."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.products import search_columns
from shelfmark.sources.versions import snapshot_name


def reindex(history: DataFrame, version: int) -> DataFrame:
    """All documents of a version as the next one, derived columns rebuilt."""
    current = history.filter(F.col("version") == version)
    return search_columns(current).withColumn("version", F.lit(version + 1))


def snapshot(catalog: DataFrame, at: dt.datetime, table_name: str = "products") -> DataFrame:
    """The catalog as rows of a new, time-stamped version."""
    return catalog.withColumns(
        {
            "version": F.lit(snapshot_name(at)),
            "created_at": F.lit(at).cast("timestamp_ntz"),
            "table_name": F.lit(table_name),
        }
    )


def retain_versions(history: DataFrame, keep: int = 7) -> DataFrame:
    """Rows of the newest `keep` versions."""
    newest = history.select("version").distinct().orderBy(F.desc("version")).limit(keep)
    return history.join(F.broadcast(newest), "version", "left_semi")


def retain_days(history: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Rows of versions created within `days` before `as_of`."""
    return history.filter(F.col("created_at") >= as_of - F.expr(f"interval {days} days"))


def restore(history: DataFrame, version: int, table_name: str | None = None) -> DataFrame:
    """The rows of one version: one table, or every table whose name does not start with a dot."""
    rows = history.filter(F.col("version") == version)
    if table_name is None:
        rows = rows.filter(~F.col("table_name").startswith("."))
    else:
        rows = rows.filter(F.col("table_name") == table_name)
    if rows.isEmpty():
        raise ValueError(f"version {version} has no such data table")
    return rows
