"""Resumable work: what is done, what is left, and the newest state of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def done_keys(manifest: DataFrame, key: str, status: str | None = None, also: Column | None = None) -> DataFrame:
    """Keys that a manifest shows as done: present, with the status, and with their output where `also` says how to tell."""
    rows = manifest.filter(F.col(key).isNotNull())
    rows = rows if status is None else rows.filter(F.col("status") == status)
    return (rows if also is None else rows.filter(also)).select(key).distinct()


def pending(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return rows.join(done, key, "left_anti")


def latest_status(manifest: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key, so that retries and repeats count once."""
    return manifest.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.struct(*manifest.columns), F.struct(*order)).alias("_row")).select("_row.*")
