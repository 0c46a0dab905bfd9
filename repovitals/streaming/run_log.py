"""Append-only log of refresh runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repovitals import fixed_values as fx
from repovitals.functions.times import now_utc
from repovitals.schemas import TABLES, conform
from repovitals.sources.store import LayerStore


Entry = tuple[str | None, int | None, str, str, str, datetime]


def entry(run: tuple[str, int] | None, source: str, stage: str, status: str, message: str) -> Entry:
    """An entry of now. A run is named by its stream (the query id of its checkpoint) and batch."""
    stream, batch = run or (None, None)
    return (stream, batch, source, stage, status, message, now_utc())


def log_entries(store: LayerStore, entries: list[Entry]) -> None:
    """Add entries, in one file. A run's entries are never changed, so a repeated one does no harm."""
    if not entries:
        return
    rows = store.spark.createDataFrame(
        entries,
        "stream string, run_id long, source string, stage string, status string, message string, ts timestamp_ntz",
    ).withColumn("pipeline_name", F.lit(fx.PIPELINE))
    store.append("run_log", conform(rows.coalesce(1), TABLES["run_log"], F.col("ts")))


def _ended() -> Column:
    return F.col("status").isin(fx.STATUS_COMPLETED, fx.STATUS_ERROR)


def run_log_latest(log: DataFrame) -> DataFrame:
    """Current state of every run that was started: its last entry, start and end.

    The end of a run is the time of its last entry if that is a final one; a run that failed and
    was started again is open. Of entries at the same time the final one counts as later.
    """
    latest = F.struct(F.col("ts"), _ended())
    started = F.when(F.col("status") == fx.STATUS_STARTED, F.col("ts"))
    return (
        log.filter(F.col("stage") == fx.STAGE_RUN)
        .groupBy("stream", "run_id", "source", "pipeline_name")
        .agg(
            F.max_by("status", latest).alias("status"),
            F.max_by("message", latest).alias("message"),
            F.min(started).alias("start_time"),
            F.max_by(F.when(_ended(), F.col("ts")), latest).alias("end_time"),
        )
    )
