"""Refresh when new raw repositories arrive.

The stream over the raw repositories directory serves as trigger only: a batch means that there are
new files, and the refresh re-reads the full raw tables. The checkpoint moves on after the refresh
has succeeded, so a failed one is tried again as the same run.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from repovitals import fixed_values as fx
from repovitals.functions.times import now_utc, ntz
from repovitals.plans.refresh import refresh
from repovitals.schemas import TABLES
from repovitals.sources.store import LayerStore
from repovitals.streaming.run_log import Entry, entry, log_entries


def run_refresh(
    store: LayerStore,
    run: tuple[str, int],
    as_of: datetime | str | None = None,
    source: str = fx.SOURCE,
    before: list[Entry] | None = None,
) -> None:
    """One logged refresh; an error is logged whole and raised again. `before`: entries to log first."""
    started = entry(run, source, fx.STAGE_RUN, fx.STATUS_STARTED, fx.MESSAGE_STARTED)
    log_entries(store, [*(before or []), started])
    try:
        refresh(store, ntz(as_of or now_utc()), source)
    except Exception as error:
        message = f"{fx.MESSAGE_ERROR_PREFIX}{error}"
        log_entries(store, [entry(run, source, fx.STAGE_RUN, fx.STATUS_ERROR, message)])
        raise
    log_entries(store, [entry(run, source, fx.STAGE_RUN, fx.STATUS_COMPLETED, fx.MESSAGE_COMPLETED)])


def _skipped(source: str) -> Entry:
    return entry(None, source, fx.STAGE_CHECK, fx.STATUS_SKIPPED, fx.MESSAGE_SKIPPED)


def _arrivals(
    store: LayerStore,
    checkpoint: str,
    as_of: datetime | str | None,
    source: str,
    finished: list[int],
    waiting: list[Entry],
) -> DataStreamWriter:
    key = "raw_repositories"
    new_files = store.spark.readStream.schema(TABLES[key].schema).parquet(store.path(key))

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # The query's id lives in its checkpoint: a batch tried again is the same run, and one of
        # another checkpoint, whose batches count from 0 too, is another.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        before = waiting[:]
        run_refresh(store, (stream, batch_id), as_of, source, before)
        del waiting[: len(before)]
        finished.append(batch_id)

    return new_files.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)


def refresh_if_new(
    store: LayerStore,
    checkpoint: str,
    as_of: datetime | str | None = None,
    source: str = fx.SOURCE,
) -> bool:
    """Refresh once if raw repositories arrived since the last call, else log that it was skipped.

    Returns whether a refresh ran. Meant to be called by whatever schedules jobs on the cluster.
    """
    finished: list[int] = []
    arrivals = _arrivals(store, checkpoint, as_of, source, finished, [])
    arrivals.trigger(availableNow=True).start().awaitTermination()
    ran = bool(finished)
    if not ran:
        log_entries(store, [_skipped(source)])
    return ran


class _SkipLog(StreamingQueryListener):
    """Keeps an entry for every idle interval of one query. They are written with the next run's first
    entry, or when the query ends; the listener then takes itself away.
    """

    def __init__(self, store: LayerStore, name: str, source: str, waiting: list[Entry]):
        self.store, self.name, self.source, self.waiting, self.run = store, name, source, waiting, None

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        if event.runId == self.run:
            self.waiting.append(_skipped(self.source))

    def onQueryTerminated(self, event) -> None:
        if event.runId == self.run:
            self.store.spark.streams.removeListener(self)
            log_entries(self.store, self.waiting)


def refresh_periodically(
    store: LayerStore,
    checkpoint: str,
    interval: str = fx.REFRESH_INTERVAL,
    as_of: datetime | str | None = None,
    source: str = fx.SOURCE,
) -> StreamingQuery:
    """Look for new raw repositories at every interval until the returned query is stopped.

    Spark starts no batch when nothing is new; it then reports the query idle, at most once in
    `spark.sql.streaming.noDataProgressEventInterval`, and that is logged as skipped, together with
    the next run or when the query ends. `store.compact("run_log")` makes one file of a long log.
    """
    name = f"refresh_{uuid.uuid4().hex}"
    waiting: list[Entry] = []
    store.spark.streams.addListener(_SkipLog(store, name, source, waiting))
    arrivals = _arrivals(store, checkpoint, as_of, source, [], waiting).queryName(name)
    return arrivals.trigger(processingTime=interval).start()
