"""Structured Streaming operators and the triggered run."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ledgerlens import values as V
from ledgerlens.operators.lookups import fits_broadcast

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark) -> None:
    """Keep streaming state off the heap: for key sets that do not fit in executor memory."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def dedupe_stream(
    df: DataFrame, keys: Sequence[str] = ("txn_id",), ts: str = "event_ts", delay: str = V.WATERMARK_DELAY
) -> DataFrame:
    """First row per keys and event time; the state of a key goes once the watermark passes it.

    Rows older than the watermark are dropped.  The time is part of the key: the same id at
    another time is not a duplicate.  Also accepts a batch frame (no row is late there).
    """
    if not df.isStreaming:
        return df.dropDuplicates([*keys, ts])
    return df.withWatermark(ts, delay).dropDuplicates([*keys, ts])


def late_rows(df: DataFrame, batch: str, ts: str = "event_ts", delay: str = V.WATERMARK_DELAY) -> DataFrame:
    """Batch twin of the late filter: rows a stream with these micro-batches would drop.

    A batch is filtered with the watermark known when the batch *before* it was planned, so the
    maximum that counts is the one up to two batches earlier.  Watermarks have millisecond
    precision, and a row exactly at the watermark is late.
    """
    so_far = Window.orderBy(batch).rowsBetween(Window.unboundedPreceding, -2)
    peaks = df.groupBy(batch).agg(F.date_trunc("MILLISECOND", F.max(ts)).alias("_peak"))
    marks = peaks.select(batch, (F.max("_peak").over(so_far) - F.expr(f"INTERVAL {delay}")).alias("_mark"))
    if fits_broadcast(marks)[0]:
        marks = F.broadcast(marks)
    return df.join(marks, batch).filter(F.col(ts) <= F.col("_mark")).drop("_mark")


def drain(writer, timeout: float | None = None, path: str | None = None):
    """Start a stream writer, process everything that has arrived, and stop; returns the finished query."""
    query = writer.trigger(availableNow=True).start(*([path] if path else []))
    done = query.awaitTermination(timeout)
    if timeout is not None and not done:
        query.stop()
        raise TimeoutError(f"not all input was processed within {timeout} s; the next run goes on from its checkpoint")
    if query.exception() is not None:
        raise query.exception()
    return query


def run_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (), timeout: float | None = None
):
    """Process everything that has arrived since the last run, append it to ``path`` and stop.

    Progress is in ``checkpoint``: running again picks up only new input.
    """
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return drain(writer.option("checkpointLocation", checkpoint), timeout, path)


def run_counted(
    spark: SparkSession, df: DataFrame, path: str, checkpoint: str, name: str, partition_by: Sequence[str] = (), timeout: float | None = None
) -> tuple[object, dict[str, int]]:
    """``run_stream`` of a frame observed as ``name``; the finished query and the sums of its counts over all its batches.

    A query keeps its last progress reports only, so every report is taken as it comes.  A batch that is reported again
    counts once.  If a report was lost the counts would be short: that raises instead.
    """
    seen = _Reports(name)
    spark.streams.addListener(seen)
    try:
        query = run_stream(df, path, checkpoint, partition_by, timeout)
        return query, seen.totals(str(query.runId), query.lastProgress)
    finally:
        spark.streams.removeListener(seen)


class _Reports(StreamingQueryListener):
    """A named observation's counts by run and batch."""

    def __init__(self, name: str):
        self.name = name
        self.batches: dict[str, dict[int, dict[str, int]]] = {}
        self.ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        row = progress.observedMetrics.get(self.name)
        self.batches.setdefault(str(progress.runId), {})[progress.batchId] = row.asDict() if row is not None else {}

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def totals(self, run: str, last, patience: float = 120) -> dict[str, int]:
        # Reports come in order, the end after all of them.
        if not self._end(run).wait(patience):
            raise TimeoutError(f"the end of {run} was not reported within {patience} s")
        batches = self.batches.get(run, {})
        # A last report without input stands for no batch.
        if last is not None and (batches or last.numInputRows):
            end = last.batchId + (1 if last.numInputRows else 0)
            if missing := set(range(min(batches, default=last.batchId), end)) - set(batches):
                raise RuntimeError(f"counts of {self.name} are incomplete: {len(missing)} batches were not reported")
        totals: dict[str, int] = {}
        for counts in batches.values():
            for metric, n in counts.items():
                totals[metric] = totals.get(metric, 0) + n
        return totals
