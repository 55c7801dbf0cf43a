"""Run a streaming query to completion (``availableNow``) and read its result.

Streams write to fault-tolerant sinks (file sink + checkpoint, or
``foreachBatch`` writing ``batch_id=`` partitions); the finished table is then
read back as a batch DataFrame. Checkpoints live under the shared
``spark.checkpoint.dir`` so a restarted driver resumes where it stopped.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

PROGRESS = ("batch_id long, num_rows long, input_rate double, process_rate double, duration_ms long, "
            "rows_dropped long")
#: seconds between two looks at a query's progress, and progress rows written at once
POLL_S, PROGRESS_ROWS = 0.25, 1000


class _ProgressLog:
    """Every progress event of a query as a row of the table at ``path``. Spark keeps only the last
    ``numRecentProgressUpdates``, so the events are taken while the query runs; an event that left the list unseen is an error."""

    def __init__(self, q: StreamingQuery, spark: SparkSession, path: str) -> None:
        self.q, self.spark, self.path = q, spark, path
        self.kept = int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates"))
        self.last, self.rows, self.written = None, [], False

    def take(self) -> None:
        recent = self.q._jsq.recentProgress()
        new, known = [], False
        for k in reversed(range(len(recent))):  # newest first, up to the last one seen
            key = (recent[k].batchId(), recent[k].timestamp())
            if key == self.last:
                known = True
                break
            new.append((key, json.loads(recent[k].json())))
        if not known and (self.last is not None or len(recent) >= self.kept):
            self.q.stop()
            raise RuntimeError(f"progress events left Spark's list of {self.kept} before they were read; raise spark.sql.streaming.numRecentProgressUpdates")
        if new:
            self.last = new[0][0]
        self.rows += [(p["batchId"], p["numInputRows"], float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0),
                       int(p["durationMs"].get("triggerExecution", 0)), sum(op.get("numRowsDroppedByWatermark", 0) for op in p.get("stateOperators", [])))
                      for _, p in reversed(new)]
        if len(self.rows) >= PROGRESS_ROWS:
            self.write()

    def write(self) -> None:
        if self.rows or not self.written:
            self.spark.createDataFrame(self.rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)
            self.rows, self.written = [], True


def await_end(q: StreamingQuery, spark: SparkSession, timeout_s: float | None = None, progress: str | None = None) -> None:
    """Wait until ``q`` ends (at most ``timeout_s``); every progress event goes to the table at ``progress``."""
    if progress is None:
        ended = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
    else:
        log, began = _ProgressLog(q, spark, progress), time.monotonic()
        try:
            ended = False
            while not ended and (timeout_s is None or time.monotonic() - began < timeout_s):
                ended = q.awaitTermination(POLL_S)
                log.take()
        finally:
            log.write()
    if timeout_s is not None and not ended:
        q.stop()
        raise TimeoutError(f"stream did not finish in {timeout_s}s")


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The progress events written by ``await_end``."""
    return spark.read.schema(PROGRESS).parquet(path)


def run_available_now(stream: DataFrame, sink: str | None, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append", partition_by: Sequence[str] | None = None,
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      query_name: str | None = None, timeout_s: float | None = None, state_partitions: int | None = 0,
                      progress: str | None = None, confs: dict[str, str] | None = None, **options) -> StreamingQuery:
    """Start ``stream`` with ``trigger(availableNow=True)`` and wait until it ends,
    however long that takes; only a caller that passes ``timeout_s`` stops it earlier.

    ``state_partitions`` fixes the number of shuffle/state partitions of a new
    checkpoint (Spark stores it with the checkpoint on the first batch):
    ``0`` (default) means the cluster's default parallelism, ``None`` keeps
    the session value. The session value is restored when the query ends.

    ``confs`` are session settings for this run only.

    ``progress`` names a folder for a table of all progress events (see ``read_progress``).
    """
    spark = stream.sparkSession
    confs = dict(confs or {})
    if state_partitions is not None:
        confs["spark.sql.shuffle.partitions"] = str(state_partitions or spark.sparkContext.defaultParallelism)
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        return _run(stream, sink, checkpoint, fmt, output_mode, partition_by, foreach_batch, query_name,
                    timeout_s, progress, **options)
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(stream, sink, checkpoint, fmt, output_mode, partition_by, foreach_batch, query_name, timeout_s, progress, **options):
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format(fmt).options(**options)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if sink is not None and fmt not in ("memory", "console", "noop"):
            w = w.option("path", sink)
    q = w.trigger(availableNow=True).start()
    await_end(q, stream.sparkSession, timeout_s, progress)
    if q.exception() is not None:
        raise q.exception()
    return q


def read_sink(spark: SparkSession, sink: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(sink)
