"""Event-time streaming operators: watermarked window aggregates (tumbling,
sliding, session), streaming dedup, stream-static and stream-stream joins,
late-row handling and arbitrary per-key state.

State is always bounded: aggregates and dedup carry a watermark, and
stream-stream joins carry watermarks on both sides plus a time-range
condition, so old state is evicted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_stream(spark: SparkSession, path: str, schema: T.StructType, ts_col: str = "ts",
                 max_files: int | None = 1, fmt: str = "parquet") -> DataFrame:
    """File stream with its event time as TIMESTAMP (watermarks refuse NTZ)."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path).withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def flatten_window(df: DataFrame, col: str = "window") -> DataFrame:
    """``window`` struct -> window_start / window_end (NTZ) columns."""
    return (df.withColumn("window_start", F.col(f"{col}.start").cast("timestamp_ntz"))
            .withColumn("window_end", F.col(f"{col}.end").cast("timestamp_ntz")).drop(col))


def window_agg(stream: DataFrame, ts: str, duration: str, aggs: Sequence[Column], keys: Sequence[str] = (),
               slide: str | None = None, watermark: str = "10 minutes") -> DataFrame:
    """Tumbling (no ``slide``) or sliding window aggregate under a watermark."""
    w = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    out = stream.withWatermark(ts, watermark).groupBy(w.alias("window"), *keys).agg(*aggs)
    return flatten_window(out)


def session_agg(stream: DataFrame, ts: str, gap: str, keys: Sequence[str], aggs: Sequence[Column],
                watermark: str = "10 minutes") -> DataFrame:
    out = stream.withWatermark(ts, watermark).groupBy(F.session_window(ts, gap).alias("window"), *keys).agg(*aggs)
    return flatten_window(out)


def dedup(stream: DataFrame, keys: Sequence[str], ts: str, watermark: str = "10 minutes",
          within_watermark: bool = False) -> DataFrame:
    """Streaming dedup with bounded state. ``within_watermark`` drops repeats of
    ``keys`` arriving within the watermark delay, without putting the event
    time into the key."""
    s = stream.withWatermark(ts, watermark)
    if within_watermark:
        return s.dropDuplicatesWithinWatermark(list(keys))
    return s.dropDuplicates(list(keys) + [ts])


def stream_static_join(stream: DataFrame, static: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError("stream-static joins keep the stream on the left: inner, left, semi, anti")
    return stream.join(static, on, how)


def stream_stream_join(left: DataFrame, right: DataFrame, lkey: str, rkey: str, lts: str, rts: str,
                       within: str, how: str = "inner", lwm: str = "10 minutes", rwm: str = "10 minutes") -> DataFrame:
    """``right.rts BETWEEN left.lts AND left.lts + within`` on equal keys, with
    watermarks on both sides so the join state is evicted."""
    lw = left.withWatermark(lts, lwm)
    rw = right.withWatermark(rts, rwm)
    cond = F.expr(f"{rkey} = {lkey} AND {rts} >= {lts} AND {rts} <= {lts} + INTERVAL {within}")
    return lw.join(rw, cond, how)


# ------------------------------------------------------------------ arbitrary state

IDLE_MS = 31 * 24 * 3600 * 1000  # event-time idle period before a key is evicted

STATE_OUT = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("events", T.LongType()),
                          T.StructField("total_value", T.DoubleType()), T.StructField("last_ts", T.TimestampType())])
STATE_SCHEMA = T.StructType([T.StructField("events", T.LongType()), T.StructField("total_value", T.DoubleType()),
                             T.StructField("last_ts", T.TimestampType())])


def _running_totals(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    n, tot, last = (state.get if state.exists else (0, 0.0, None))
    for pdf in pdfs:
        n += len(pdf)
        tot += float(pdf["value"].sum())
        m = pdf["ts"].max()
        last = m if last is None or m > last else last
    state.update((n, tot, last))
    # evict a key IDLE_MS of event time after its last event
    state.setTimeoutTimestamp(int(pd.Timestamp(last).timestamp() * 1000) + IDLE_MS)
    yield pd.DataFrame({"user_id": [key[0]], "events": [n], "total_value": [tot], "last_ts": [last]})


def running_state(stream: DataFrame, key: str = "user_id", watermark: str = "10 minutes") -> DataFrame:
    """Per-key running count / total / last event (``applyInPandasWithState``)
    with an event-time timeout, so keys idle for IDLE_MS leave the state store;
    one output row per key per batch."""
    return (stream.withWatermark("ts", watermark).select(key, "value", "ts").groupBy(key)
            .applyInPandasWithState(_running_totals, STATE_OUT, STATE_SCHEMA, "update",
                                    GroupStateTimeout.EventTimeTimeout))


# ------------------------------------------------------------------ typed state (transformWithState)

#: typed state lives in the RocksDB store; set for the run of a query (``run_available_now(confs=...)``)
ROCKSDB_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
ACTIVITY_OUT = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("events", T.LongType()),
                             T.StructField("event_types", T.LongType()), T.StructField("recent", T.LongType())])
#: event time that the recent events of a key cover, and after which a silent key leaves the store
RECENT_MS, SILENT_MS = 24 * 3600 * 1000, 60 * 24 * 3600 * 1000


def _activity_processor(recent_ms: int, silent_ms: int, ttl_ms: int | None):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class UserActivity(StatefulProcessor):
        """Typed state per key: a value state (event count, latest event time), a map state (count per event type) and a
        list state (id and time of the events of the last ``recent_ms`` before the latest one).

        One timer a key, at the end of what its recent events cover: it empties the list, and stands again at the
        end of the key's silence, when it removes all three. With ``ttl_ms`` every state variable has a time to live instead."""

        def init(self, handle) -> None:
            self.handle = handle
            self.count = handle.getValueState("count", "n bigint, latest bigint", ttl_ms)
            self.types = handle.getMapState("types", "t string", "c bigint", ttl_ms)
            self.recent = handle.getListState("recent", "id bigint, ms bigint", ttl_ms)

        def _row(self, key, n: int, recent: int) -> pd.DataFrame:
            return pd.DataFrame({"user_id": [key[0]], "events": [n], "event_types": [sum(1 for _ in self.types.keys())], "recent": [recent]})

        def _alarm(self, at: int | None) -> None:
            if ttl_ms is None:
                for t in list(self.handle.listTimers()):
                    self.handle.deleteTimer(t)
                if at is not None:
                    self.handle.registerTimer(at)

        def handleInputRows(self, key, rows, timerValues):
            n, latest = self.count.get() if self.count.exists() else (0, 0)
            recent = list(self.recent.get()) if self.recent.exists() else []
            for pdf in rows:
                n += len(pdf)
                for t, c in pdf["event_type"].value_counts().items():
                    prev = self.types.getValue((t,))[0] if self.types.containsKey((t,)) else 0
                    self.types.updateValue((t,), (prev + int(c),))
                ms = pdf["ts"].astype("datetime64[ms]").astype("int64")
                latest = max(latest, int(ms.max()))
                recent = [r for r in [*recent, *zip(pdf["event_id"].tolist(), ms.tolist())] if r[1] > latest - recent_ms]
            self.count.update((n, latest))
            self.recent.put([(int(i), int(m)) for i, m in recent])
            self._alarm(latest + recent_ms)
            yield self._row(key, n, len(recent))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            n, latest = self.count.get()
            self.recent.clear()
            if expiredTimerInfo.getExpiryTimeInMs() >= latest + silent_ms:
                self.types.clear()
                self.count.clear()
                self._alarm(None)
            else:
                self._alarm(latest + max(silent_ms, recent_ms + 1))
                yield self._row(key, n, 0)

        def close(self) -> None:
            pass

    return UserActivity()


def typed_state(stream: DataFrame, key: str = "user_id", recent_ms: int = RECENT_MS, silent_ms: int = SILENT_MS,
                watermark: str = "10 minutes", ttl_ms: int | None = None) -> DataFrame:
    """Totals of each key and its recent events (``transformWithStateInPandas``): a row for each key and batch, and one when its
    recent events have expired. ``recent`` counts all events within ``recent_ms`` of event time before the key's latest.

    Event-time timers bound the state: the list by ``recent_ms``, the key by ``silent_ms`` of silence after which its totals
    start anew. Spark offers a time to live per variable with processing time only: ``ttl_ms`` chooses that form, in which state not written for so long is gone
    (for queries that keep running; with ``availableNow`` such a query has always one more batch to run).
    """
    rows = stream.withWatermark("ts", watermark).select(key, "event_id", "event_type", "ts")
    return rows.groupBy(key).transformWithStateInPandas(
        _activity_processor(recent_ms, silent_ms, ttl_ms), ACTIVITY_OUT, "Update", "EventTime" if ttl_ms is None else "ProcessingTime")
