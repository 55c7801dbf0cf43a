"""Timers and time to live of the typed state operator."""

import datetime as dt

import pytest

from driftwood.session import workdir
from driftwood.streaming import streams as S
from driftwood.streaming.runner import run_available_now

SCHEMA = "event_id long, user_id long, ts timestamp, event_type string"


def _run(spark, batches, **how):
    """The rows that ``typed_state`` emits in each batch, one input file a batch, and the state rows left."""
    root, out = workdir(spark, "typed"), {}
    for rows in batches:
        df = spark.createDataFrame([(i, u, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), t) for i, u, h, t in rows], SCHEMA).coalesce(1)
        df.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")

        def keep(b, k):
            out.setdefault(k, []).extend(tuple(r) for r in b.collect())

        q = run_available_now(S.typed_state(stream, **how), None, f"{root}/ckpt", output_mode="update", foreach_batch=keep, confs=S.ROCKSDB_CONF, state_partitions=2)
        left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    return [sorted(out[k]) for k in sorted(out) if out[k]], left


def test_timers_empty_the_list_and_remove_silent_keys(spark):
    hour = 3600 * 1000
    rows, left = _run(spark, [
        [(1, 7, 0, "a"), (2, 7, 1, "b"), (3, 7, 30, "a"), (4, 8, 29, "a")],  # user 7: one event within a day of the latest
        [(5, 9, 60, "a")],  # the watermark passes 7's and 8's day, not their week
        [(6, 9, 300, "c")],  # and their week
        [(7, 7, 301, "a")],  # 7 starts anew
    ], recent_ms=24 * hour, silent_ms=168 * hour)
    flat = [r for batch in rows for r in batch]
    assert (7, 3, 2, 1) in rows[0] and (8, 1, 1, 1) in rows[0]
    assert (7, 3, 2, 0) in flat and (8, 1, 1, 0) in flat  # the list is empty, the totals stay
    assert [r for r in flat if r[0] == 7][-1] == (7, 1, 1, 1)
    assert not [r for r in flat if r[0] == 8 and r[1] != 1]
    kept_all, more = _run(spark, [[(1, 7, 0, "a"), (2, 7, 1, "b"), (3, 7, 30, "a"), (4, 8, 29, "a")], [(5, 9, 60, "a")], [(6, 9, 300, "c")], [(7, 7, 301, "a")]],
                          recent_ms=10_000 * hour, silent_ms=10_000 * hour)
    assert left < more  # the state shrinks
    assert kept_all[-1] == [(7, 4, 2, 4)]


def test_events_out_of_order_count_by_time(spark):
    hour = 3600 * 1000
    rows, _ = _run(spark, [[(k, 1, h, "a") for k, h in enumerate([50, 10, 49, 27, 26, 25])]], recent_ms=24 * hour)
    assert rows[0] == [(1, 6, 1, 3)]  # 50, 49 and 27; 26 is a day before


@pytest.mark.parametrize("ttl_ms, want", [(1, [(1, 1, 1, 1)]), (3_600_000, [(1, 2, 2, 2)])])
def test_time_to_live(spark, ttl_ms, want):
    """State that is older than its time to live is gone when the next row comes. One batch a run: with processing time a query has
    always one more batch to run, so that ``availableNow`` does not end."""
    root, out = workdir(spark, "ttl"), []
    before = {k: spark.conf.get(k, None) for k in S.ROCKSDB_CONF}
    for k, v in S.ROCKSDB_CONF.items():
        spark.conf.set(k, v)
    try:
        for i, t in ((1, "a"), (2, "b")):
            spark.createDataFrame([(i, 1, dt.datetime(2024, 1, 1, i), t)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
            q = (S.typed_state(stream, ttl_ms=ttl_ms).writeStream.outputMode("update").option("checkpointLocation", f"{root}/ckpt")
                 .foreachBatch(lambda b, k: out.extend(tuple(r) for r in b.collect())).trigger(once=True).start())
            assert q.awaitTermination(90)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert out[-1:] == want


def test_settings_of_a_run_do_not_stay(spark):
    before = {k: spark.conf.get(k, None) for k in (*S.ROCKSDB_CONF, "spark.sql.shuffle.partitions")}
    with pytest.raises(Exception):
        run_available_now(spark.readStream.schema("a long").parquet(workdir(spark, "none")), None, workdir(spark, "ck"), confs={"spark.sql.shuffle.partitions": "3"})
    assert {k: spark.conf.get(k, None) for k in before} == before
