"""Bucketed upsert target, drift report, vault digests, erasure report, aligned join, alerts."""

import glob
import hashlib
import hmac
import os
import re

import pytest
from pyspark.sql import functions as F

from driftwood.functions import masks
from driftwood.operators import cdc, govern, joins, layout, monitor
from driftwood.session import workdir
from driftwood.streaming import ops

EVENT = "id long, op string, seq long, tb long, v string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, EVENT)


def _files(root, kind):
    return sorted({tuple(p.split("/")[-3:-1]) for p in glob.glob(f"{root}/{kind}/*=*/*=*/*.parquet")})


def test_a_batch_writes_the_buckets_it_touches_and_merges_expire(spark, tmp_path):
    root, batches = str(tmp_path / "t"), []
    up = ops.upsert_batch(root, ["id"], "seq", ["tb"], buckets=8, merge_every=3)
    batches.append([(k, "c", 0, 0, f"a{k}") for k in range(64)])
    batches += [[(5, "u" if n % 4 else "d", n, 0, f"b{n}"), (5, "u", n, 1, f"c{n}")] for n in range(1, 8)]
    batches.append([(9, "d", 3, 0, None), (9, "u", 2, 0, "late"), (None, "c", 1, 0, "null key")])
    everything = []
    for n, rows in enumerate(batches):
        up(_batch(spark, rows), n)
        if 1 <= n <= 7:
            assert len([f for f in _files(root, "delta") if f[0] == f"{ops.V}={n}"]) <= 1  # one bucket, or merged and expired
        everything += rows
        want = cdc.latest_events(_batch(spark, everything), ["id"], "seq", ["tb"])
        got = ops.read_latest_snapshot(spark, root)
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    hot = {b for v, b in _files(root, "base")}
    assert len(hot) == 1  # only the bucket with many deltas was ever merged
    bases = [v for v, b in _files(root, "base")]
    assert 1 <= len(bases) <= 2  # the last one, and the one before it for readers that began with it
    old = [v for v, b in _files(root, "delta") if b in hot]
    assert f"{ops.V}=0" not in old and f"{ops.V}=1" not in old


def test_replayed_merge_gives_the_same_target(spark, tmp_path):
    up = ops.upsert_batch(str(tmp_path / "t"), ["id"], "seq", ["tb"], buckets=2, merge_every=2)
    for n in range(4):
        rows = _batch(spark, [(k, "u", n, 0, f"{n}-{k}") for k in range(n, 20, n + 1)])
        up(rows, n)
        once = sorted(map(tuple, ops.read_latest_snapshot(spark, str(tmp_path / "t")).collect()))
        up(rows, n)
        assert sorted(map(tuple, ops.read_latest_snapshot(spark, str(tmp_path / "t")).collect())) == once
    up(_batch(spark, []), 4)
    assert sorted(map(tuple, ops.read_latest_snapshot(spark, str(tmp_path / "t")).collect())) == once


def test_drift_reports_what_disappears_and_returns(spark):
    rows = [("2024-01", '{"a": 1, "b": "x"}'), ("2024-02", '{"a": 1.5}'), ("2024-02", '{"a": 2.5, "c": 3}'), ("2024-03", '{"a": 1.5, "b": "y", "c": 3}'), ("2024-03", "{broken"), (None, '{"z": 1}')]
    got = monitor.schema_drift(spark.createDataFrame(rows, "month string, j string"), "j", "month").collect()
    assert sorted(map(tuple, got)) == [
        ("2024-01", "a", "new"), ("2024-01", "b", "new"), ("2024-02", "a", "retyped"), ("2024-02", "b", "missing"), ("2024-02", "c", "new"),
        ("2024-03", "a", "same"), ("2024-03", "b", "new"), ("2024-03", "c", "same")]


@pytest.mark.parametrize("secret", [b"k", b"x" * 64, b"long" * 40])
def test_keyed_digest_is_hmac(spark, secret):
    rows = [(1, "é"), (23, ""), (None, None)]
    df = spark.createDataFrame(rows, "a long, b string").select("a", "b", masks.keyed_digest("a", secret).alias("x"), masks.keyed_digest("b", secret).alias("y"))
    h = lambda v: None if v is None else hmac.new(secret, str(v).encode(), hashlib.sha256).hexdigest()
    assert all((r["x"], r["y"]) == (h(r["a"]), h(r["b"])) for r in df.collect())


def test_erasure_report_counts_what_is_touched(spark):
    vault, silver = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, name string"), spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    v, s = govern.erase_subject(vault, silver, 1, "k", "k", ["name"])
    assert sorted(map(repr, map(tuple, v.collect()))) == sorted(map(repr, [(1, None), (2, "b"), (None, "c")]))
    assert sorted(map(repr, (r[0] for r in s.collect()))) == ["2", "None"]
    report = govern.erasure_report({"vault": (vault, "k", "nulled"), "silver": (silver, "k", "dropped")}, 1)
    assert sorted(map(tuple, report.collect())) == [("silver", "dropped", 4, 2), ("vault", "nulled", 3, 1)]


def test_aligned_join_has_no_exchange(spark, tmp_path):
    a = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3).alias("m"), F.lit("a").alias("x"))
    b = spark.range(0, 900).select((F.col("id") % 300).alias("bk"), (F.col("id") % 3).alias("bm"), "id")
    root = workdir(spark, "aligned")
    left = joins.write_bucketed(a, "k", 4, root, "a", partition_by="m")
    right = joins.write_bucketed(b, "bk", 4, root, "b", partition_by="bm")
    j = joins.aligned_join(spark, left, right, [("m", "bm"), ("k", "bk")])
    assert "Exchange" not in j._jdf.queryExecution().executedPlan().toString()
    assert j.count() == 900
    one = j.filter("m = 1")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and len(re.findall(r"PartitionFilters: \[[^\]]*= 1", plan)) == 2
    assert one.count() == 300
    assert len([f for f in spark.table(left).inputFiles() if "/m=1/" in f]) <= 4
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_health_board_breaks_ties(spark):
    rows = [("a", 1, "HEALTHY", 5.0), ("a", 2, "WARNING", 1.0), ("a", 2, "CRITICAL", 1.0), ("b", 2, "HEALTHY", 1.0), ("b", 2, "WARNING", 2.0)]
    df = spark.createDataFrame(rows, "component string, check_ts long, status string, metric double")
    got = [tuple(r) for r in monitor.health_board([df.limit(2), df.subtract(df.limit(2))]).collect()]
    assert got == [("a", 2, "CRITICAL", 1.0), ("b", 2, "WARNING", 2.0)]


def test_empty_streaks(spark):
    rows = [(k, n, 10) for k, n in enumerate([1, 0, 0, 0, 0, 2, 0, 0, 3, 0, 0, 0])]
    got = monitor.batch_alerts(spark.createDataFrame(rows, "batch_id long, num_rows long, duration_ms long"), 20, 3).orderBy("batch_id")
    assert [r["empty_streak"] for r in got.collect()] == [False, False, False, True, True, False, False, False, False, False, False, True]


def test_slice_compaction_leaves_the_rest(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(6000).select("id", (F.col("id") % 3).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(12).write.partitionBy("p").parquet(path)
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/p=*/*.parquet")}
    rows = sorted(map(tuple, spark.read.parquet(path).collect()))
    r = layout.compact_slice(spark, path, ["p"], "p = 1", target_bytes=1 << 20).first()
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/p=*/*.parquet")}
    assert {f: t for f, t in after.items() if "/p=1/" not in f} == {f: t for f, t in before.items() if "/p=1/" not in f}
    assert (r["files_before"], r["files_after"]) == (12, 1) and sum("/p=1/" in f for f in after) == 1
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows
    r = layout.compact_slice(spark, path, ["p"], "p IN (0, 2)", target_bytes=16 << 10).first()
    assert 4 <= r["files_after"] < r["files_before"] == 24  # one partition value is several files where it is large
    assert layout.compact_slice(spark, path, ["p"], "p = 77").first()["files_after"] == 0
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == rows


def test_statistics_as_rows(spark):
    name = "stats_rows_test"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.range(100).select(F.col("id"), F.when(F.col("id") % 4 > 0, F.col("id") % 7).alias("g"), F.lit("abc").alias("s")).write.saveAsTable(name)
    try:
        assert [r["min"] for r in layout.stats_rows(spark, name).collect()] == [None] * 3
        layout.analyze_table(spark, name, ["id", "g", "s"])
        got = {r["column_name"]: r for r in layout.stats_rows(spark, name).collect()}
        assert (got["id"]["min"], got["id"]["max"], got["id"]["num_nulls"]) == ("0", "99", 0)
        assert (got["g"]["num_nulls"], got["g"]["distinct_count"], got["s"]["max_col_len"]) == (25, 7, 3)
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_merges_write_a_few_times_the_target(spark, tmp_path, monkeypatch):
    root, merged = str(tmp_path / "t"), []
    up = ops.upsert_batch(root, ["id"], "seq", ["tb"], buckets=1, merge_every=2, small_base=10)
    everything = []
    for n in range(12):
        rows = [(100 * n + k, "c", n, 0, f"{n}") for k in range(100)]
        everything += rows
        up(_batch(spark, rows), n)
        at = f"{root}/base/{ops.V}={n}"
        merged += [spark.read.parquet(at).count()] if os.path.exists(at) else []
    assert merged == [200, 400, 600, 900]
    assert sorted(map(tuple, ops.read_latest_snapshot(spark, root).collect())) == sorted(everything)
