"""Inputs on which the first versions of these operators went wrong."""

import os

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators import cdc, joins, relational, windows
from driftwood.session import workdir
from driftwood.sources import ingest


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_windows_keep_null_keys(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 20.0), (None, 1, 30.0), (None, None, 40.0), ("b", None, 50.0)], "k string, o int, v double")
    w = W.partitionBy("k").orderBy("o")
    assert _rows(windows.keyed_row_number(df, ["k"], ["o"], partitions=4)) == _rows(df.withColumn("rn", F.row_number().over(w).cast("long")))
    assert _rows(windows.keyed_shift(df, ["k"], ["o"], {"v": "prev"}, partitions=4)) == _rows(df.withColumn("prev", F.lag("v").over(w)))
    assert _rows(windows.keyed_rank(df, ["k"], ["o"], partitions=4)) == _rows(df.withColumn("rank", F.rank().over(w).cast("long")))
    assert _rows(windows.keyed_rank(df, ["k"], ["o"], dense=True, partitions=4)) == _rows(df.withColumn("rank", F.dense_rank().over(w).cast("long")))
    assert _rows(windows.running_sum(df, "k", "o", "v", "v", partitions=4)) == _rows(df.withColumn("running", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0))))
    assert windows.keyed_row_number(df.limit(0), ["k"], ["o"]).count() == 0


def test_range_sum_keeps_null_keys_and_times(spark):
    rows = [("a", 1, "2024-01-01 00:00:00", 1.0), ("a", 2, "2024-01-03 00:00:00", 2.0), ("a", 3, None, 4.0), ("a", 4, None, 8.0),
            (None, 5, "2024-01-01 00:00:00", 16.0), (None, 6, "2024-01-01 12:00:00", 32.0), (None, 7, None, 64.0), ("b", 8, "2024-02-01 00:00:00", 128.0)]
    df = spark.createDataFrame(rows, "k string, id int, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
    got = windows.keyed_range_sum(df, "k", "t", "id", "v", 86400, "s", partitions=4)
    want = spark.sql("SELECT *, sum(v) OVER (PARTITION BY k ORDER BY t RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS s FROM {x}", x=df)
    assert _rows(got.select("id", "s")) == _rows(want.select("id", "s"))


def test_strings_and_ties_spread_over_partitions(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.format_string("%05d", "id").alias("o"), F.lit(7).alias("tied"))
    for order in ("o", "tied"):
        assert windows._ranged(df, ["k"], [order], True, 8).select("__part").distinct().count() > 4
    got = windows.keyed_row_number(df, ["k"], ["o"], partitions=8)
    assert got.filter(F.col("rn") != F.col("o").cast("int") + 1).count() == 0
    assert windows.keyed_row_number(df, ["k"], ["tied"], partitions=8).select("rn").distinct().count() == 1000
    assert {r["rank"] for r in windows.keyed_rank(df, ["k"], ["tied"], partitions=8).collect()} == {1}


def test_joins_beyond_their_bounds(spark):
    a, b = spark.range(40).select(F.col("id").alias("a")), spark.range(30).select(F.col("id").alias("b"), (F.col("id") * 1.0).alias("lo"), (F.col("id") * F.col("id") + 1.0).alias("hi"))
    assert joins.cross_join_bounded(a, b, max_small_rows=5).count() == 1200
    want = _rows(a.crossJoin(b).filter("a >= lo AND a < hi").select("a", "b"))
    for bound in (5, 1000):
        assert _rows(joins.band_join(a, "a", b, "lo", "hi", max_small_rows=bound).select("a", "b")) == want
    names = spark.createDataFrame([(1, "x"), (2, None), (None, "y")], "k long, v string")
    for bound in (1, 100):
        got = joins.with_lookup(a.filter("a < 4"), "a", names.filter("k IS NOT NULL"), "k", "v", "v", max_rows=bound)
        assert sorted(map(tuple, got.collect())) == [(0, None), (1, "x"), (2, None), (3, None)]
    many = a.crossJoin(a.withColumnRenamed("a", "n")).withColumn("a", F.when(F.col("a") < 20, 0).otherwise(F.col("a")).cast("long"))
    small = a.withColumnRenamed("a", "k")
    for bound in (0, 100):
        assert joins.hot_key_join(many, "a", small, "k", min_share=0.3, max_hot_rows=bound).count() == 1600


def test_intervals_of_any_length_are_copied_a_few_times(spark):
    t = lambda c: F.timestamp_seconds(c)
    points = spark.range(0, 4_000_000, 90_001).select(F.col("id").alias("p"), t("id").alias("ts"))
    spans = spark.createDataFrame([(0, 0, 10), (1, 0, 4_000_000), (2, 89_000, 91_000), (3, 500_000, 400_000), (4, 180_002, 180_002)], "i int, a long, b long")
    spans = spans.select("i", t("a").alias("s"), t("b").alias("e"))
    got = joins.range_join_binned(points, "ts", spans, "s", "e", bin_seconds=60)
    assert _rows(got.select("p", "i")) == _rows(points.join(spans, F.col("ts").between(F.col("s"), F.col("e"))).select("p", "i"))
    _, copied = joins._levelled(points, F.unix_seconds("ts"), spans, F.unix_seconds("s"), F.unix_seconds("e"), 60)
    assert copied.count() <= 2 * spans.count()


def test_range_join_keeps_its_partitions(spark):
    t = lambda c: F.timestamp_seconds(c)
    points = spark.range(0, 400_000, 101).select(F.col("id").alias("p"), t("id").alias("ts"))
    points = points.unionByName(points.limit(50)).unionByName(spark.createDataFrame([(-1, None)], "p long, ts timestamp"))
    spans = spark.range(0, 400_000, 997).select(F.col("id").alias("i"), t("id").alias("s"), t(F.col("id") + 3600).alias("e"))
    want = _rows(points.join(spans, F.col("ts").between(F.col("s"), F.col("e"))).select("p", "i"))
    for bound in (100, 1000):
        got = joins.range_join_binned(points, "ts", spans, "s", "e", bin_seconds=3600, max_small_rows=bound)
        assert _rows(got.select("p", "i")) == want
    many = joins.range_join_binned(points, "ts", spans, "s", "e", bin_seconds=3600, max_small_rows=100)
    assert many.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_running_max_over_files(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("o"), (F.col("id") * 91 % 499).alias("v"))
    want = df.withColumn("m", F.max("v").over(W.orderBy("o").rowsBetween(W.unboundedPreceding, -1)))
    assert _rows(windows.running_max(df, ["o"], "v", "m", partitions=6)) == _rows(want)


def test_delete_drops_an_emptied_partition(spark):
    root = workdir(spark, "emptied")
    spark.createDataFrame([(1, 10, "F"), (2, 20, "F"), (3, 90, "O"), (4, 30, None)], "id int, p int, s string").write.partitionBy("s").parquet(root)
    out = cdc.rewrite_touched_partitions(spark, root, ["s"], "p < 50", lambda d: cdc.delete_where(d, "p < 50"))
    assert [r["id"] for r in out.collect()] == [3]


def test_load_after_a_crash_and_two_forced_loads(spark, tmp_path):
    src, target = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(10).write.parquet(src)
    crash = RuntimeError("crash")

    def fails(df):
        raise crash

    try:
        ingest.copy_into(spark, src, "parquet", target, transform=fails)
    except RuntimeError as e:
        assert e is crash
    spark.range(10, 15).write.mode("append").parquet(src)
    assert ingest.copy_into(spark, src, "parquet", target).first()["num_inserted_rows"] == 15
    assert spark.read.parquet(target).count() == 15
    assert ingest.copy_into(spark, src, "parquet", target).first()["num_inserted_rows"] == 0
    for n in (30, 45):
        ingest.copy_into(spark, src, "parquet", target, force=True)
        assert spark.read.parquet(target).count() == n
    assert os.path.isdir(f"{target}/_ledger")


def test_hot_key_join_with_hot_null_keys(spark):
    big = spark.range(1000).select(F.when(F.col("id") < 300, F.lit(None)).when(F.col("id") < 600, F.lit(0)).otherwise(F.col("id")).alias("a"), F.col("id").alias("n"))
    small = spark.range(1000).select(F.col("id").alias("k")).union(spark.createDataFrame([(None,)], "k long"))
    want = _rows(big.join(small, big["a"] == small["k"]).select("n", "k"))
    for bound in (0, 100):
        assert joins.hot_keys(big, "a", 0.2) == [0]
        assert _rows(joins.hot_key_join(big, "a", small, "k", min_share=0.2, max_hot_rows=bound).select("n", "k")) == want
    nulls = big.withColumn("a", F.lit(None).cast("long"))
    assert joins.hot_key_join(nulls, "a", small, "k").count() == 0


def test_progress_of_more_batches_than_spark_keeps(spark, tmp_path):
    from driftwood.operators import monitor
    from driftwood.streaming.runner import run_available_now

    (tmp_path / "in").mkdir()
    for k in range(110):
        (tmp_path / "in" / f"{k}.txt").write_text(f"{k}\n")
    s = spark.readStream.option("maxFilesPerTrigger", 1).text(str(tmp_path / "in"))
    run_available_now(s, None, str(tmp_path / "ckpt"), fmt="noop", state_partitions=None, progress=str(tmp_path / "progress"))
    got = monitor.batch_progress(spark, str(tmp_path / "progress")).filter("num_rows > 0")
    assert sorted(r["batch_id"] for r in got.collect()) == list(range(110))


def test_salted_join_never_broadcasts_the_copies(spark):
    big, small = spark.range(100).select((F.col("id") % 10).alias("a"), "id"), spark.range(10).select(F.col("id").alias("k"))
    j = joins.salted_join(big, "a", small, "k")
    assert j.count() == 100
    assert "Broadcast" not in j._jdf.queryExecution().executedPlan().toString()


def test_rescue_parses_a_line_once(spark):
    from driftwood.sources.files import parse_with_rescue

    lines = ['{"a": 1, "b": "x"}', '{"a": "n/a", "c": 2}', '{"a": 3', None, "[1]", '{"a": null, "b": null}']
    raw = spark.createDataFrame([(t,) for t in lines], "value string")
    got = parse_with_rescue(raw, "value", T.StructType.fromDDL("a long, b string"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") + plan.count("JsonToStructs") == 1 and plan.count("map_filter(") == 1
    want = [(1, "x", None), (None, None, '{"a":"n/a","c":"2"}'), (None, None, '{"_corrupt":"{\\"a\\": 3"}'), (None, None, '{"_corrupt":null}'),
            (None, None, '{"_corrupt":"[1]"}'), (None, None, None)]
    assert [tuple(r) for r in got.collect()] == want


def test_exact_profile_expands_no_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, None), (None, "b")], "k int, v string")
    prof = relational.column_profile(df)
    assert "Expand" not in prof._jdf.queryExecution().executedPlan().toString()
    got = {r["column_name"]: (r["row_count"], r["distinct_count"], r["null_count"], r["min_value"], r["max_value"]) for r in prof.collect()}
    assert got == {"k": (4, 2, 1, "1", "2"), "v": (4, 2, 1, "a", "b")}
    assert {r["distinct_count"] for r in relational.column_profile(df.limit(0)).collect()} == {0}


def test_partitions_and_buckets_follow_the_rows(spark, sf, monkeypatch):
    from driftwood.plans import relational as plans

    monkeypatch.setattr(relational.partition_count, "__defaults__", (1000,))
    n = plans.load(spark, sf, "lineitem").count()
    assert plans.coalesce(spark, sf).rdd.getNumPartitions() == -(-n // 1000) > 4
    assert plans.repartition(spark, sf).rdd.getNumPartitions() == max(16, -(-n // 1000))
    assert plans.coalesce(spark, sf).count() == n
    monkeypatch.setattr(joins.bucket_count, "__defaults__", (2000,))
    joined = plans.join_partition_aligned(spark, sf)
    buckets = max(4, -(-n // 2000))
    assert f"SelectedBucketsCount: {buckets} out of {buckets}" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.agg(F.sum("n_items")).first()[0] == n


def test_large_binary_files_are_read_in_ranges(spark, tmp_path):
    from driftwood.sources import files

    spark.range(200_000).select("id", F.rand(3).alias("r"), F.lit("\n\r\n").alias("s")).coalesce(1).write.parquet(str(tmp_path / "t"))
    folder = tmp_path / "a b"
    folder.mkdir()
    for n, p in enumerate((tmp_path / "t").glob("*.parquet")):
        (folder / f"large {n}.parquet").write_bytes(p.read_bytes())
    (folder / "small.parquet").write_bytes(b"PAR1\n\nPAR1")
    (folder / "other.txt").write_bytes(b"x" * 100)
    whole = files.scan_binary(spark, str(folder), "*.parquet", whole_bytes=1 << 40)
    split = files.scan_binary(spark, str(folder), "*.parquet", whole_bytes=5)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(200_000))
    try:
        assert split.filter("length <> content_len OR content_len IS NULL").count() == 0
        assert _rows(split) == _rows(whole) and split.count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert split.schema["content_len"].dataType == whole.schema["content_len"].dataType
