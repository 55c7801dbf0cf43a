"""Range and row frames and the as-of join on one range shuffle, against the plain windows, with null and tied times and a hot key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from driftwood.operators import joins, monitor, relational, windows


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(6)
    out = []
    for i in range(900):
        k = r.choice([None, "hot", "hot", "hot", "a", "b", f"k{r.randint(0, 40)}"])
        out.append((i, k, r.choice([None, 0, 5, 5, r.randint(-300, 300), r.randint(-3000, 3000)]), r.choice([None, round(r.uniform(-9, 9), 3), 1.0])))
    return spark.createDataFrame(out, "id long, k string, t long, v double").repartition(5)


def _same(got, want, cols=("id", "x")):
    def plain(df):
        return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, 0 if x is None else round(x, 3) if isinstance(x, float) else x) for x in r))

    a, b = plain(got), plain(want)
    assert len(a) == len(b)
    for x, y in zip(a, b):  # sums taken in another order round otherwise
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) < 1e-9) for p, q in zip(x, y)), (x, y)


@pytest.mark.parametrize("how", ["sum", "count", "min", "max"])
@pytest.mark.parametrize("preceding", [0, 7, 500])
def test_range_frames(rows, how, preceding):
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-preceding, 0)
    want = rows.withColumn("x", getattr(F, how)("v").over(w))
    _same(windows.keyed_range_agg(rows, ["k"], "t", preceding, {"x": ("v", how)}, partitions=7), want)


def test_a_hot_key_and_block_fill_several_partitions(spark):
    df = spark.range(4000).select(F.col("id"), F.lit("one").alias("k"), (F.col("id") % 997).alias("t"), F.col("id").cast("double").alias("v"))
    parts = windows._ranged(df, ["k"], ["t"], True, 6).groupBy("__part").count().collect()
    assert len(parts) == 6
    w = Window.partitionBy("k").orderBy("t").rangeBetween(-5000, 0)  # all rows in one block
    for how in ("sum", "min"):
        _same(windows.keyed_range_agg(df, ["k"], "t", 5000, {"x": ("v", how)}, partitions=6), df.withColumn("x", getattr(F, how)("v").over(w)))


@pytest.mark.parametrize("how", ["sum", "avg", "count"])
@pytest.mark.parametrize("lo, hi, parts", [(-3, 3, 7), (-1, 0, 40), (0, 5, 40), (-40, 40, 7), (0, 0, 5)])
def test_row_frames(rows, how, lo, hi, parts):
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(lo, hi)
    got = windows.keyed_rows_frame(rows, ["k"], ["t", "id"], "v", lo, hi, how, "x", partitions=parts)
    _same(got, rows.withColumn("x", getattr(F, how)("v").over(w)))


def test_row_frames_copy_no_row(rows):
    plan = windows.keyed_rows_frame(rows, ["k"], ["t", "id"], "v", -3, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


@pytest.mark.parametrize("null_safe", [False, True])
def test_asof(rows, null_safe):
    left = rows.filter("id % 3 > 0").select("id", "k", "t")
    right = rows.filter("id % 3 = 0").select("k", F.col("t").alias("rt"), F.col("id").alias("rid"), F.col("v").alias("rv"))
    got = joins.asof_join(left, right, "k", "t", "rt", "rid", null_safe=null_safe, partitions=9)
    on = F.col("k").eqNullSafe(F.col("rk")) if null_safe else F.col("k") == F.col("rk")
    met = left.join(right.withColumnRenamed("k", "rk"), on & (F.col("rt") <= F.col("t")), "left")
    want = met.groupBy("id").agg(F.max(F.struct("rt", "rid", "rv")).alias("m")).select("id", "m.rt", "m.rid", "m.rv")
    _same(got, want, ("id", "rt", "rid", "rv"))


def test_asof_of_a_key_hot_in_one_day(spark):
    hot = spark.range(6000).select((F.col("id") % 2).alias("side"), F.lit(1).alias("k"), (F.col("id") % 1000).alias("t"), "id")
    left, right = hot.filter("side = 0").select("k", "t", "id"), hot.filter("side = 1").select("k", F.col("t").alias("rt"), F.col("id").alias("rid"))
    got = joins.asof_join(left, right, "k", "t", "rt", "rid", partitions=8)
    assert windows._ranged(hot, ["k"], ["t"], True, 8).select("__part").distinct().count() == 8
    assert got.count() == 3000 and got.filter("rid IS NULL").count() == left.filter("t = 0").count()
    want = left.join(right.select(F.col("rt"), F.col("rid")), F.col("rt") <= F.col("t"), "left").groupBy("id").agg(F.max(F.struct("rt", "rid")).alias("m")).select("id", "m.rt", "m.rid")
    _same(got, want, ("id", "rt", "rid"))


def test_moving_average_and_stuck_lag(spark, rows):
    days = rows.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("t") % 40).cast("int")))
    n = F.datediff("day", F.lit("1970-01-01").cast("date"))
    w = Window.partitionBy("k").orderBy(n).rangeBetween(-2, 0)
    _same(relational.moving_avg_days(days, "k", "day", "v", 3, "x"), days.withColumn("x", F.avg("v").over(w)))
    lag = rows.filter("t IS NOT NULL").select(F.timestamp_seconds("t").alias("check_ts"), F.col("k").alias("topic"), F.lit(0).alias("partition"), (F.abs("id") * 37 % 500).alias("lag"), "id")
    w = Window.partitionBy("topic", "partition").orderBy(F.unix_micros("check_ts")).rangeBetween(-60_000_000, 0)
    first = F.min(F.struct(F.unix_micros("check_ts"), "lag")).over(w)["lag"]
    want = lag.withColumn("x", (F.col("lag") > 100) & (F.min("lag").over(w) >= first)).select("check_ts", "topic", "lag", "x")
    got = monitor.lag_stuck(lag, 1, 100).withColumnRenamed("stuck", "x")
    _same(got, want, ("check_ts", "topic", "lag", "x"))
