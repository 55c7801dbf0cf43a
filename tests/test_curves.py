"""Curve layouts: exact ranks from range partitions, bits and file counts from bytes, files skipped."""

import datetime as dt
import decimal
import math
import random

import pytest
from pyspark.sql import functions as F

from driftwood.operators import layout as L
from driftwood.operators import windows
from driftwood.tables import path


def _expected(values, bits):
    """Rank by counting the smaller values, one by one."""
    known = [v for v in values if v is not None]
    order = lambda v: (1, 0.0) if v != v else (0, v)  # noqa: E731  NaN is the largest
    return [0 if v is None else math.floor(sum(order(x) < order(v) for x in known) / len(known) * (1 << bits)) for v in values]


def _columns():
    r = random.Random(3)
    n = 400
    yield "long", [7 if k % 3 == 0 else None if k % 11 == 0 else r.choice([-(2**62), 2**62 + r.randint(0, 9), r.randint(-50, 50)]) for k in range(n)]
    yield "double", [float("nan") if k % 13 == 0 else r.choice([0.5, -1.5, float("inf"), r.random()]) for k in range(n)]
    yield "string", [None if k % 7 == 0 else r.choice(["", "a", "é", "\U0001f600", "z" * r.randint(1, 5)]) for k in range(n)]
    yield "date", [dt.date(1969, 12, 1) + dt.timedelta(r.randint(0, 90)) for _ in range(n)]
    yield "timestamp", [dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=r.randint(0, 99)) for _ in range(n)]
    yield "decimal(10,2)", [decimal.Decimal(r.randint(-500, 500)) / 100 for _ in range(n)]


@pytest.mark.parametrize("kind,values", list(_columns()), ids=lambda x: x if isinstance(x, str) else "")
@pytest.mark.parametrize("bits", [3, 16])
def test_ranks_equal_counting(spark, kind, values, bits):
    df = spark.createDataFrame(list(enumerate(values)), f"id int, v {kind}").repartition(5)
    got = {r["id"]: r["__r_v"] for r in L.rank_bits(df, ["v"], bits).collect()}
    assert [got[k] for k in range(len(values))] == _expected(values, bits)


def test_ranks_of_empty_and_null_columns(spark):
    assert L.rank_bits(spark.createDataFrame([], "v int"), ["v"]).count() == 0
    assert {r["__r_v"] for r in L.rank_bits(spark.createDataFrame([(None,), (None,)], "v string"), ["v"]).collect()} == {0}
    with pytest.raises(ValueError):
        L.rank_bits(spark.createDataFrame([([1],)], "v array<int>"), ["v"]).collect()


def test_global_running_sums(spark):
    r = random.Random(4)
    rows = [(k, r.randint(0, 9)) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, n long").repartition(7)
    got = windows.global_running_sums(df.withColumn("one", F.lit(1.0)), ["k"], {"n": ("before", "total"), "one": ("at", "rows")}, partitions=6).collect()
    assert {x["k"]: x["before"] for x in got} == {k: sum(n for j, n in rows if j < k) for k, _ in rows}
    assert {x["total"] for x in got} == {sum(n for _, n in rows)}
    assert all(x["at"] == x["k"] and x["rows"] == 500 for x in got)


def test_bits_follow_the_files():
    assert [L.curve_bits(n, 16) for n in (1, 2, 3, 4)] == [16, 16, 16, 15]
    assert L.curve_bits(2, 10_000) == 18 and L.curve_bits(3, 10**9) == 20


@pytest.mark.parametrize("curve", ["zorder", "hilbert"])
def test_a_range_of_either_key_skips_most_of_a_hundred_files(spark, sf, tmp_path, curve):
    src, dst = path(sf, "lineitem"), str(tmp_path / curve)
    size = L.file_count_and_bytes(spark, src)[1]
    files = L.cluster_table(spark, src, dst, ["l_partkey", "l_orderkey"], curve, file_bytes=size // 128 + 1)
    back = spark.read.parquet(dst)
    assert files >= 100 and back.count() == spark.read.parquet(src).count()
    stats = L.file_stats(back, ["l_partkey", "l_orderkey"]).collect()
    assert len(stats) >= 100
    for key in ("l_partkey", "l_orderkey"):
        lo, hi = back.agg(F.min(key), F.max(key)).first()
        read = []
        for share in (0.1, 0.33, 0.62, 0.9):  # a stretch of 1% of the key's values
            a = lo + (hi - lo) * share
            b = a + (hi - lo) / 100
            read.append(sum(s[f"min_{key}"] <= b and s[f"max_{key}"] >= a for s in stats))
        assert sum(read) / len(read) <= 0.25 * len(stats), read


def test_rows_that_share_all_keys_fill_several_files(spark, tmp_path):
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    out = str(tmp_path / "hot")
    L.cluster_by_curve(df, ["a", "b"], "hilbert", files=8).drop("__curve").write.parquet(out)
    back = spark.read.parquet(out).select("id", "a", F.input_file_name().alias("f"))
    assert back.count() == 4000 and back.filter("a = 5").select("f").distinct().count() >= 4
    assert max(r["count"] for r in back.groupBy("f").count().collect()) < 1500
