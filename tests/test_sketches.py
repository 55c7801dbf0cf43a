"""Column sketches: merges, stated errors, plans."""

import pytest
from pyspark.sql import functions as F

from driftwood.operators import monitor, sketches
from driftwood.operators.relational import column_profile

COLS = ["l_orderkey", "l_partkey", "l_shipdate", "l_extendedprice", "l_returnflag"]


@pytest.fixture(scope="module")
def lineitem(spark, sf):
    return spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("year", F.year("l_shipdate"))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_parts_merge_to_the_whole_within_the_stated_error(spark, lineitem):
    parts = sketches.column_sketches(lineitem, COLS, by=["year"])
    assert parts.count() == len(COLS) * lineitem.select("year").distinct().count()
    whole = {r["column_name"]: r for r in sketches.profile(sketches.merged(parts)).collect()}
    once = {r["column_name"]: r for r in sketches.profile(sketches.column_sketches(lineitem, COLS)).collect()}
    exact = {r["column_name"]: r for r in column_profile(lineitem, COLS).collect()}
    for c in COLS:
        assert (whole[c]["row_count"], whole[c]["null_count"]) == (exact[c]["row_count"], exact[c]["null_count"])
        for got in (whole[c], once[c]):
            assert abs(got["distinct_count"] - exact[c]["distinct_count"]) <= 0.05 * exact[c]["distinct_count"]
    assert whole["l_shipdate"]["quantiles"] is None
    prices = sorted(r[0] for r in lineitem.select("l_extendedprice").collect())
    for q, edge in zip((0.25, 0.5, 0.75), whole["l_extendedprice"]["quantiles"][1:4]):
        assert abs(sum(p <= edge for p in prices) / len(prices) - q) <= 0.02
    assert (whole["l_extendedprice"]["quantiles"][0], whole["l_extendedprice"]["quantiles"][-1]) == (prices[0], prices[-1])


def test_histogram_bins_hold_equal_shares(spark, lineitem):
    bins = sketches.equi_height(sketches.column_sketches(lineitem, ["l_extendedprice", "l_returnflag"]), 8).orderBy("bin").collect()
    prices = [r[0] for r in lineitem.select("l_extendedprice").collect()]
    assert [b["bin"] for b in bins] == list(range(1, 9))
    for b in bins:
        inside = sum((b["lo"] < p or b["bin"] == 1) and p <= b["hi"] for p in prices)
        assert abs(inside - b["height"]) <= 0.04 * len(prices)


def test_null_and_empty_columns(spark):
    df = spark.createDataFrame([(None, None), (None, "a")], "n long, s string")
    got = {r["column_name"]: tuple(r)[1:] for r in sketches.profile(sketches.column_sketches(df)).collect()}
    assert got == {"n": (2, 2, 0, None), "s": (2, 1, 1, None)}
    empty = {r["column_name"]: tuple(r)[1:] for r in sketches.profile(sketches.column_sketches(df.limit(0))).collect()}
    assert empty == {"n": (0, 0, 0, None), "s": (0, 0, 0, None)}


def test_advice_copies_no_row_for_a_column(spark, lineitem):
    qlog = spark.createDataFrame([(1, "l_orderkey", "filter"), (2, "l_partkey", "join"), (2, "l_returnflag", "group")], "query_id long, column_name string, clause string")
    quick, exact = monitor.cluster_key_advice(qlog, lineitem), monitor.cluster_key_advice(qlog, lineitem, exact=True)
    table = sketches.column_sketches(lineitem, COLS)
    assert "Expand" not in _plan(table) and "Generate" in _plan(table)  # the columns of one row a part, not of the table's rows
    assert "Expand" in _plan(exact)
    a, b = ({r["column_name"]: r for r in d.collect()} for d in (quick, exact))
    assert a.keys() == b.keys()
    for c in a:
        assert abs(a[c]["ndv"] - b[c]["ndv"]) <= 0.05 * b[c]["ndv"] and abs(a[c]["score"] - b[c]["score"]) < 0.01
