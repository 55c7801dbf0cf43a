"""Cases for window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import relational as R
from driftwood.operators import windows as W
from driftwood.plans.registry import case
from driftwood.tables import load

@case("win_row_number", """
SELECT o_orderkey, o_custkey,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
FROM orders""")
def win_row_number(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return W.keyed_row_number(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "rn").select(
        "o_orderkey", "o_custkey", "rn")


@case("win_rank", """
SELECT c_custkey, c_nationkey, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC) AS rnk
FROM customer""")
def win_rank(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return W.keyed_rank(c, ["c_mktsegment"], ["c_nationkey"], "rnk", ascending=False).select(
        "c_custkey", "c_nationkey", "rnk")


@case("win_dense_rank", """
SELECT c_custkey, dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_nationkey DESC) AS drnk
FROM customer""")
def win_dense_rank(spark, d):
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return W.keyed_rank(c, ["c_mktsegment"], ["c_nationkey"], "drnk", ascending=False, dense=True).select(
        "c_custkey", "drnk")


@case("win_ntile", """
SELECT o_orderkey, CAST(ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS INT) AS quartile FROM orders""")
def win_ntile(spark, d):
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return W.global_ntile(o, 4, ["o_totalprice", "o_orderkey"], "quartile").select("o_orderkey", "quartile")


@case("win_lag", """
SELECT event_id, lag(value, 1) OVER w AS prev_value, coalesce(lag(value, 1) OVER w, 0) AS prev_or_zero
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def win_lag(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.keyed_shift(e, ["user_id"], ["ts", "event_id"], {"value": "prev_value"}, offset=1)
    return r.select("event_id", "prev_value", F.coalesce("prev_value", F.lit(0.0)).alias("prev_or_zero"))


@case("win_lead", """
SELECT event_id, coalesce(lead(value, 1) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS next_value
FROM events""")
def win_lead(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.keyed_shift(e, ["user_id"], ["ts", "event_id"], {"value": "next_value"}, offset=-1, default=0.0)
    return r.select("event_id", "next_value")


@case("win_first", """
SELECT event_id, first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS first_type FROM events""")
def win_first(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    # first row of the key: a min_by aggregate joined back (no per-key sort)
    r = W.partition_agg(e, ["user_id"], F.min_by("event_type", F.struct("ts", "event_id")), "first_type")
    return r.select("event_id", "first_type")


@case("win_last", """
SELECT event_id, last_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type FROM events""")
def win_last(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    r = W.partition_agg(e, ["user_id"], F.max_by("event_type", F.struct("ts", "event_id")), "last_type")
    return r.select("event_id", "last_type")


@case("win_running_sum", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS running_value FROM events""")
def win_running_sum(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.running_sum(e, "user_id", "ts", "event_id", "value", "running_value")
    return r.select("event_id", F.round("running_value", 2).alias("running_value"))


@case("win_moving_avg", """
WITH daily AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS amount FROM events GROUP BY 1, 2)
SELECT user_id, day, round(avg(amount) OVER (PARTITION BY user_id ORDER BY day
       RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW), 4) AS moving_avg FROM daily""")
def win_moving_avg(spark, d):
    e = load(spark, d, "events")
    daily = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum("value").alias("amount"))
    r = R.moving_avg_days(daily, "user_id", "day", "amount", days=2)
    return r.select("user_id", "day", F.round("moving_avg", 4).alias("moving_avg"))


@case("win_partition_avg", """
SELECT c_custkey, round(avg(c_acctbal) OVER (PARTITION BY c_nationkey), 4) AS nation_avg FROM customer""")
def win_partition_avg(spark, d):
    c = load(spark, d, "customer")
    r = W.partition_agg(c, ["c_nationkey"], F.avg("c_acctbal"), "nation_avg")
    return r.select("c_custkey", F.round("nation_avg", 4).alias("nation_avg"))


@case("win_total", "SELECT o_orderkey, count(*) OVER () AS total_orders FROM orders")
def win_total(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    return R.total_over_all(o, F.count(F.lit(1)), "total_orders")


@case("win_rows_frame", """
SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 4) AS centred_avg FROM events""")
def win_rows_frame(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.keyed_rows_frame(e, ["user_id"], ["ts", "event_id"], "value", -3, 3, "avg", "centred_avg")
    return r.select("event_id", F.round("centred_avg", 4).alias("centred_avg"))


@case("win_range_interval", """
SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY ts
       RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW), 2) AS week_value FROM events""")
def win_range_interval(spark, d):
    e = load(spark, d, "events").select("event_id", "user_id", "ts", "value")
    r = W.keyed_range_sum(e, "user_id", "ts", "event_id", "value", 7 * 86400, "week_value")
    return r.select("event_id", F.round("week_value", 2).alias("week_value"))


@case("win_event_gap", """
SELECT event_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) // 1000000
       AS gap_seconds
FROM events""")
def win_event_gap(spark, d):
    e = load(spark, d, "events")
    r = W.keyed_shift(e.select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], {"ts": "prev_ts"})
    return r.select("event_id", F.timestamp_diff("SECOND", F.col("prev_ts"), F.col("ts")).alias("gap_seconds"))


@case("latest_per_key", """
SELECT user_id, event_id, event_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def latest_per_key(spark, d):
    e = load(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    return R.first_per_key(e, ["user_id"], ["ts", "event_id"], latest=True)
