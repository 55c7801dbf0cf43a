"""Cases for pipeline monitoring and the typed health union (U03).

Monitoring tables are derived from ``events`` with Spark: lag history
(check_ts = ts, partition = user_id % 8, lag = value * 100), heartbeats (last
event per user), an event log with JSON details, and a query history.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import monitor as M
from driftwood.plans.layout import QLOG_SQL, query_log
from driftwood.plans.registry import case
from driftwood.plans.sources import EVENTS_SCHEMA, _events_landing
from driftwood.sources import bus
from driftwood.streaming import streams as S
from driftwood.streaming.runner import run_available_now
from driftwood.tables import load


def lag_history(spark, d):
    e = load(spark, d, "events")
    return e.select(F.col("ts").alias("check_ts"), F.lit("events").alias("topic"),
                    (F.col("user_id") % 8).cast("int").alias("partition"),
                    (F.col("value") * 100).cast("long").alias("lag"))


LAG_SQL = """WITH h AS (SELECT ts AS check_ts, 'events' AS topic, CAST(user_id % 8 AS INT) AS partition,
  CAST(trunc(value * 100) AS BIGINT) AS lag FROM events)"""


@case("batch_progress", check="A")
def batch_progress(spark, d):
    root = _events_landing(spark, d)
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=1)
    run_available_now(s, f"{root}/out", f"{root}/_ckpt", progress=f"{root}/progress")
    return M.batch_progress(spark, f"{root}/progress")


HOURLY_SQL = """WITH hrs AS (SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                                          INTERVAL 1 HOUR)) AS h FROM events),
c AS (SELECT date_trunc('hour', ts) AS h, count(*) AS n, sum(value) AS v FROM events GROUP BY 1),
p AS (SELECT CAST(epoch(hrs.h) / 3600 AS BIGINT) AS batch_id, coalesce(c.n, 0) AS num_rows,
             CAST(trunc(coalesce(c.v, 0) * 10) AS BIGINT) AS duration_ms FROM hrs LEFT JOIN c ON hrs.h = c.h)"""


def hourly_batches(spark, d):
    e = load(spark, d, "events")
    bounds = e.agg(F.date_trunc("hour", F.min("ts")).cast("timestamp_ntz").alias("lo"),
                   F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz").alias("hi"))
    hrs = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("h"))
    c = e.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    p = hrs.join(c, "h", "left")
    return p.select((F.unix_timestamp(F.col("h")) / 3600).cast("long").alias("batch_id"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("num_rows"),
                    (F.coalesce("v", F.lit(0.0)) * 10).cast("long").alias("duration_ms"))


@case("batch_alert", HOURLY_SQL + """
SELECT batch_id, num_rows, duration_ms, duration_ms > 2000 AS slow, num_rows = 0 AS empty,
       coalesce(sum(CASE WHEN num_rows = 0 THEN 1 ELSE 0 END) OVER (ORDER BY batch_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 0) >= 3
       AS empty_streak FROM p""")
def batch_alert(spark, d):
    return M.batch_alerts(hourly_batches(spark, d), max_duration_ms=2000, empty_run=3)


@case("offset_lag", """
WITH r AS (SELECT CAST(o_orderkey % 8 AS INT) AS partition, o_orderdate,
                  row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) - 1 AS "offset" FROM orders),
e AS (SELECT partition, max("offset") + 1 AS end_offset FROM r GROUP BY 1),
c AS (SELECT partition, max("offset") + 1 AS committed_offset FROM r WHERE o_orderdate < TIMESTAMP '1999-01-01' GROUP BY 1)
SELECT 'orders' AS topic, e.partition, e.end_offset - coalesce(c.committed_offset, 0) AS lag,
       e.end_offset - coalesce(c.committed_offset, 0) > 5000 AS alert
FROM e LEFT JOIN c ON e.partition = c.partition""")
def offset_lag(spark, d):
    recs = bus.to_bus_records(load(spark, d, "orders"), "orders", "o_orderkey", partitions=8, ts_col="o_orderdate",
                              partitioner="modulo")
    end = recs.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))
    cut = F.lit("1999-01-01 00:00:00").cast("timestamp")
    committed = recs.filter(F.col("timestamp") < cut).groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("committed_offset"))
    return M.offset_lag(end, committed, threshold=5000)


@case("lag_trend", LAG_SQL + """
SELECT CAST(date_trunc('minute', check_ts) AS TIMESTAMP) AS bucket, topic, sum(lag) AS total_lag FROM h GROUP BY 1, 2""")
def lag_trend(spark, d):
    return M.lag_trend(lag_history(spark, d))


@case("lag_stuck", LAG_SQL + """,
w AS (SELECT *, min(lag) OVER x AS min_lag, first_value(lag) OVER x AS first_lag FROM h
      WINDOW x AS (PARTITION BY topic, partition ORDER BY epoch_us(check_ts) RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW))
SELECT check_ts, topic, partition, lag, lag > 100 AND min_lag >= first_lag AS stuck FROM w""")
def lag_stuck(spark, d):
    return M.lag_stuck(lag_history(spark, d), minutes=10, min_lag=100)


@case("heartbeat", """
WITH l AS (SELECT user_id, max(ts) AS last_ts FROM events GROUP BY 1),
n AS (SELECT max(ts) AS now FROM events)
SELECT user_id, last_ts, (epoch_us(now) - epoch_us(last_ts)) // 1000000 AS age_seconds,
       CASE WHEN (epoch_us(now) - epoch_us(last_ts)) // 1000000 < 90 THEN 'HEALTHY'
            WHEN (epoch_us(now) - epoch_us(last_ts)) // 1000000 < 180 THEN 'WARNING' ELSE 'CRITICAL' END AS state
FROM l, n""")
def heartbeat(spark, d):
    e = load(spark, d, "events")
    last = e.groupBy("user_id").agg(F.max("ts").alias("last_ts"))
    return M.heartbeat_state(last, e.select(F.max("ts")).scalar())


HEALTH_SQL = """
WITH parts AS (
  SELECT 'ingest' AS component, ts AS check_ts, CASE WHEN event_type = 'error' THEN 'CRITICAL' ELSE 'HEALTHY' END AS status,
         value AS metric FROM events WHERE user_id % 3 = 0
  UNION ALL SELECT 'silver', ts, CASE WHEN value > 90 THEN 'WARNING' ELSE 'HEALTHY' END, value FROM events WHERE user_id % 3 = 1
  UNION ALL SELECT 'gold', ts, CASE WHEN event_type = 'error' THEN 'WARNING' ELSE 'HEALTHY' END, value FROM events
            WHERE user_id % 3 = 2
  UNION ALL SELECT 'reconcile', CAST(o_orderdate AS TIMESTAMP), CASE WHEN o_orderstatus = 'P' THEN 'WARNING' ELSE 'HEALTHY' END,
            o_totalprice FROM orders
  UNION ALL SELECT 'lag', ts, CASE WHEN value * 100 > 5000 THEN 'CRITICAL' ELSE 'HEALTHY' END, value * 100 FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY component ORDER BY check_ts DESC, metric DESC, status) AS rn FROM parts)"""


def health_parts(spark, d):
    e, o = load(spark, d, "events"), load(spark, d, "orders")
    g = F.col("user_id") % 3
    sel = lambda df, comp, status, metric: df.select(F.lit(comp).alias("component"),
                                                     F.col("ts").alias("check_ts"), status.alias("status"),
                                                     metric.cast("double").alias("metric"))
    return [
        sel(e.filter(g == 0), "ingest", F.when(F.col("event_type") == "error", "CRITICAL").otherwise("HEALTHY"),
            F.col("value")),
        sel(e.filter(g == 1), "silver", F.when(F.col("value") > 90, "WARNING").otherwise("HEALTHY"), F.col("value")),
        sel(e.filter(g == 2), "gold", F.when(F.col("event_type") == "error", "WARNING").otherwise("HEALTHY"),
            F.col("value")),
        o.select(F.lit("reconcile").alias("component"), F.col("o_orderdate").alias("check_ts"),
                 F.when(F.col("o_orderstatus") == "P", "WARNING").otherwise("HEALTHY").alias("status"),
                 F.col("o_totalprice").alias("metric")),
        sel(e, "lag", F.when(F.col("value") * 100 > 5000, "CRITICAL").otherwise("HEALTHY"), F.col("value") * 100),
    ]


@case("union_sql", HEALTH_SQL + " SELECT component, check_ts, status, metric FROM parts")
def union_sql(spark, d):
    parts = health_parts(spark, d)
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u


@case("health_board", HEALTH_SQL + " SELECT component, check_ts, status, metric FROM r WHERE rn = 1")
def health_board(spark, d):
    return M.health_board(health_parts(spark, d))


EVLOG_SQL = """WITH log AS (
  SELECT ts AS timestamp, CASE WHEN user_id % 2 = 0 THEN 'silver_orders' ELSE 'gold_daily' END AS flow,
         CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
         '{"flow_progress": {"metrics": {"num_output_rows": ' || CAST(json_extract(props, '$.k') AS BIGINT)
         || '}, "data_quality": {"dropped_records": ' || CASE WHEN event_type = 'error' THEN 1 ELSE 0 END || '}}}' AS details
  FROM events)"""


def event_log(spark, d):
    e = load(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("long")
    details = F.concat(F.lit('{"flow_progress": {"metrics": {"num_output_rows": '), k.cast("string"),
                       F.lit('}, "data_quality": {"dropped_records": '),
                       F.when(F.col("event_type") == "error", F.lit("1")).otherwise(F.lit("0")), F.lit("}}}"))
    return e.select(F.col("ts").alias("timestamp"),
                    F.when(F.col("user_id") % 2 == 0, "silver_orders").otherwise("gold_daily").alias("flow"),
                    F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
                    details.alias("details"))


@case("event_log", EVLOG_SQL + """
SELECT CAST(timestamp AS DATE) AS day, flow, count_if(level = 'ERROR') AS errors,
       sum(CAST(json_extract(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)) AS output_rows,
       sum(CAST(json_extract(details, '$.flow_progress.data_quality.dropped_records') AS BIGINT)) AS dropped_rows,
       round(sum(CAST(json_extract(details, '$.flow_progress.data_quality.dropped_records') AS BIGINT)) * 100.0
             / nullif(sum(CAST(json_extract(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)), 0), 2)
       AS drop_pct
FROM log GROUP BY 1, 2""")
def event_log_case(spark, d):
    return M.event_log_report(event_log(spark, d))


QH_SQL = """WITH qh AS (SELECT event_id AS query_id, 'SELECT * FROM ' || event_type || '_table' AS statement_text,
  CAST(trunc(value * 1000) AS BIGINT) AS duration_ms, 'user_' || CAST(user_id AS VARCHAR) AS user_name FROM events)"""


@case("query_history", QH_SQL + """
SELECT * FROM qh WHERE statement_text LIKE '%purchase%' ORDER BY duration_ms DESC, query_id LIMIT 10""")
def query_history(spark, d):
    e = load(spark, d, "events")
    qh = e.select(F.col("event_id").alias("query_id"),
                  F.concat(F.lit("SELECT * FROM "), "event_type", F.lit("_table")).alias("statement_text"),
                  (F.col("value") * 1000).cast("long").alias("duration_ms"),
                  F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_name"))
    return M.query_history_top(qh, "%purchase%", 10)


@case("column_usage", QLOG_SQL + """
SELECT column_name, clause, count(DISTINCT query_id) AS queries,
       round(count(DISTINCT query_id) * 100.0 / (SELECT count(DISTINCT query_id) FROM qlog), 4) AS share_pct
FROM qlog GROUP BY 1, 2""")
def column_usage(spark, d):
    return M.column_usage(query_log(spark, d))


@case("drop_rate", EVLOG_SQL + """,
m AS (SELECT flow, sum(CAST(json_extract(details, '$.flow_progress.data_quality.dropped_records') AS BIGINT)) AS dropped,
             sum(CAST(json_extract(details, '$.flow_progress.metrics.num_output_rows') AS BIGINT)) AS output
      FROM log GROUP BY 1)
SELECT flow, dropped, output, round(dropped * 1.0 / nullif(output, 0), 6) AS drop_rate,
       coalesce(dropped * 1.0 / nullif(output, 0) > 0.01, false) AS alert FROM m""")
def drop_rate(spark, d):
    log = event_log(spark, d)
    metrics = log.groupBy("flow").agg(
        F.sum(F.get_json_object("details", "$.flow_progress.data_quality.dropped_records").cast("long")).alias("dropped"),
        F.sum(F.get_json_object("details", "$.flow_progress.metrics.num_output_rows").cast("long")).alias("output"))
    return M.drop_rate(metrics, 0.01)


@case("schema_drift", """
WITH r AS (SELECT CASE o_orderkey % 10 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS batch, o_orderkey % 10 AS m FROM orders WHERE o_orderkey % 10 <> 3),
kv AS (SELECT batch, unnest(['o_orderkey', 'o_custkey']) AS k, 'bigint' AS kind FROM r
       UNION SELECT batch, 'o_orderstatus', 'string' FROM r UNION SELECT batch, 'o_totalprice', 'double' FROM r WHERE m NOT IN (1, 2)
       UNION SELECT batch, 'o_totalprice', 'string' FROM r WHERE m = 2 UNION SELECT batch, 'channel', 'string' FROM r WHERE m = 0),
seen AS (SELECT batch, k, list_sort(list(DISTINCT kind)) AS kinds FROM kv GROUP BY 1, 2),
grid AS (SELECT b.batch, c.k FROM (SELECT DISTINCT batch FROM seen) b, (SELECT DISTINCT k FROM seen) c)
SELECT g.batch, g.k, CASE WHEN s.kinds IS NULL THEN 'missing' WHEN p.kinds IS NULL THEN 'new' WHEN p.kinds <> s.kinds THEN 'retyped' ELSE 'same' END AS change
FROM grid g LEFT JOIN seen s ON s.batch = g.batch AND s.k = g.k LEFT JOIN seen p ON p.batch = g.batch - 1 AND p.k = g.k
WHERE s.kinds IS NOT NULL OR p.kinds IS NOT NULL""")
def schema_drift(spark, d):
    """Three batches: the plain lines, those with a further column, those that lack the price."""
    from driftwood.plans.sources import _messy_json_lines

    root = _messy_json_lines(spark, d)
    value = F.col("value")
    batch = F.when(value.contains("channel"), 1).when(value.endswith("}") & ~value.contains("o_totalprice"), 2).otherwise(0)
    raw = spark.read.text(root).withColumn("batch", batch)
    return M.schema_drift(raw, "value", "batch")


@case("skew_alert", check="A")
def skew_alert(spark, d):
    o = load(spark, d, "orders")
    return M.skew_alert(o.repartition(8, (F.col("o_orderkey") % 2 == 0).cast("int")))


@case("workload_summary", check="A")
def workload_summary(spark, d):
    e = load(spark, d, "events")
    runs = e.select(F.when(F.col("event_id") % 2 == 0, "before").otherwise("after").alias("variant"),
                    (F.col("value") / 10).alias("latency_s"), (F.col("value") * 1e6).cast("long").alias("bytes_read"),
                    (F.col("user_id") % 20).alias("files_read"))
    return M.workload_summary(runs)
