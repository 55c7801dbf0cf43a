"""Cases for streaming operators.

Input: ``events`` written as four time-ordered slices (rising modification
times). ``availableNow`` takes all available files without a rate limit (a
backfill); cases about late data read one file per trigger so the watermark
advances batch by batch. Queries run with ``availableNow`` into a file sink and the finished
table is returned. In append mode windows still open at the end of input are
never emitted; oracles keep windows with ``end <= max(ts) - 10 minutes``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import relational as R
from driftwood.plans.registry import case
from driftwood.plans.sources import EVENTS_SCHEMA, _events_landing
from driftwood.session import workdir
from driftwood.sources import files as FS
from driftwood.streaming import ops
from driftwood.streaming import streams as S
from driftwood.streaming.runner import read_progress, read_sink, run_available_now
from driftwood.tables import load

WM = "WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS wm FROM events)"


def _stream(spark, d, max_files=None):
    root = _events_landing(spark, d)
    return root, S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=max_files)


def _run(spark, root, df, mode="append", **kw):
    run_available_now(df, f"{root}/out", f"{root}/_ckpt", output_mode=mode, **kw)
    return read_sink(spark, f"{root}/out")


@case("stream_watermark", WM + """,
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n FROM w, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def stream_watermark(spark, d):
    root, s = _stream(spark, d)
    return _run(spark, root, S.window_agg(s, "ts", "1 hour", [F.count(F.lit(1)).alias("n")], ["event_type"]))


@case("stream_tumbling", WM + """,
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n, round(sum(value), 2) AS total
      FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n, total FROM w, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def stream_tumbling(spark, d):
    root, s = _stream(spark, d)
    out = _run(spark, root, S.window_agg(s, "ts", "1 hour", [F.count(F.lit(1)).alias("n"),
                                                             F.sum("value").alias("total")]))
    return out.withColumn("total", F.round("total", 2))


@case("stream_sliding", WM + """,
e AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS b FROM events),
x AS (SELECT b AS window_start FROM e UNION ALL SELECT b - INTERVAL 30 MINUTE FROM e),
w AS (SELECT window_start, count(*) AS n FROM x GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n FROM w, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def stream_sliding(spark, d):
    root, s = _stream(spark, d)
    return _run(spark, root, S.window_agg(s, "ts", "1 hour", [F.count(F.lit(1)).alias("n")], slide="30 minutes"))


@case("stream_session", WM + """,
e AS (SELECT user_id, ts, CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
        OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s
      FROM events),
s AS (SELECT user_id, ts, sum(new_s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e),
g AS (SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n
      FROM s GROUP BY user_id, sid)
SELECT user_id, window_start, window_end, n FROM g, m WHERE window_end <= m.wm""")
def stream_session(spark, d):
    root, s = _stream(spark, d)
    return _run(spark, root, S.session_agg(s, "ts", "30 minutes", ["user_id"], [F.count(F.lit(1)).alias("n")]))


@case("stream_etl", """
SELECT event_id, user_id, upper(event_type) AS event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(ts AS DATE) AS dt FROM events WHERE event_type <> 'error'""")
def stream_etl(spark, d):
    root, s = _stream(spark, d, max_files=2)
    etl = (s.filter("event_type <> 'error'")
           .select("event_id", "user_id", F.upper("event_type").alias("event_type"),
                   F.from_json("props", "k INT")["k"].alias("k"), F.to_date("ts").alias("dt")))
    return _run(spark, root, etl)


@case("mode_append", WM + """,
w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n FROM w, m
WHERE window_start + INTERVAL 1 DAY <= m.wm""")
def mode_append(spark, d):
    root, s = _stream(spark, d)
    return _run(spark, root, S.window_agg(s, "ts", "1 day", [F.count(F.lit(1)).alias("n")], ["event_type"]))


@case("mode_update", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def mode_update(spark, d):
    root, s = _stream(spark, d)
    agg = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    run_available_now(agg, None, f"{root}/_ckpt", output_mode="update",
                      foreach_batch=lambda b, i: ops.write_batch(b, f"{root}/updates", i))
    upd = spark.read.parquet(f"{root}/updates")
    return R.first_per_key(upd, ["event_type"], ["batch_id"], latest=True).select("event_type", "n")


@case("mode_complete", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def mode_complete(spark, d):
    root, s = _stream(spark, d)
    agg = s.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    run_available_now(agg, None, f"{root}/_ckpt", output_mode="complete",
                      foreach_batch=lambda b, i: b.write.mode("overwrite").parquet(f"{root}/complete"))
    return spark.read.parquet(f"{root}/complete")


@case("triggers", """SELECT *, (SELECT count(*) FROM events) AS rows_after_once FROM events""")
def triggers(spark, d):
    root, s = _stream(spark, d)
    q = s.writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/_ckpt").trigger(once=True).start()
    q.awaitTermination()
    first = spark.read.parquet(f"{root}/out").count()
    run_available_now(s, f"{root}/out", f"{root}/_ckpt")  # same checkpoint continues
    return read_sink(spark, f"{root}/out").withColumn("rows_after_once", F.lit(first))


def _dup_landing(spark, d):
    root = workdir(spark, "dups")
    ev = load(spark, d, "events")
    FS.write_slices(ev, f"{root}/in", "parquet", "ts", slices=4)
    FS.write_slices(ev, f"{root}/in", "parquet", "ts", slices=4)  # replayed delivery
    return root


@case("stream_dedup", "SELECT event_id, ts, event_type FROM events")
def stream_dedup(spark, d):
    root = _dup_landing(spark, d)
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=2)
    out = _run(spark, root, S.dedup(s, ["event_id"], "ts").select("event_id", "ts", "event_type"))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@case("stream_dedup_within", "SELECT event_id, ts, event_type FROM events")
def stream_dedup_within(spark, d):
    root = _dup_landing(spark, d)
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=2)
    out = _run(spark, root, S.dedup(s, ["event_id"], "ts", within_watermark=True)
               .select("event_id", "ts", "event_type"))
    return out.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def _reversed_landing(spark, d):
    """Time slices written newest first: later files hold older events."""
    root = workdir(spark, "late")
    ev = load(spark, d, "events")
    cuts = ev.agg(F.percentile_approx("ts", [0.25, 0.5, 0.75], 10000)).first()[0]
    bounds = [None, *cuts, None]
    for lo, hi in reversed(list(zip(bounds[:-1], bounds[1:]))):
        c = FS.in_slice("ts", lo, hi)
        ev.filter(c).write.mode("append").parquet(f"{root}/in")
    return root


@case("late_drop", check="A")
def late_drop(spark, d):
    root = _reversed_landing(spark, d)
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=1)
    agg = S.window_agg(s, "ts", "1 hour", [F.count(F.lit(1)).alias("n")])
    run_available_now(agg, f"{root}/out", f"{root}/_ckpt", progress=f"{root}/progress")
    dropped = read_progress(spark, f"{root}/progress").agg(F.coalesce(F.sum("rows_dropped"), F.lit(0))).first()[0]
    return read_sink(spark, f"{root}/out").withColumn("rows_dropped", F.lit(dropped))


@case("late_corrections", "SELECT event_id, event_type FROM events")
def late_corrections(spark, d):
    """Rows behind the running bound go to a corrections table, the rest to
    the main table; together they hold every event exactly once."""
    root = _reversed_landing(spark, d)
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA, max_files=1)
    run_available_now(s.select("event_id", "event_type", "ts"), None, f"{root}/_ckpt",
                      foreach_batch=ops.late_router(f"{root}", "ts", "10 minutes"))
    main = spark.read.parquet(f"{root}/main").select("event_id", "event_type")
    corr = spark.read.parquet(f"{root}/corrections").select("event_id", "event_type")
    return main.unionByName(corr)


SS_SQL = "SELECT e.event_id, c.c_mktsegment FROM events e {j} customer c ON e.user_id = c.c_custkey"


@case("ss_static_inner", SS_SQL.format(j="JOIN"))
def ss_static_inner(spark, d):
    root, s = _stream(spark, d)
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return _run(spark, root, S.stream_static_join(s, c, "user_id").select("event_id", "c_mktsegment"))


@case("ss_static_left", """
SELECT e.event_id, c.c_mktsegment FROM events e LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c
ON e.user_id = c.c_custkey""")
def ss_static_left(spark, d):
    root, s = _stream(spark, d)
    c = load(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"),
                                                                   "c_mktsegment")
    return _run(spark, root, S.stream_static_join(s, c, "user_id", "left").select("event_id", "c_mktsegment"))


@case("ss_static_semi", """
SELECT event_id, 'semi' AS kind FROM events e WHERE EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c_acctbal > 0)
UNION ALL
SELECT event_id, 'anti' FROM events e WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id AND c_acctbal > 0)""")
def ss_static_semi(spark, d):
    root, s = _stream(spark, d)
    c = load(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    semi = S.stream_static_join(s, c, "user_id", "left_semi").select("event_id", F.lit("semi").alias("kind"))
    anti = S.stream_static_join(s, c, "user_id", "left_anti").select("event_id", F.lit("anti").alias("kind"))
    return _run(spark, root, semi.unionByName(anti))


def _views_clicks(s):
    v = s.filter("event_type = 'view'").select(F.col("user_id").alias("v_user"), F.col("event_id").alias("view_id"),
                                               F.col("ts").alias("view_ts"))
    c = s.filter("event_type = 'click'").select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                                                F.col("ts").alias("click_ts"))
    return v, c


VC_SQL = """WITH v AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click')"""


@case("ss_inner", VC_SQL + """
SELECT v.view_id, c.click_id FROM v JOIN c ON v.user_id = c.user_id
AND c.click_ts BETWEEN v.view_ts AND v.view_ts + INTERVAL 1 HOUR""")
def ss_inner(spark, d):
    root, s = _stream(spark, d)
    v, c = _views_clicks(s)
    j = S.stream_stream_join(v, c, "v_user", "c_user", "view_ts", "click_ts", "1 hour")
    return _run(spark, root, j.select("view_id", "click_id"))


SS_WM = """, m AS (SELECT least((SELECT max(ts) FROM events WHERE event_type = 'view'),
                        (SELECT max(ts) FROM events WHERE event_type = 'click')) - INTERVAL 10 MINUTE AS wm),
pairs AS (SELECT v.view_id, c.click_id FROM v JOIN c ON v.user_id = c.user_id
          AND c.click_ts BETWEEN v.view_ts AND v.view_ts + INTERVAL 1 HOUR),
lonely_views AS (SELECT view_id, NULL::BIGINT AS click_id FROM v, m
                 WHERE view_id NOT IN (SELECT view_id FROM pairs) AND v.view_ts + INTERVAL 1 HOUR < m.wm),
lonely_clicks AS (SELECT NULL::BIGINT AS view_id, click_id FROM c, m
                  WHERE click_id NOT IN (SELECT click_id FROM pairs) AND c.click_ts < m.wm)"""


@case("ss_left", VC_SQL + SS_WM + " SELECT * FROM pairs UNION ALL SELECT * FROM lonely_views")
def ss_left(spark, d):
    """Left outer: an unmatched view is emitted with NULLs once the global
    watermark (min of both inputs) passes the end of its match window."""
    root, s = _stream(spark, d)
    v, c = _views_clicks(s)
    j = S.stream_stream_join(v, c, "v_user", "c_user", "view_ts", "click_ts", "1 hour", how="leftOuter")
    return _run(spark, root, j.select("view_id", "click_id"))


@case("ss_full", VC_SQL + SS_WM + """
SELECT 'full' AS kind, * FROM pairs UNION ALL SELECT 'full', * FROM lonely_views
UNION ALL SELECT 'full', * FROM lonely_clicks
UNION ALL SELECT 'right', * FROM pairs UNION ALL SELECT 'right', * FROM lonely_clicks""")
def ss_full(spark, d):
    """Right and full outer: unmatched clicks (and, for full, unmatched views)
    are emitted with NULLs once the watermark shows no partner can still arrive."""
    root, s = _stream(spark, d)
    v, c = _views_clicks(s)
    r = S.stream_stream_join(v, c, "v_user", "c_user", "view_ts", "click_ts", "1 hour", how="rightOuter")
    run_available_now(r.select(F.lit("right").alias("kind"), "view_id", "click_id"), f"{root}/right",
                      f"{root}/_ckpt_right")
    f = S.stream_stream_join(v, c, "v_user", "c_user", "view_ts", "click_ts", "1 hour", how="fullOuter")
    full = _run(spark, root, f.select(F.lit("full").alias("kind"), "view_id", "click_id"))
    return full.unionByName(read_sink(spark, f"{root}/right"))


@case("ss_semi", VC_SQL + """
SELECT v.view_id FROM v WHERE EXISTS (SELECT 1 FROM c WHERE v.user_id = c.user_id
AND c.click_ts BETWEEN v.view_ts AND v.view_ts + INTERVAL 1 HOUR)""")
def ss_semi(spark, d):
    root, s = _stream(spark, d)
    v, c = _views_clicks(s)
    j = S.stream_stream_join(v, c, "v_user", "c_user", "view_ts", "click_ts", "1 hour", how="leftSemi")
    return _run(spark, root, j.select("view_id"))


@case("watermark_policy", """
WITH m AS (SELECT least((SELECT max(ts) FROM events WHERE event_type = 'view') - INTERVAL 10 MINUTE,
                        (SELECT max(ts) FROM events WHERE event_type <> 'view') - INTERVAL 30 MINUTE) AS wm),
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n FROM w, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def watermark_policy(spark, d):
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", "min")
    root, s = _stream(spark, d)
    a = s.filter("event_type = 'view'").withWatermark("ts", "10 minutes")
    b = s.filter("event_type <> 'view'").withWatermark("ts", "30 minutes")
    u = a.unionByName(b).groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    return _run(spark, root, S.flatten_window(u))


@case("state_groups", "SELECT user_id, count(*) AS events, round(sum(value), 2) AS total_value, max(ts) AS last_ts "
      "FROM events GROUP BY 1")
def state_groups(spark, d):
    root, s = _stream(spark, d)
    run_available_now(S.running_state(s), f"{root}/out", f"{root}/_ckpt", output_mode="update",
                      foreach_batch=lambda b, i: ops.write_batch(b, f"{root}/state_rows", i))
    rows = spark.read.parquet(f"{root}/state_rows")
    last = R.first_per_key(rows, ["user_id"], ["batch_id"], latest=True)
    return last.select("user_id", "events", F.round("total_value", 2).alias("total_value"),
                       F.col("last_ts").cast("timestamp_ntz").alias("last_ts"))


@case("state_typed", WM + """,
u AS (SELECT user_id, ts, event_type, max(ts) OVER (PARTITION BY user_id) AS last FROM events)
SELECT user_id, count(*) AS events, count(DISTINCT event_type) AS event_types,
       CASE WHEN last + INTERVAL 1 DAY <= m.wm THEN 0 ELSE count(*) FILTER (ts > last - INTERVAL 1 DAY) END AS recent
FROM u, m GROUP BY user_id, last, m.wm""")
def state_typed(spark, d):
    """Totals and events of the last day; a user silent for a day before the last watermark has none left."""
    root, s = _stream(spark, d)
    run_available_now(S.typed_state(s), None, f"{root}/_ckpt", output_mode="update", confs=S.ROCKSDB_CONF,
                      foreach_batch=lambda b, i: ops.write_batch(b, f"{root}/state_rows", i))
    rows = spark.read.parquet(f"{root}/state_rows")
    return R.first_per_key(rows, ["user_id"], ["batch_id"], latest=True).select(
        "user_id", "events", "event_types", "recent")


@case("stream_chain", WM + """,
t AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS b, count(*) AS n FROM events GROUP BY 1),
h AS (SELECT time_bucket(INTERVAL 1 HOUR, b) AS window_start, max(n) AS max_10m FROM t GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, max_10m FROM h, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def stream_chain(spark, d):
    root, s = _stream(spark, d)
    ten = s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("n"))
    hourly = ten.groupBy(F.window(F.window_time("window"), "1 hour").alias("window")).agg(
        F.max("n").alias("max_10m"))
    return _run(spark, root, S.flatten_window(hourly))


@case("backfill_live", """SELECT * FROM events""")
def backfill_live(spark, d):
    """Backfill with availableNow, then continue on the same checkpoint."""
    root, ev = workdir(spark, "backfill"), load(spark, d, "events")
    cut = ev.agg(F.percentile_approx("ts", 0.5)).first()[0]
    history = F.coalesce(F.col("ts") <= F.lit(cut), F.lit(False))
    ev.filter(history).write.parquet(f"{root}/in")
    s = S.event_stream(spark, f"{root}/in", EVENTS_SCHEMA)
    run_available_now(s, f"{root}/out", f"{root}/_ckpt")
    ev.filter(~history).write.mode("append").parquet(f"{root}/in")  # what arrives while the stream is live
    q = (s.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/_ckpt")
         .trigger(processingTime="1 second").start())
    q.processAllAvailable()
    q.stop()
    return read_sink(spark, f"{root}/out")


@case("stream_evolve", """
SELECT CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 10 = 0 THEN 'web' END AS channel FROM orders""")
def stream_evolve(spark, d):
    from driftwood.plans.sources import KNOWN, _messy_json_lines

    root = _messy_json_lines(spark, d)
    s = spark.readStream.schema("value STRING").text(root)
    p = FS.parse_with_rescue(s, "value", KNOWN)
    out = p.select("o_orderkey", F.get_json_object("_rescued_data", "$.channel").alias("channel"))
    run_available_now(out, f"{root}_out", f"{root}_ckpt")
    return read_sink(spark, f"{root}_out")


@case("stream_window_table", WM + """,
w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS n FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, n FROM w, m
WHERE window_start + INTERVAL 1 HOUR <= m.wm""")
def stream_window_table(spark, d):
    root, s = _stream(spark, d)
    agg = s.withWatermark("ts", "10 minutes").groupBy(F.window("ts", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
    flat = agg.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window.end").cast("timestamp_ntz").alias("window_end"), "n")
    return _run(spark, root, flat, partition_by=None)
