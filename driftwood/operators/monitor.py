"""Pipeline monitoring as queries: batch progress and alerts, consumer lag,
heartbeats, component health, event-log and query-history reports, column
usage, advice (clustering keys, layout) and layout comparisons.

Inputs are tables (progress, lag history, heartbeats, event log, query log);
every report is a DataFrame. Streaming progress comes from the table
that ``streaming.runner`` writes while a query runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftwood import constants as C
from driftwood.operators import layout as L
from driftwood.operators import sketches
from driftwood.streaming.runner import read_progress


def batch_progress(spark: SparkSession, path: str) -> DataFrame:
    """A row for each progress event of a query that ran with ``progress=path``."""
    return read_progress(spark, path).drop("rows_dropped")


def batch_alerts(progress: DataFrame, max_duration_ms: int, empty_run: int = C.EMPTY_BATCH_RUN) -> DataFrame:
    """Slow batch, empty batch, and ``empty_run`` empty batches in a row."""
    from driftwood.operators.windows import keyed_rows_frame

    marked = progress.withColumn("__empty", (F.col("num_rows") == 0).cast("int"))
    progress = keyed_rows_frame(marked, [], ["batch_id"], "__empty", -(empty_run - 1), 0, "sum", "__run")
    run = F.col("__run")
    return progress.select(
        "batch_id", "num_rows", "duration_ms",
        (F.col("duration_ms") > max_duration_ms).alias("slow"),
        (F.col("num_rows") == 0).alias("empty"),
        (F.coalesce(run, F.lit(0)) >= empty_run).alias("empty_streak"))


def offset_lag(end_offsets: DataFrame, committed: DataFrame, threshold: int = C.LAG_ALERT) -> DataFrame:
    j = end_offsets.join(committed, ["topic", "partition"], "left")
    lag = F.col("end_offset") - F.coalesce(F.col("committed_offset"), F.lit(0))
    return j.select("topic", "partition", lag.alias("lag"), (lag > threshold).alias("alert"))


def lag_trend(history: DataFrame, unit: str = "minute") -> DataFrame:
    return history.groupBy(F.date_trunc(unit, "check_ts").cast("timestamp_ntz").alias("bucket"), "topic").agg(
        F.sum("lag").alias("total_lag"))


def lag_stuck(history: DataFrame, minutes: int = C.LAG_STUCK_MINUTES, min_lag: int = C.LAG_STUCK_MIN) -> DataFrame:
    """Lag that did not fall below its level of ``minutes`` ago and is above ``min_lag``. Of several rows at the first moment, the
    smallest lag is that level."""
    from driftwood.operators.windows import keyed_range_agg

    h = history.withColumn("__us", F.unix_micros(F.col("check_ts").cast("timestamp"))).withColumn("__first", F.struct("__us", "lag"))
    h = keyed_range_agg(h, ["topic", "partition"], "__us", minutes * 60 * 1_000_000, {"__min": ("lag", "min"), "__at": ("__first", "min")})
    return h.select("check_ts", "topic", "partition", "lag",
                    ((F.col("lag") > min_lag) & (F.col("__min") >= F.col("__at.lag"))).alias("stuck"))


def heartbeat_state(last_seen: DataFrame, now, ts_col: str = "last_ts", healthy_s: int = C.HEARTBEAT_HEALTHY_S,
                    warning_s: int = C.HEARTBEAT_WARNING_S) -> DataFrame:
    age = F.timestamp_diff("SECOND", F.col(ts_col), F.lit(now) if not hasattr(now, "_jc") else now)
    return last_seen.withColumn("age_seconds", age).withColumn(
        "state", F.when(F.col("age_seconds") < healthy_s, "HEALTHY").when(F.col("age_seconds") < warning_s, "WARNING")
        .otherwise("CRITICAL"))


def severity():
    return F.expr("CASE status WHEN 'CRITICAL' THEN 1 WHEN 'WARNING' THEN 2 ELSE 3 END")


def health_board(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of typed component checks (component, check_ts, status, metric),
    latest check per component (of several at one time the one with the largest metric, then the first initial of the status), most severe first."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    row = F.struct(*[F.col(c) for c in u.columns])
    latest = u.groupBy("component").agg(F.max_by(row, F.struct("check_ts", "metric", -F.ascii("status"))).alias("r")).select("r.*")
    return latest.orderBy(severity(), "component")


def event_log_report(log: DataFrame) -> DataFrame:
    """Per day and flow: errors, output rows and dropped-record rate from the
    JSON ``details`` column (semi-structured path access)."""
    out_rows = F.expr("variant_get(parse_json(details), '$.flow_progress.metrics.num_output_rows', 'bigint')")
    dropped = F.expr("variant_get(parse_json(details), '$.flow_progress.data_quality.dropped_records', 'bigint')")
    g = log.groupBy(F.to_date("timestamp").alias("day"), "flow").agg(
        F.count_if(F.col("level") == "ERROR").alias("errors"),
        F.sum(out_rows).alias("output_rows"), F.sum(dropped).alias("dropped_rows"))
    return g.withColumn("drop_pct", F.round(F.col("dropped_rows") * 100.0 / F.nullif(F.col("output_rows"), F.lit(0)), 2))


def query_history_top(history: DataFrame, like: str, k: int = 10) -> DataFrame:
    return (history.filter(F.col("statement_text").like(like))
            .orderBy(F.desc("duration_ms"), "query_id").limit(k))


def column_usage(qlog: DataFrame) -> DataFrame:
    """Share of queries using each column, per clause."""
    total = qlog.select(F.count_distinct("query_id")).scalar()
    return qlog.groupBy("column_name", "clause").agg(F.count_distinct("query_id").alias("queries")).withColumn(
        "share_pct", F.round(F.col("queries") * 100.0 / total, 4))


def drop_rate(metrics: DataFrame, limit: float = C.DROP_RATE_ALERT) -> DataFrame:
    rate = F.col("dropped") / F.nullif(F.col("output"), F.lit(0))
    return metrics.withColumn("drop_rate", F.round(rate, 6)).withColumn("alert", F.coalesce(rate > limit, F.lit(False)))


def schema_drift(batches: DataFrame, json_col: str, batch_col: str) -> DataFrame:
    """Columns new, missing, retyped or the same per batch, against the batch before it in order of ``batch_col``,
    from the JSON keys and value kinds seen in each batch. A column that returns after an absence is new again."""
    from driftwood.operators.windows import global_row_number

    kv = batches.select(batch_col, F.explode(F.from_json(F.col(json_col), "map<string,string>")).alias("k", "v"))
    kinds = kv.select(batch_col, "k", F.when(F.col("v").rlike(r"^-?\d+$"), "bigint")
                      .when(F.col("v").rlike(r"^-?\d+\.\d*$"), "double").otherwise("string").alias("kind"))
    order = global_row_number(batches.select(batch_col).filter(F.col(batch_col).isNotNull()).distinct(), [batch_col], "__n")
    seen = kinds.groupBy(batch_col, "k").agg(F.array_sort(F.collect_set("kind")).alias("kinds")).join(order, batch_col).drop(batch_col)
    before = seen.select("k", (F.col("__n") + 1).alias("__n"), F.col("kinds").alias("prev_kinds"))
    both = seen.join(before, ["k", "__n"], "full_outer").join(order, "__n")  # what follows the last batch falls out here
    return both.select(batch_col, "k", F.when(F.col("kinds").isNull(), "missing").when(F.col("prev_kinds").isNull(), "new")
                       .when(F.col("prev_kinds") != F.col("kinds"), "retyped").otherwise("same").alias("change"))


def skew_alert(df: DataFrame, factor: float = C.SKEW_FACTOR) -> DataFrame:
    sizes = df.groupBy(F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(F.max("rows").alias("max_rows"), F.percentile_approx("rows", 0.5).alias("median_rows")).withColumn(
        "skewed", F.col("max_rows") > F.col("median_rows") * factor)


def workload_summary(runs: DataFrame) -> DataFrame:
    """Average and P95 latency, bytes and files per variant, and change pct vs 'before'."""
    g = runs.groupBy("variant").agg(F.round(F.avg("latency_s"), 4).alias("avg_latency_s"),
                                    F.percentile_approx("latency_s", 0.95).alias("p95_latency_s"),
                                    F.avg("bytes_read").alias("avg_bytes"), F.avg("files_read").alias("avg_files"))
    base = g.filter("variant = 'before'").select(F.col("avg_latency_s").alias("base")).scalar()
    return g.withColumn("latency_change_pct", F.round((F.col("avg_latency_s") - base) * 100.0 / F.nullif(base, F.lit(0.0)), 2))


# -------------------------------------------------------------- advice

def cluster_key_advice(qlog: DataFrame, table: DataFrame, lo: int = C.CLUSTER_NDV_BOUNDS[0],
                       hi: int = C.CLUSTER_NDV_BOUNDS[1], exact: bool = False) -> DataFrame:
    """Score = .4 frequency + .2 cardinality fit + .2 filter share + .1 spread
    + .1 join/group gain, ranked. Frequency = share of distinct queries
    touching the column; cardinality fit = 1 when ``lo <= ndv <= hi``. Distinct counts come from
    sketches (stated error in ``sketches``); ``exact`` counts, which copies every row once for each column."""
    total = qlog.select(F.count_distinct("query_id")).scalar()
    f = qlog.groupBy("column_name").agg(
        (F.count_distinct("query_id") / total).alias("frequency"),
        (F.count_if(F.col("clause") == "filter") / F.count(F.lit(1))).alias("filter_share"),
        (F.count_if(F.col("clause").isin("join", "group")) / F.count(F.lit(1))).alias("gain"))
    cols = [r[0] for r in qlog.select("column_name").distinct().collect()]  # column names: bounded
    cols = [c for c in cols if c in table.columns]
    if exact:
        wide = table.agg(*[F.count_distinct(c).alias(c) for c in cols])
        nd = wide.selectExpr(f"stack({len(cols)}, " + ", ".join(f"'{c}', `{c}`" for c in cols) + ") AS (column_name, ndv)")
    else:
        nd = sketches.profile(sketches.column_sketches(table, cols)).select("column_name", F.col("distinct_count").alias("ndv"))
    card = F.when(F.col("ndv").between(lo, hi), 1.0).otherwise(0.0)
    w8 = C.CLUSTER_SCORE_WEIGHTS
    s = f.join(nd, "column_name").withColumn("cardinality_score", card).withColumn(
        "score", F.round(w8["frequency"] * F.col("frequency") + w8["cardinality"] * F.col("cardinality_score")
                         + w8["correlation"] * F.col("filter_share") + w8["skew"] * (1.0 - 1.0 / F.col("ndv"))
                         + w8["gain"] * F.col("gain"), 4))
    w = Window.orderBy(F.desc("score"))  # one row per column
    return s.select("column_name", F.round("frequency", 4).alias("frequency"), "ndv", "cardinality_score", "score",
                    F.rank().over(w).alias("rnk"))


def layout_choice(profile: DataFrame, partition_max_ndv: int = 1000, cluster_max_ndv: int = 100_000_000) -> DataFrame:
    ndv = F.col("distinct_count")
    return profile.select("column_name", ndv.alias("ndv"),
                          F.when(ndv <= partition_max_ndv, "partition").when(ndv <= cluster_max_ndv, "cluster")
                          .otherwise("zorder").alias("layout"))


def maintenance(spark: SparkSession, src: str, dst: str, keys: Sequence[str], strategy: str = "quick") -> DataFrame:
    """Analyze -> optimize -> report. quick = compaction; clustered = Hilbert
    rewrite on ``keys``; full = Z-order rewrite of every file."""
    before = L.table_stats_rollup(spark, src).withColumn("step", F.lit("before"))
    df = spark.read.parquet(src)
    if strategy == "quick":
        L.compact(spark, src, dst)
    elif strategy in ("clustered", "full"):
        curve = "hilbert" if strategy == "clustered" else "zorder"
        L.cluster_by_curve(df, keys, curve).drop("__curve").write.mode("overwrite").parquet(dst)
    else:
        raise ValueError(strategy)
    after = L.table_stats_rollup(spark, dst).withColumn("step", F.lit("after"))
    return before.unionByName(after)


def compare_layouts(spark: SparkSession, before: str, after: str, col: str,
                    ranges: Sequence[tuple]) -> DataFrame:
    """Files and bytes a range predicate reads under two layouts (file skipping
    from per-file min/max)."""
    out = None
    for name, path in (("before", before), ("after", after)):
        t = spark.read.parquet(path)
        st = L.file_stats(t, [col])
        sizes = L.data_files(spark, path).select(F.col("path").alias("file_path"), "size")
        st = st.join(sizes, "file_path", "left")
        for lo, hi in ranges:
            kept = L.files_for_range(st, col, lo, hi).join(st.select("file_path", "size"), "file_path")
            r = kept.agg(F.count(F.lit(1)).alias("files_total"), F.count_if("kept").alias("files_read"),
                         F.sum(F.when(F.col("kept"), F.col("size"))).alias("bytes_read")).select(
                F.lit(name).alias("layout"), F.lit(f"{lo}-{hi}").alias("range"), "*")
            out = r if out is None else out.unionByName(r)
    return out
