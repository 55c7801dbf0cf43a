"""Benchmark: wall time of the headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully executed into the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "medallion",            # flagship: scan -> rules -> pre-aggregated join -> agg -> window
    "agg_sum",              # grouped sum over parquet (the published format baseline)
    "agg_keys",
    "join_inner",
    "join_salted",
    "join_range_binned",
    "join_interval",
    "join_asof",
    "win_running_sum",
    "win_ntile",
    "key_skew",
    "column_profile",
    "dedup_first",
    "scd1_apply",
    "scd2_apply",
    "quarantine",
    "json_flatten",
    "str_regexp_replace",
    "zorder_layout",
    "stream_tumbling",
    "ss_inner",
]


def details(spark, sf_dir: str, times: dict) -> dict:
    """Survey section 6 extras: events per second through the streaming
    window and join, and files / bytes a range predicate reads before and
    after Z-ordering (file skipping from per-file min/max)."""
    from driftwood.operators import layout as L
    from driftwood.operators.monitor import compare_layouts
    from driftwood.session import workdir
    from driftwood.tables import load

    n_events = load(spark, sf_dir, "events").count()
    d = {f"{k}_events_per_sec": round(n_events / times[k], 1) for k in ("stream_tumbling", "ss_inner") if k in times}
    root = workdir(spark, "bench_layout")
    li = load(spark, sf_dir, "lineitem")
    li.repartition(16).write.parquet(f"{root}/before")
    L.cluster_by_curve(li, ["l_partkey", "l_suppkey"], "zorder", files=16).drop("__curve").write.parquet(f"{root}/after")
    rows = compare_layouts(spark, f"{root}/before", f"{root}/after", "l_partkey", [(1000, 1200)]).collect()
    for r in rows:
        d[f"zorder_{r.layout}_files_read"] = f"{r.files_read}/{r.files_total}"
        d[f"zorder_{r.layout}_bytes_read"] = int(r.bytes_read or 0)
    d["grouped_sum_by_format"] = grouped_sum_by_format(spark, li, root)
    return d


def grouped_sum_by_format(spark, li, root: str) -> dict:
    """The published format comparison, at this scale: ``SELECT country,
    SUM(amount) GROUP BY country`` over the same rows stored as CSV, JSON,
    Parquet and ORC (seconds, median of 3, and bytes on disk)."""
    from pyspark.sql import functions as F

    from driftwood.sources.ingest import list_files

    rows = li.select(F.col("l_returnflag").alias("country"), F.col("l_extendedprice").alias("amount"),
                     "l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
    out = {}
    for fmt in ("csv", "json", "parquet", "orc"):
        path = f"{root}/fmt_{fmt}"
        w = rows.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", "true")
        w.save(path)
        r = spark.read.format(fmt).schema(rows.schema)
        if fmt == "csv":
            r = r.option("header", "true")
        samples = []
        for _ in range(3):
            t0 = time.perf_counter()
            r.load(path).groupBy("country").agg(F.sum("amount").alias("total")).collect()
            samples.append(time.perf_counter() - t0)
        size = list_files(spark, path).agg(F.sum("size")).first()[0]
        out[fmt] = {"sec": round(statistics.median(samples), 3), "bytes": int(size or 0)}
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from driftwood.plans.registry import queries
    from driftwood.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="driftwood-bench")
    qs = queries()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for key in HEADLINE:
        fn = qs[key]
        try:
            samples = []
            for i in range(runs + 1):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i > 0:  # first run warms the JVM, file cache and Python workers
                    samples.append(dt)
            times[key] = round(statistics.median(samples), 3)
        except Exception as e:  # report, keep going
            failed[key] = f"{type(e).__name__}: {str(e)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "runs": runs}
    try:
        out["details"] = details(spark, sf_dir, times)
    except Exception as e:  # details are informative only
        out["details_error"] = f"{type(e).__name__}: {str(e)[:200]}"
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
