"""Cases for data quality and the dataset runner.

Rules on ``orders`` with NULLs made by ``CASE`` on keys (the test tables hold
none): every 50th order has no amount, every 70th no customer.
"""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from driftwood.operators import datasets as D
from driftwood.operators import quality as Q
from driftwood.plans.registry import case
from driftwood.plans.sources import ORDERS_SCHEMA
from driftwood.session import workdir
from driftwood.streaming.runner import read_sink
from driftwood.tables import load

RULES = {
    "positive_amount": "amount > 0",
    "customer_present": "o_custkey IS NOT NULL",
    "known_status": "o_orderstatus IN ('F', 'O')",
}
NULLED_SQL = """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 70 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  o_orderstatus, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS amount, o_orderdate FROM orders)"""
PASS_SQL = "coalesce(amount > 0, false) AND coalesce(o_custkey IS NOT NULL, false) AND coalesce(o_orderstatus IN ('F','O'), false)"


def nulled_orders(spark, d):
    o = load(spark, d, "orders")
    k = F.col("o_orderkey")
    return o.select("o_orderkey", F.when(k % 70 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderstatus",
                    F.when(k % 50 != 0, F.col("o_totalprice")).alias("amount"), "o_orderdate")


@case("expect_warn", NULLED_SQL + " SELECT o_orderkey, o_custkey, amount FROM x")
def expect_warn(spark, d):
    obs = Observation("warn")
    out = Q.expect(nulled_orders(spark, d), RULES, action="warn", observation=obs)
    return out.select("o_orderkey", "o_custkey", "amount")


@case("expect_drop", NULLED_SQL + f" SELECT o_orderkey, o_custkey, amount FROM x WHERE {PASS_SQL}")
def expect_drop(spark, d):
    return Q.expect(nulled_orders(spark, d), RULES, action="drop").select("o_orderkey", "o_custkey", "amount")


@case("expect_fail", check="A")
def expect_fail(spark, d):
    try:
        Q.expect(nulled_orders(spark, d), RULES, action="fail")
        status = "passed"
    except Q.ExpectationFailed as e:
        status = f"failed: {e}"
    return Q.rule_counts(nulled_orders(spark, d), RULES).withColumn("status", F.lit(status))


def _counts_sql(alert=False):
    parts = []
    for n, e in RULES.items():
        parts.append(f"""SELECT '{n}' AS rule, count(*) - count_if(NOT coalesce({e}, false)) AS passed,
  count_if(NOT coalesce({e}, false)) AS failed, count(*) AS total,
  round(count_if(NOT coalesce({e}, false)) * 100.0 / count(*), 2) AS failure_pct
  {", coalesce(round(count_if(NOT coalesce(" + e + ", false)) * 100.0 / count(*), 2) > 1.0, false) AS alert" if alert else ""}
  FROM x""")
    return NULLED_SQL + "\n" + "\nUNION ALL\n".join(parts)


@case("expect_all", _counts_sql())
def expect_all(spark, d):
    return Q.rule_counts(nulled_orders(spark, d), RULES)


@case("quarantine", NULLED_SQL + f"""
SELECT o_orderkey, 'valid' AS tier, NULL AS reason FROM x WHERE {PASS_SQL}
UNION ALL
SELECT o_orderkey, 'quarantine', concat_ws(',',
  CASE WHEN NOT coalesce(amount > 0, false) THEN 'positive_amount' END,
  CASE WHEN NOT coalesce(o_custkey IS NOT NULL, false) THEN 'customer_present' END,
  CASE WHEN NOT coalesce(o_orderstatus IN ('F','O'), false) THEN 'known_status' END)
FROM x WHERE NOT ({PASS_SQL})""")
def quarantine(spark, d):
    valid, bad = Q.quarantine_split(nulled_orders(spark, d), RULES)
    return (valid.select("o_orderkey", F.lit("valid").alias("tier"), F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("o_orderkey", F.lit("quarantine").alias("tier"),
                                    F.col("_quarantine_reason").alias("reason"))))


@case("quality_metrics", _counts_sql(alert=True))
def quality_metrics(spark, d):
    return Q.quality_metrics(nulled_orders(spark, d), RULES, alert_pct=1.0)


@case("reconcile", """
WITH s AS (SELECT count(*) AS source_count, max(o_orderkey) AS source_max_id,
                  count_if(o_orderdate >= TIMESTAMP '2001-01-01') AS source_recent FROM orders),
t AS (SELECT count(*) AS target_count, max(o_orderkey) AS target_max_id,
             count_if(o_orderdate >= TIMESTAMP '2001-01-01') AS target_recent FROM orders WHERE o_orderstatus <> 'P')
SELECT *, abs(source_count - target_count) AS count_diff, abs(source_max_id - target_max_id) AS id_gap,
       CASE WHEN abs(source_count - target_count) > 100 OR abs(source_max_id - target_max_id) > 10 THEN 'FAIL'
            ELSE 'PASS' END AS status FROM s, t""")
def reconcile(spark, d):
    o = load(spark, d, "orders")
    since = F.lit("2001-01-01").cast("timestamp_ntz")
    return Q.reconcile(o, o.filter("o_orderstatus <> 'P'"), "o_orderkey", "o_orderdate", since)


RECON_LOG_SQL = """WITH log AS (
  SELECT CAST(o_orderdate AS DATE) AS check_date, count(*) AS mysql_count, count_if(o_orderstatus <> 'P') AS silver_count
  FROM orders GROUP BY 1)"""


def recon_log(spark, d):
    o = load(spark, d, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("check_date")).agg(
        F.count(F.lit(1)).alias("mysql_count"), F.count_if(F.col("o_orderstatus") != "P").alias("silver_count"))


@case("reconcile_trend", RECON_LOG_SQL + """
SELECT date_trunc('month', check_date)::DATE AS month, round(avg(mysql_count - silver_count), 4) AS avg_diff,
       max(mysql_count - silver_count) AS max_diff, count_if(mysql_count - silver_count > 2) AS failures
FROM log GROUP BY 1""")
def reconcile_trend(spark, d):
    log = recon_log(spark, d).withColumn("diff", F.col("mysql_count") - F.col("silver_count"))
    return log.groupBy(F.trunc("check_date", "MM").alias("month")).agg(
        F.round(F.avg("diff"), 4).alias("avg_diff"), F.max("diff").alias("max_diff"),
        F.count_if(F.col("diff") > 2).alias("failures"))


@case("file_completeness", """
WITH a AS (SELECT o_orderstatus AS file, count(*) AS actual_rows FROM orders GROUP BY 1),
m AS (SELECT file, actual_rows AS expected_rows FROM a UNION ALL SELECT 'X', 10)
SELECT coalesce(m.file, a.file) AS file, m.expected_rows, a.actual_rows,
       CASE WHEN a.actual_rows IS NULL THEN 'MISSING' WHEN m.expected_rows IS NULL THEN 'UNEXPECTED'
            WHEN a.actual_rows <> m.expected_rows THEN 'MISMATCH' ELSE 'OK' END AS status
FROM m FULL OUTER JOIN a ON m.file = a.file""")
def file_completeness(spark, d):
    root = workdir(spark, "completeness")
    o = load(spark, d, "orders")
    o.write.partitionBy("o_orderstatus").parquet(root)  # one landing folder per status
    # manifest written by the producer: expected rows per folder, plus one folder that never arrived
    manifest = o.groupBy(F.col("o_orderstatus").alias("file")).agg(F.count(F.lit(1)).alias("expected_rows"))
    manifest = manifest.unionByName(spark.range(1).select(F.lit("X").alias("file"), F.lit(10).cast("long").alias(
        "expected_rows")))
    landed = spark.read.parquet(root).groupBy(F.col("o_orderstatus").alias("file")).agg(
        F.count(F.lit(1)).alias("actual_rows"))
    return Q.file_completeness(landed, manifest).select("file", "expected_rows", "actual_rows", "status")


@case("dataset_runner", """
SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders WHERE o_totalprice > 0 GROUP BY 1""")
def dataset_runner(spark, d):
    p = D.DatasetGraph()

    @p.table(inputs=())
    def bronze_orders():
        return load(spark, d, "orders")

    @p.table(inputs=("bronze_orders",), expect_or_drop={"positive": "o_totalprice > 0"})
    def silver_orders(b):
        return b.select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))

    @p.table(inputs=("silver_orders",))
    def gold_daily(s):
        return s.groupBy("day").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))

    return p.run(spark, workdir(spark, "datasets"))["gold_daily"]


MV_SQL = "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total, min(o_totalprice) AS lo, " \
         "max(o_totalprice) AS hi FROM orders GROUP BY 1"


def _mv_query(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                                           F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi"))


@case("mv_full", MV_SQL)
def mv_full(spark, d):
    return D.mv_full_refresh(spark, lambda: _mv_query(load(spark, d, "orders")), workdir(spark, "mv"), "status_mv")


@case("mv_incremental", MV_SQL)
def mv_incremental(spark, d):
    o = load(spark, d, "orders")
    cut = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    aggs = {"n": ("count", "o_orderkey"), "total": ("sum", "o_totalprice"), "lo": ("min", "o_totalprice"),
            "hi": ("max", "o_totalprice")}
    root = workdir(spark, "mv_inc")
    D.mv_incremental(o.filter(cut), None, ["o_orderstatus"], aggs).write.parquet(f"{root}/v1")
    v2 = D.mv_incremental(o.filter(~cut), spark.read.parquet(f"{root}/v1"), ["o_orderstatus"], aggs)
    v2.write.parquet(f"{root}/v2")
    return spark.read.parquet(f"{root}/v2").withColumn("total", F.round("total", 2))


@case("st_refresh", "SELECT o_orderkey, o_totalprice FROM orders")
def st_refresh(spark, d):
    root = workdir(spark, "st_refresh")
    o = load(spark, d, "orders")
    q = lambda df: df.select("o_orderkey", "o_totalprice")
    o.filter("o_orderstatus = 'F'").write.json(f"{root}/in")
    D.streaming_table(spark, "orders_st", f"{root}/in", "json", ORDERS_SCHEMA, q, f"{root}/t")
    o.filter("o_orderstatus <> 'F'").write.mode("append").json(f"{root}/in")
    D.streaming_table(spark, "orders_st", f"{root}/in", "json", ORDERS_SCHEMA, q, f"{root}/t")  # only new files
    return read_sink(spark, f"{root}/t/orders_st")


@case("views", """
SELECT 'temp' AS kind, o_orderstatus, count(*) AS n FROM orders GROUP BY 2
UNION ALL SELECT 'global', o_orderstatus, count(*) FROM orders WHERE o_totalprice > 100000 GROUP BY 2
UNION ALL SELECT 'persisted', o_orderstatus, count(*) FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 2""")
def views(spark, d):
    from driftwood.sources.sinks import save_table, table_name

    o = load(spark, d, "orders")
    t, g = table_name("v_temp"), table_name("v_global")
    o.createOrReplaceTempView(t)
    o.filter("o_totalprice > 100000").createOrReplaceGlobalTempView(g)
    base = save_table(o, table_name("orders_base"), workdir(spark, "views"))
    pv = table_name("v_persisted")
    spark.sql(f"CREATE VIEW {pv} AS SELECT * FROM {base} WHERE o_orderpriority = '1-URGENT'")
    q = "SELECT '{k}' AS kind, o_orderstatus, count(*) AS n FROM {v} GROUP BY o_orderstatus"
    return (spark.sql(q.format(k="temp", v=t)).unionByName(spark.sql(q.format(k="global", v=f"global_temp.{g}")))
            .unionByName(spark.sql(q.format(k="persisted", v=pv))))


@case("conditional_load", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def conditional_load(spark, d):
    from driftwood.sources.sinks import table_name

    root = workdir(spark, "cond_load")
    src, empty, tgt = table_name("src"), table_name("empty_src"), table_name("tgt")
    load(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey").createOrReplaceTempView(src)
    load(spark, d, "orders").filter("false").select("o_orderkey").createOrReplaceTempView(empty)
    spark.sql(f"CREATE TABLE {tgt} (o_orderkey BIGINT) USING parquet LOCATION '{root}'")
    for s in (src, empty):  # the empty source inserts nothing
        spark.sql(f"""BEGIN
  DECLARE row_count BIGINT DEFAULT 0;
  SET row_count = (SELECT count(*) FROM IDENTIFIER('{s}'));
  IF row_count > 0 THEN
    INSERT INTO IDENTIFIER('{tgt}') SELECT o_orderkey FROM IDENTIFIER('{s}');
  END IF;
END""")
    return spark.table(tgt)


@case("load_analyze", check="A")
def load_analyze(spark, d):
    from driftwood.operators.layout import analyze_table
    from driftwood.sources.sinks import save_table, table_name

    name = save_table(load(spark, d, "orders"), table_name("orders_an"), workdir(spark, "analyze"))
    return analyze_table(spark, name, ["o_orderkey", "o_totalprice"])


@case("live_vs_stream", check="A")
def live_vs_stream(spark, d):
    """The same dataset function fed a batch read (``LIVE.t``) and a stream
    read (``STREAM(LIVE.t)``): both give the same rows."""
    root = workdir(spark, "live_stream")
    load(spark, d, "orders").write.parquet(f"{root}/src")

    def clean(df):
        return df.filter("o_totalprice > 0").select("o_orderkey", "o_totalprice")

    batch = clean(spark.read.schema(ORDERS_SCHEMA).parquet(f"{root}/src"))
    D.streaming_table(spark, "st", f"{root}/src", "parquet", ORDERS_SCHEMA, clean, f"{root}/t")
    stream = read_sink(spark, f"{root}/t/st")
    return batch.exceptAll(stream).unionByName(stream.exceptAll(batch)).withColumn("diff", F.lit(1))


@case("table_equal", """
SELECT (SELECT count(*) FROM orders) AS count_a, (SELECT count(*) FROM orders) AS count_b,
       0::BIGINT AS only_in_a, 0::BIGINT AS only_in_b, true AS equal""")
def table_equal(spark, d):
    root = workdir(spark, "table_equal")
    o = load(spark, d, "orders")
    o.repartition(4, "o_custkey").write.parquet(root)  # a copy with a different layout
    return D.tables_equal(o, spark.read.parquet(root))
