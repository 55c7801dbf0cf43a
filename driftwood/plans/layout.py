"""Cases for layout and maintenance jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import layout as L
from driftwood.operators import relational as R
from driftwood.plans.registry import case
from driftwood.session import workdir
from driftwood.sources import ingest
from driftwood.sources.sinks import save_table, table_name
from driftwood.tables import load

LI_COLS = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate"


def _fragmented(spark, d, files=32):
    root = workdir(spark, "fragmented")
    load(spark, d, "lineitem").repartition(files).write.parquet(f"{root}/t")
    return root


@case("compact", check="A")
def compact(spark, d):
    root = _fragmented(spark, d)
    return L.compact(spark, f"{root}/t", f"{root}/compacted", target_bytes=1 << 20)


@case("compact_slice", check="A")
def compact_slice(spark, d):
    root = workdir(spark, "compact_slice")
    li = load(spark, d, "lineitem").withColumn("year", F.year("l_shipdate"))
    li.repartition(16).write.partitionBy("year").parquet(f"{root}/t")
    return L.compact_slice(spark, f"{root}/t", ["year"], "year = 1997", 1 << 20)


@case("sized_write", check="A")
def sized_write(spark, d):
    root = workdir(spark, "sized")
    L.sized_write(load(spark, d, "lineitem"), root, max_records_per_file=5000)
    return L.table_stats_rollup(spark, root)


@case("auto_compact", check="A")
def auto_compact(spark, d):
    root = _fragmented(spark, d, files=64)
    return L.auto_compact(spark, f"{root}/t", small_bytes=1 << 20, min_num_files=10)


@case("zorder_layout", f"SELECT {LI_COLS} FROM lineitem")
def zorder_layout(spark, d):
    root = workdir(spark, "zorder")
    L.cluster_table(spark, f"{d}/lineitem.parquet", root, ["l_partkey", "l_suppkey"], "zorder", columns=[c.strip() for c in LI_COLS.split(",")])
    return spark.read.parquet(root)


@case("hilbert_layout", f"SELECT {LI_COLS} FROM lineitem")
def hilbert_layout(spark, d):
    root = workdir(spark, "hilbert")
    L.cluster_table(spark, f"{d}/lineitem.parquet", root, ["l_partkey", "l_suppkey", "l_orderkey"], "hilbert", columns=[c.strip() for c in LI_COLS.split(",")])
    return spark.read.parquet(root)


@case("cluster_incremental", check="A")
def cluster_incremental(spark, d):
    """Only files not yet in the clustering ledger are rewritten."""
    root = workdir(spark, "cluster_inc")
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
    li.filter("year(l_shipdate) < 1999").write.parquet(f"{root}/t")
    first = L.data_files(spark, f"{root}/t").select("path")
    L.cluster_by_curve(spark.read.parquet(f"{root}/t"), ["l_partkey", "l_suppkey"], "hilbert") \
        .drop("__curve").write.parquet(f"{root}/clustered")
    first.write.parquet(f"{root}/_ledger")
    li.filter("year(l_shipdate) >= 1999").write.mode("append").parquet(f"{root}/t")
    todo = L.data_files(spark, f"{root}/t").join(spark.read.parquet(f"{root}/_ledger"), "path", "left_anti")
    paths = [r.path for r in todo.collect()]
    new = L.cluster_by_curve(spark.read.parquet(*paths), ["l_partkey", "l_suppkey"], "hilbert").drop("__curve")
    new.write.mode("append").parquet(f"{root}/clustered")
    return spark.read.parquet(f"{root}/clustered").withColumn("files_reclustered", F.lit(len(paths)))


@case("cluster_rekey", """SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem""")
def cluster_rekey(spark, d):
    root = workdir(spark, "rekey")
    li = load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey")
    L.cluster_by_curve(li, ["l_partkey"], "zorder").drop("__curve").write.parquet(f"{root}/v1")
    # new keys: full recluster of every file under the new key set
    L.cluster_by_curve(spark.read.parquet(f"{root}/v1"), ["l_suppkey", "l_orderkey"], "zorder") \
        .drop("__curve").write.parquet(f"{root}/v2")
    return spark.read.parquet(f"{root}/v2")


@case("cluster_score", check="A")
def cluster_score(spark, d):
    root = workdir(spark, "cscore")
    li = load(spark, d, "lineitem")
    li.repartition(8).write.parquet(f"{root}/random")
    li.repartitionByRange(8, "l_partkey").write.parquet(f"{root}/ranged")
    a = L.clustering_score(L.file_stats(spark.read.parquet(f"{root}/random"), ["l_partkey"]), "l_partkey")
    b = L.clustering_score(L.file_stats(spark.read.parquet(f"{root}/ranged"), ["l_partkey"]), "l_partkey")
    return a.withColumn("layout", F.lit("random")).unionByName(b.withColumn("layout", F.lit("ranged")))


@case("file_stats", """
SELECT 'lineitem.parquet' AS file_name, count(*) AS num_records, min(l_shipdate) AS min_l_shipdate,
       max(l_shipdate) AS max_l_shipdate, CAST(count(*) - count(l_shipdate) AS BIGINT) AS nulls_l_shipdate,
       min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
       CAST(count(*) - count(l_quantity) AS BIGINT) AS nulls_l_quantity FROM lineitem""")
def file_stats(spark, d):
    st = L.file_stats(load(spark, d, "lineitem"), ["l_shipdate", "l_quantity"])
    return st.withColumn("file_name", F.element_at(F.split("file_path", "/"), -1)).drop("file_path")


@case("file_skip", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey BETWEEN 100 AND 200")
def file_skip(spark, d):
    root = workdir(spark, "skip")
    load(spark, d, "lineitem").repartitionByRange(16, "l_partkey").write.parquet(root)
    t = spark.read.parquet(root)
    kept = L.files_for_range(L.file_stats(t, ["l_partkey"]), "l_partkey", 100, 200)
    return L.read_kept(spark, kept, "l_partkey BETWEEN 100 AND 200").select("l_orderkey", "l_linenumber")


@case("bloom_write", """SELECT * FROM orders WHERE o_custkey = 42""")
def bloom_write(spark, d):
    root = workdir(spark, "bloom")
    (load(spark, d, "orders").write.option("parquet.bloom.filter.enabled#o_custkey", "true")
     .option("parquet.bloom.filter.expected.ndv#o_custkey", "100000").option("parquet.bloom.filter.fpp#o_custkey", "0.01")
     .parquet(root))
    return spark.read.parquet(root).filter("o_custkey = 42")


def _orders_table(spark, d):
    return save_table(load(spark, d, "orders"), table_name("orders_stats"), workdir(spark, "stats"))


@case("analyze", check="A")
def analyze(spark, d):
    name = _orders_table(spark, d)
    return L.analyze_table(spark, name, ["o_orderkey", "o_totalprice"]).unionByName(
        L.column_stats(spark, name, "o_totalprice").select("info_name", "info_value")
        .toDF("col_name", "data_type").withColumn("comment", F.lit(None).cast("string")))


STATS_COLUMNS = ("o_orderkey", "o_custkey", "o_totalprice")


@case("stats_view", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, count(*) FILTER ({c} IS NULL) AS num_nulls,
       TRUE AS distinct_within FROM orders""" for c in STATS_COLUMNS))
def stats_view(spark, d):
    """Column statistics as the catalog has them; distinct counts are estimates, here within a tenth of the exact ones."""
    name = _orders_table(spark, d)
    L.analyze_table(spark, name, STATS_COLUMNS)
    stats = L.stats_rows(spark, name, STATS_COLUMNS)
    exact = spark.table(name).agg(*[F.count_distinct(c).alias(c) for c in STATS_COLUMNS])
    exact = exact.unpivot([], list(STATS_COLUMNS), "column_name", "exact")
    near = F.abs(F.col("distinct_count") - F.col("exact")) <= 0.1 * F.col("exact")
    return stats.join(exact, "column_name").select("column_name", F.col("min").cast("double").alias("min_value"), F.col("max").cast("double").alias("max_value"),
                                                   "num_nulls", near.alias("distinct_within"))


@case("stats_stale", check="A")
def stats_stale(spark, d):
    name = _orders_table(spark, d)
    L.analyze_table(spark, name)
    spark.sql(f"INSERT INTO {name} SELECT * FROM {name} WHERE o_orderstatus = 'F'")
    return L.stale_stats(spark, name)


@case("orphan_report", check="A")
def orphan_report(spark, d):
    root = _fragmented(spark, d, files=8)
    # the files of even part number are live, the others orphans
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    live = L.data_files(spark, f"{root}/t").filter(part % 2 == 0).select("path")
    return ingest.orphan_files(spark, f"{root}/t", live, retain_hours=0, allow_short_retention=True)


@case("retention_advice", check="A")
def retention_advice(spark, d):
    root = _fragmented(spark, d, files=120)
    return L.retention_advice(L.table_stats_rollup(spark, f"{root}/t"))


QLOG_SQL = """WITH qlog AS (
  SELECT event_id AS query_id,
         CASE user_id % 5 WHEN 0 THEN 'l_shipdate' WHEN 1 THEN 'l_orderkey' WHEN 2 THEN 'l_partkey'
              WHEN 3 THEN 'l_suppkey' ELSE 'l_returnflag' END AS column_name,
         CASE event_id % 4 WHEN 0 THEN 'filter' WHEN 1 THEN 'join' WHEN 2 THEN 'group' ELSE 'order' END AS clause
  FROM events)"""


def query_log(spark, d):
    """Query-log rows (query_id, column, clause) derived from events."""
    e = load(spark, d, "events")
    cols = ["l_shipdate", "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag"]
    clauses = ["filter", "join", "group", "order"]
    col = F.element_at(F.array(*[F.lit(c) for c in cols]), (F.col("user_id") % 5 + 1).cast("int"))
    cl = F.element_at(F.array(*[F.lit(c) for c in clauses]), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(F.col("event_id").alias("query_id"), col.alias("column_name"), cl.alias("clause"))


@case("cluster_advice", QLOG_SQL + """,
nd AS (SELECT 'l_shipdate' AS column_name, count(DISTINCT l_shipdate) AS ndv FROM lineitem
       UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey) FROM lineitem
       UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
       UNION ALL SELECT 'l_suppkey', count(DISTINCT l_suppkey) FROM lineitem
       UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag) FROM lineitem),
f AS (SELECT column_name, count(DISTINCT query_id) * 1.0 / (SELECT count(DISTINCT query_id) FROM qlog) AS frequency,
             count_if(clause = 'filter') * 1.0 / count(*) AS filter_share,
             count_if(clause IN ('join', 'group')) * 1.0 / count(*) AS gain FROM qlog GROUP BY 1),
s AS (SELECT f.column_name, f.frequency, nd.ndv,
             CAST(CASE WHEN nd.ndv BETWEEN 10 AND 100000000 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS cardinality_score,
             0.4 * f.frequency + 0.2 * (CASE WHEN nd.ndv BETWEEN 10 AND 100000000 THEN 1.0 ELSE 0.0 END)
             + 0.2 * f.filter_share + 0.1 * (1.0 - 1.0 / nd.ndv) + 0.1 * f.gain AS score
      FROM f JOIN nd ON f.column_name = nd.column_name)
SELECT column_name, round(frequency, 4) AS frequency, ndv, cardinality_score, round(score, 4) AS score,
       CAST(rank() OVER (ORDER BY round(score, 4) DESC) AS INT) AS rnk FROM s""")
def cluster_advice(spark, d):
    from driftwood.operators.monitor import cluster_key_advice

    li = load(spark, d, "lineitem")
    return cluster_key_advice(query_log(spark, d), li, exact=True)


@case("layout_advice", """
WITH p AS (
  SELECT 'l_returnflag' AS column_name, count(DISTINCT l_returnflag) AS ndv FROM lineitem
  UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem
  UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
  UNION ALL SELECT 'l_orderkey', count(DISTINCT l_orderkey) FROM lineitem)
SELECT column_name, ndv, CASE WHEN ndv <= 1000 THEN 'partition' WHEN ndv <= 100000000 THEN 'cluster'
       ELSE 'zorder' END AS layout FROM p""")
def layout_advice(spark, d):
    from driftwood.operators.monitor import layout_choice

    prof = R.column_profile(load(spark, d, "lineitem"), ["l_returnflag", "l_shipdate", "l_partkey", "l_orderkey"])
    return layout_choice(prof)


@case("partition_health", check="A")
def partition_health(spark, d):
    root = workdir(spark, "phealth")
    load(spark, d, "orders").write.partitionBy("o_orderstatus").parquet(root)
    return L.partition_health(spark, root)


@case("maintenance_job", check="A")
def maintenance_job(spark, d):
    from driftwood.operators.monitor import maintenance

    root = _fragmented(spark, d)
    return maintenance(spark, f"{root}/t", f"{root}/optimized", ["l_partkey", "l_suppkey"], strategy="clustered")


@case("cache_reuse", """
SELECT 'flag' AS kind, l_returnflag AS k, count(*) AS count FROM lineitem WHERE l_quantity > 10 GROUP BY 2
UNION ALL SELECT 'status', l_linestatus, count(*) FROM lineitem WHERE l_quantity > 10 GROUP BY 2""")
def cache_reuse(spark, d):
    """A filtered input reused by two aggregates is persisted once, both
    results are written, then the cache is released."""
    from pyspark import StorageLevel

    li = load(spark, d, "lineitem").filter("l_quantity > 10").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        a = li.groupBy("l_returnflag").count()
        b = li.groupBy("l_linestatus").count()
        out = a.select(F.lit("flag").alias("kind"), F.col("l_returnflag").alias("k"), "count").unionByName(
            b.select(F.lit("status").alias("kind"), F.col("l_linestatus").alias("k"), "count"))
        path = f"{workdir(spark, 'cache_reuse')}/out"
        out.write.parquet(path)
    finally:
        li.unpersist()
    return spark.read.parquet(path)


@case("layout_compare", check="A")
def layout_compare(spark, d):
    from driftwood.operators.monitor import compare_layouts

    root = workdir(spark, "lcompare")
    li = load(spark, d, "lineitem")
    li.repartition(16).write.parquet(f"{root}/before")
    L.cluster_by_curve(li, ["l_partkey"], "zorder", files=16).drop("__curve").write.parquet(f"{root}/after")
    return compare_layouts(spark, f"{root}/before", f"{root}/after", "l_partkey", [(100, 200), (1000, 1100)])


@case("purge_marked", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'P'""")
def purge_marked(spark, d):
    o = load(spark, d, "orders")
    marks = o.filter("o_orderstatus = 'P'").select("o_orderkey")  # soft-delete marks
    root = workdir(spark, "purge")
    L.purge_marked(o.select("o_orderkey", "o_totalprice"), marks, ["o_orderkey"]).write.parquet(root)
    return spark.read.parquet(root)


@case("hash_buckets", "SELECT o_orderkey, o_custkey FROM orders")
def hash_buckets(spark, d):
    root = workdir(spark, "hash_buckets")
    L.hash_bucket(load(spark, d, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"], 16) \
        .write.partitionBy("bucket").parquet(root)
    return spark.read.parquet(root).select("o_orderkey", "o_custkey")
