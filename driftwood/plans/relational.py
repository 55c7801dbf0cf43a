"""Cases for projections, filters, joins, aggregates, sorting and set operations
(SURVEY 2.3, 2.4, 2.5, 2.7, 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import joins as J
from driftwood.operators import relational as R
from driftwood.plans.registry import case
from driftwood.session import workdir
from driftwood.tables import load


def T(spark, d, name):
    return load(spark, d, name)


# ------------------------------------------------------------------ 2.3 projections

@case("project", "SELECT c_custkey, c_name FROM customer")
def project(spark, d):
    return T(spark, d, "customer").select("c_custkey", "c_name")


@case("project_alias", "SELECT c_name AS name, c_acctbal AS balance FROM customer")
def project_alias(spark, d):
    c = T(spark, d, "customer")
    return c.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))


@case("project_computed", "SELECT *, c_acctbal * 1.1 AS acctbal_uplift FROM customer")
def project_computed(spark, d):
    c = T(spark, d, "customer")
    return c.select("*", (F.col("c_acctbal") * 1.1).alias("acctbal_uplift"))


@case("with_column", "SELECT * REPLACE (upper(c_mktsegment) AS c_mktsegment) FROM customer")
def with_column(spark, d):
    c = T(spark, d, "customer")
    return c.withColumn("c_mktsegment", F.upper("c_mktsegment"))


@case("with_columns", """
SELECT *, l_extendedprice * (1 - l_discount) AS net,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS gross,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) > 50000 AS is_large
FROM lineitem""")
def with_columns(spark, d):
    li = T(spark, d, "lineitem")
    return R.with_columns_chain(li, [
        {"net": F.col("l_extendedprice") * (1 - F.col("l_discount"))},
        {"gross": F.col("net") * (1 + F.col("l_tax"))},
        {"is_large": F.col("gross") > 50000},
    ])


@case("drop_column", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def drop_column(spark, d):
    return T(spark, d, "customer").drop("c_acctbal", "c_mktsegment")


@case("rename_column", "SELECT n_nationkey AS nation_id, n_name, n_regionkey FROM nation")
def rename_column(spark, d):
    return T(spark, d, "nation").withColumnRenamed("n_nationkey", "nation_id")


@case("filter_cmp", "SELECT * FROM orders WHERE o_totalprice > 200000")
def filter_cmp(spark, d):
    return T(spark, d, "orders").filter(F.col("o_totalprice") > 200000)


@case("filter_and", "SELECT * FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def filter_and(spark, d):
    o = T(spark, d, "orders")
    return o.filter((F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F"))


@case("filter_or_like", "SELECT * FROM part WHERE p_name LIKE '%ring%' OR p_type LIKE '%BRASS%'")
def filter_or_like(spark, d):
    p = T(spark, d, "part")
    return p.filter(F.col("p_name").like("%ring%") | F.col("p_type").like("%BRASS%"))


@case("filter_not", "SELECT * FROM orders WHERE NOT (o_orderstatus = 'O')")
def filter_not(spark, d):
    return T(spark, d, "orders").filter(~(F.col("o_orderstatus") == "O"))


@case("filter_between", "SELECT * FROM part WHERE p_size BETWEEN 10 AND 20")
def filter_between(spark, d):
    return T(spark, d, "part").filter(F.col("p_size").between(10, 20))


@case("filter_in", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def filter_in(spark, d):
    return T(spark, d, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))


@case("filter_rlike", "SELECT * FROM pages WHERE regexp_matches(url, '^https://[a-z]+\\.')")
def filter_rlike(spark, d):
    return T(spark, d, "pages").filter(F.col("url").rlike(r"^https://[a-z]+\."))


TIER_SQL = """
SELECT c_custkey,
       CASE WHEN c_acctbal >= 8000 THEN 'VIP'
            WHEN c_acctbal >= 5000 THEN 'Premium'
            WHEN c_acctbal >= 0 THEN 'Standard'
            ELSE 'Inactive' END AS tier
FROM customer"""


@case("case_when", TIER_SQL)
def case_when(spark, d):
    c = T(spark, d, "customer")
    tier = (F.when(F.col("c_acctbal") >= 8000, "VIP").when(F.col("c_acctbal") >= 5000, "Premium")
            .when(F.col("c_acctbal") >= 0, "Standard").otherwise("Inactive"))
    return c.select("c_custkey", tier.alias("tier"))


@case("case_sql", TIER_SQL)
def case_sql(spark, d):
    c = T(spark, d, "customer")
    return c.select("c_custkey", F.expr(
        "CASE WHEN c_acctbal >= 8000 THEN 'VIP' WHEN c_acctbal >= 5000 THEN 'Premium' "
        "WHEN c_acctbal >= 0 THEN 'Standard' ELSE 'Inactive' END").alias("tier"))


@case("null_tests", """
WITH x AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS bal FROM customer)
SELECT c_custkey, bal IS NULL AS is_null, bal IS NOT NULL AS not_null,
       coalesce(isnan(bal), false) AS is_nan FROM x""")
def null_tests(spark, d):
    c = T(spark, d, "customer")
    x = c.select("c_custkey", F.when(F.col("c_acctbal") < 0, None).otherwise(F.col("c_acctbal")).alias("bal"))
    return x.select("c_custkey", F.col("bal").isNull().alias("is_null"),
                    F.col("bal").isNotNull().alias("not_null"),
                    F.coalesce(F.isnan("bal"), F.lit(False)).alias("is_nan"))


AS_OF = "2024-01-30 00:00:00"


@case("filter_interval", f"SELECT * FROM events WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY")
def filter_interval(spark, d):
    e = T(spark, d, "events")
    return e.filter(F.col("ts") > F.lit(AS_OF).cast("timestamp_ntz") - F.expr("INTERVAL 7 DAYS"))


@case("filter_scalar_subquery", "SELECT * FROM events WHERE ts = (SELECT max(ts) FROM events)")
def filter_scalar_subquery(spark, d):
    e = T(spark, d, "events")
    return e.filter(F.col("ts") == e.select(F.max("ts")).scalar())


@case("sargable_rewrite", """
SELECT * FROM lineitem WHERE year(l_shipdate) = 1997 AND l_extendedprice * 0.9 > 50000""")
def sargable_rewrite(spark, d):
    li = T(spark, d, "lineitem")
    return li.filter(R.sargable_year("l_shipdate", 1997)
                     & R.sargable_scaled("l_extendedprice", 0.9, ">", 50000.0))


@case("sample", check="A")
def sample(spark, d):
    """Seeded Bernoulli sample; the sampling itself is the feature."""
    return T(spark, d, "lineitem").sample(fraction=0.1, seed=42)


@case("filter_before_join", """
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment = 'AUTOMOBILE' AND o.o_totalprice > 100000""")
def filter_before_join(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    return (j.filter((F.col("c_mktsegment") == "AUTOMOBILE") & (F.col("o_totalprice") > 100000))
            .select("o_orderkey", "c_name"))


# ------------------------------------------------------------------------ 2.4 joins

@case("join_inner", """
SELECT o.o_orderkey, o.o_totalprice, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_inner(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    return (o.join(c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey", "inner")
            .select("o_orderkey", "o_totalprice", "c_name"))


@case("join_left", """
SELECT c.c_custkey, o.o_orderkey FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey""")
def join_left(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderkey")


@case("join_right", """
SELECT c.c_custkey, o.o_orderkey FROM orders o RIGHT JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_right(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    return o.join(c, o.o_custkey == c.c_custkey, "right").select("c_custkey", "o_orderkey")


@case("join_full", """
WITH a AS (SELECT o_custkey, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
b AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0)
SELECT coalesce(a.o_custkey, b.c_custkey) AS custkey, a.n_orders, b.c_name
FROM a FULL OUTER JOIN b ON a.o_custkey = b.c_custkey""")
def join_full(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    a = o.filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    b = c.filter("c_acctbal > 0").select("c_custkey", "c_name")
    return a.join(b, a.o_custkey == b.c_custkey, "outer").select(
        F.coalesce("o_custkey", "c_custkey").alias("custkey"), "n_orders", "c_name")


@case("join_anti", """
SELECT * FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey)""")
def join_anti(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti")


@case("join_semi", """
SELECT * FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def join_semi(spark, d):
    docs, lab = T(spark, d, "documents"), T(spark, d, "labels")
    return docs.join(lab, "doc_id", "left_semi")


@case("join_cross", """
SELECT n.n_name, r.r_name, n.n_regionkey = r.r_regionkey AS same_region FROM nation n CROSS JOIN region r""")
def join_cross(spark, d):
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    return J.cross_join_bounded(n, r, max_small_rows=1000).select(
        "n_name", "r_name", (F.col("n_regionkey") == F.col("r_regionkey")).alias("same_region"))


@case("join_multi_key", """
WITH q AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2),
r AS (SELECT l_partkey, l_suppkey, max(l_discount) AS max_disc FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2)
SELECT q.l_partkey, q.l_suppkey, q.qty, r.max_disc
FROM q JOIN r ON q.l_partkey = r.l_partkey AND q.l_suppkey = r.l_suppkey""")
def join_multi_key(spark, d):
    li = T(spark, d, "lineitem")
    q = li.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    r = (li.filter("l_returnflag = 'R'").groupBy("l_partkey", "l_suppkey")
         .agg(F.max("l_discount").alias("max_disc")))
    return q.join(r, (q.l_partkey == r.l_partkey) & (q.l_suppkey == r.l_suppkey)).select(
        q.l_partkey, q.l_suppkey, "qty", "max_disc")


SUPP_JOIN_SQL = """
SELECT l.l_orderkey, l.l_linenumber, s.s_name, s.s_nationkey
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


def _li_supp(spark, d, how_hint=None, bcast=False):
    li, s = T(spark, d, "lineitem"), T(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    if bcast:
        s = J.broadcast_checked(s, max_rows=5_000_000)
    elif how_hint:
        s = s.hint(how_hint)
    return li.join(s, li.l_suppkey == s.s_suppkey).select("l_orderkey", "l_linenumber", "s_name", "s_nationkey")


@case("join_broadcast", SUPP_JOIN_SQL)
def join_broadcast(spark, d):
    return _li_supp(spark, d, bcast=True)


@case("join_sort_merge", SUPP_JOIN_SQL)
def join_sort_merge(spark, d):
    return _li_supp(spark, d, how_hint="merge")


@case("join_shuffle_hash", SUPP_JOIN_SQL)
def join_shuffle_hash(spark, d):
    return _li_supp(spark, d, how_hint="shuffle_hash")


@case("join_theta", """
WITH bands AS (SELECT r_name, r_regionkey * 2000.0 - 1000.0 AS lo, (r_regionkey + 1) * 2000.0 - 1000.0 AS hi FROM region)
SELECT c.c_custkey, b.r_name AS band FROM customer c JOIN bands b ON c.c_acctbal >= b.lo AND c.c_acctbal < b.hi""")
def join_theta(spark, d):
    c, r = T(spark, d, "customer"), T(spark, d, "region")
    bands = r.select("r_name", (F.col("r_regionkey") * 2000.0 - 1000.0).alias("lo"),
                     ((F.col("r_regionkey") + 1) * 2000.0 - 1000.0).alias("hi"))
    return J.band_join(c, "c_acctbal", bands, "lo", "hi").select("c_custkey", F.col("r_name").alias("band"))


RANGE_SQL = """
WITH w AS (SELECT event_id AS window_id, ts AS start_ts, ts + INTERVAL 1 HOUR AS end_ts FROM events WHERE event_type = 'purchase'),
p AS (SELECT event_id, ts FROM events WHERE event_type = 'click')
SELECT w.window_id, p.event_id FROM p JOIN w ON p.ts BETWEEN w.start_ts AND w.end_ts"""


@case("join_range_binned", RANGE_SQL)
def join_range_binned(spark, d):
    e = T(spark, d, "events")
    w = e.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("window_id"), F.col("ts").alias("start_ts"),
        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("end_ts"))
    p = e.filter("event_type = 'click'").select("event_id", "ts")
    return J.range_join_binned(p, "ts", w, "start_ts", "end_ts", bin_seconds=3600).select("window_id", "event_id")


@case("join_interval", """
WITH v AS (SELECT user_id, event_id AS view_id, ts AS view_ts FROM events WHERE event_type = 'view'),
c AS (SELECT user_id, event_id AS click_id, ts AS click_ts FROM events WHERE event_type = 'click')
SELECT v.user_id, v.view_id, c.click_id FROM v JOIN c
ON v.user_id = c.user_id AND c.click_ts BETWEEN v.view_ts AND v.view_ts + INTERVAL 1 HOUR""")
def join_interval(spark, d):
    e = T(spark, d, "events")
    v = e.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    c = e.filter("event_type = 'click'").select(F.col("user_id").alias("c_user"), F.col("event_id").alias("click_id"),
                                                F.col("ts").alias("click_ts"))
    return J.interval_join(v, "user_id", "view_ts", c, "c_user", "click_ts", seconds=3600).select(
        "user_id", "view_id", "click_id")


PART_JOIN_SQL = """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


@case("join_salted", PART_JOIN_SQL)
def join_salted(spark, d):
    li, p = T(spark, d, "lineitem"), T(spark, d, "part").select("p_partkey", "p_brand")
    return J.salted_join(li, "l_partkey", p, "p_partkey", salts=8, salt_by=["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "p_brand")


@case("join_aqe_skew", """
SELECT l.l_orderkey, l.l_linenumber, p.p_brand FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def join_aqe_skew(spark, d):
    """Runtime skew split: AQE confs as in the guide; the plan is a plain join."""
    for k, v in J.AQE_SKEW_CONF.items():
        spark.conf.set(k, v)
    li, p = T(spark, d, "lineitem"), T(spark, d, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_linenumber", "p_brand")


@case("join_hot_keys", """
SELECT o.o_orderkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_hot_keys(spark, d):
    o, c = T(spark, d, "orders"), T(spark, d, "customer").select("c_custkey", "c_name")
    return J.hot_key_join(o, "o_custkey", c, "c_custkey", min_share=0.001).select("o_orderkey", "c_name")


@case("join_bucketed", """
SELECT o.o_orderkey, o.o_orderdate, sum(l.l_quantity) AS qty
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderkey, o.o_orderdate""")
def join_bucketed(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_orderdate")
    li = T(spark, d, "lineitem").select("l_orderkey", "l_quantity")
    root = workdir(spark, "bucketed")
    buckets = J.bucket_count(8, o, li)
    ot = J.write_bucketed(o, "o_orderkey", buckets, root, "orders")
    lt = J.write_bucketed(li, "l_orderkey", buckets, root, "lineitem")
    a, b = spark.table(ot), spark.table(lt)
    return (a.join(b, a.o_orderkey == b.l_orderkey).groupBy("o_orderkey", "o_orderdate")
            .agg(F.sum("l_quantity").alias("qty")))


@case("join_partition_aligned", """
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS dt, count(*) AS n_items
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
GROUP BY o.o_orderkey, CAST(o.o_orderdate AS DATE)""")
def join_partition_aligned(spark, d):
    """Both tables lie in month partitions and in buckets of the order key, written so at load time (when line items get their
    order's date); the join on (month, key) then reads bucket beside bucket, without an Exchange on either side."""
    o = T(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dt"), F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    li = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), F.col("month").alias("l_month")), "l_orderkey")
    root = workdir(spark, "aligned")
    buckets = J.bucket_count(4, T(spark, d, "orders"), T(spark, d, "lineitem"))
    ot = J.write_bucketed(o, "o_orderkey", buckets, root, "orders", partition_by="month")
    lt = J.write_bucketed(li, "l_orderkey", buckets, root, "lineitem", partition_by="l_month")
    return J.aligned_join(spark, ot, lt, [("month", "l_month"), ("o_orderkey", "l_orderkey")]).groupBy("o_orderkey", "dt").agg(
        F.count(F.lit(1)).alias("n_items"))


@case("join_dpp", """
SELECT year(l.l_shipdate)::INT AS ship_year, r.r_name, round(sum(l.l_extendedprice), 2) AS revenue
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE r.r_name = 'ASIA' GROUP BY 1, 2""")
def join_dpp(spark, d):
    li = T(spark, d, "lineitem")
    root = workdir(spark, "dpp")
    # Fact partitioned by supplier nation: the dimension filter prunes files at run time.
    fact_path = f"{root}/lineitem_by_nation"
    s = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    (li.join(s, li.l_suppkey == s.s_suppkey).drop("s_suppkey").write
     .partitionBy("s_nationkey").parquet(fact_path))
    fact = spark.read.parquet(fact_path)
    n, r = T(spark, d, "nation"), T(spark, d, "region")
    dim = n.join(r, n.n_regionkey == r.r_regionkey).filter(F.col("r_name") == "ASIA")
    return (fact.join(dim, fact.s_nationkey == dim.n_nationkey)
            .groupBy(F.year("l_shipdate").alias("ship_year"), "r_name")
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("revenue")))


@case("lookup_broadcast", """
SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def lookup_broadcast(spark, d):
    c, n = T(spark, d, "customer"), T(spark, d, "nation")
    return J.with_lookup(c.select("c_custkey", "c_nationkey"), "c_nationkey", n, "n_nationkey", "n_name", "n_name").select("c_custkey", "n_name")


@case("join_asof", """
WITH s AS (SELECT user_id, ts AS signup_ts, event_id AS signup_id FROM events WHERE event_type = 'signup'),
e AS (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'signup'),
m AS (SELECT e.event_id, e.user_id, s.signup_id,
             row_number() OVER (PARTITION BY e.event_id ORDER BY s.signup_ts DESC, s.signup_id DESC) AS rn
      FROM e LEFT JOIN s ON s.user_id = e.user_id AND s.signup_ts <= e.ts)
SELECT event_id, user_id, signup_id FROM m WHERE rn = 1""")
def join_asof(spark, d):
    e = T(spark, d, "events")
    left = e.filter("event_type <> 'signup'").select("event_id", "user_id", "ts")
    right = e.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("signup_ts"),
                                                     F.col("event_id").alias("signup_id"))
    return J.asof_join(left, right, key="user_id", left_ts="ts", right_ts="signup_ts",
                       right_tiebreak="signup_id").select("event_id", "user_id", "signup_id")


# ------------------------------------------------------------------ 2.5 aggregation

@case("agg_sum", """
SELECT l_returnflag, round(sum(l_quantity), 2) AS sum_qty FROM lineitem GROUP BY l_returnflag""")
def agg_sum(spark, d):
    return T(spark, d, "lineitem").groupBy("l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"))


@case("agg_multi", """
SELECT o_orderstatus, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS avg_price,
       max(o_totalprice) AS max_price, min(o_totalprice) AS min_price, count(*) AS n
FROM orders GROUP BY o_orderstatus""")
def agg_multi(spark, d):
    return T(spark, d, "orders").groupBy("o_orderstatus").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 4).alias("avg_price"),
        F.max("o_totalprice").alias("max_price"), F.min("o_totalprice").alias("min_price"),
        F.count(F.lit(1)).alias("n"))


@case("agg_keys", """
SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS revenue, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def agg_keys(spark, d):
    return T(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.count(F.lit(1)).alias("n"))


@case("agg_count_distinct", """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY o_orderpriority""")
def agg_count_distinct(spark, d):
    return T(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.countDistinct("o_custkey").alias("n_customers"))


@case("agg_having", """
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY o_custkey HAVING count(*) > 12""")
def agg_having(spark, d):
    return (T(spark, d, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
            .filter(F.col("n_orders") > 12))


@case("agg_stats", """
SELECT event_type, round(stddev_samp(value), 4) AS sd, round(var_samp(value), 4) AS var
FROM events GROUP BY event_type""")
def agg_stats(spark, d):
    return T(spark, d, "events").groupBy("event_type").agg(
        F.round(F.stddev("value"), 4).alias("sd"), F.round(F.variance("value"), 4).alias("var"))


@case("agg_collect", """
WITH c AS (SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY 1, 2)
SELECT conv_id, string_agg(role || ':' || CAST(n AS VARCHAR), ',' ORDER BY role) AS roles FROM c GROUP BY conv_id""")
def agg_collect(spark, d):
    """``collect_list(role)`` per conversation, kept bounded: the list is
    collected as (value, count) pairs after a first aggregation, so a huge
    group contributes one entry per distinct value instead of one per row."""
    c = T(spark, d, "conversations").groupBy("conv_id", "role").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.sort_array(F.collect_list(F.struct("role", "n")))
    return c.groupBy("conv_id").agg(F.array_join(F.transform(
        pairs, lambda p: F.concat(p["role"], F.lit(":"), p["n"].cast("string"))), ",").alias("roles"))


@case("agg_first_last", """
SELECT conv_id, min_by(role, turn) AS first_role, max_by(role, turn) AS last_role FROM conversations GROUP BY conv_id""")
def agg_first_last(spark, d):
    return T(spark, d, "conversations").groupBy("conv_id").agg(
        F.min_by("role", "turn").alias("first_role"), F.max_by("role", "turn").alias("last_role"))


@case("agg_global", "SELECT count(*) AS n_rows FROM lineitem")
def agg_global(spark, d):
    return T(spark, d, "lineitem").groupBy().agg(F.count("*").alias("n_rows"))


@case("agg_by_expr", """
SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INT) AS hr, date_trunc('hour', ts) AS hour_start, count(*) AS n
FROM events GROUP BY 1, 2, 3""")
def agg_by_expr(spark, d):
    e = T(spark, d, "events")
    return e.groupBy(F.to_date("ts").alias("day"), F.hour("ts").alias("hr"),
                     F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("n"))


@case("agg_conditional", """
SELECT user_id, SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS errors,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events GROUP BY user_id""")
def agg_conditional(spark, d):
    return T(spark, d, "events").groupBy("user_id").agg(
        F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0)).alias("errors"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"))


@case("agg_safe_ratio", """
SELECT user_id, ROUND(SUM(CASE WHEN event_type='error' THEN 1 ELSE 0 END) * 100.0 /
       NULLIF(SUM(CASE WHEN event_type IN ('error','purchase') THEN 1 ELSE 0 END), 0), 2) AS error_pct
FROM events GROUP BY user_id""")
def agg_safe_ratio(spark, d):
    e = T(spark, d, "events")
    f = F.sum(F.when(F.col("event_type") == "error", 1).otherwise(0))
    p = F.sum(F.when(F.col("event_type").isin("error", "purchase"), 1).otherwise(0))
    return e.groupBy("user_id").agg(F.round(f * 100.0 / F.nullif(p, F.lit(0)), 2).alias("error_pct"))


@case("agg_approx_distinct", check="A")
def agg_approx_distinct(spark, d):
    return T(spark, d, "lineitem").agg(
        F.approx_count_distinct("l_partkey", 0.05).alias("approx_parts"),
        F.countDistinct("l_partkey").alias("exact_parts"))


PROFILE_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _profile_sql():
    parts = []
    for c in PROFILE_COLS:
        parts.append(f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(DISTINCT {c}) AS distinct_count,
  round(count(DISTINCT {c}) * 100.0 / count(*), 4) AS cardinality_pct, count(*) - count({c}) AS null_count,
  CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value,
  round(avg(length(CAST({c} AS VARCHAR))), 4) AS avg_len, CAST(max(length(CAST({c} AS VARCHAR))) AS INT) AS max_len
  FROM customer""")
    return "\nUNION ALL\n".join(parts)


@case("column_profile", _profile_sql())
def column_profile(spark, d):
    return R.column_profile(T(spark, d, "customer"), PROFILE_COLS)


@case("table_summary", check="A")
def table_summary(spark, d):
    return T(spark, d, "orders").select("o_totalprice", "o_orderstatus").summary()


@case("equi_height_histogram", check="A")
def equi_height_histogram(spark, d):
    return R.equi_height_histogram(T(spark, d, "lineitem"), "l_extendedprice", bins=10)


@case("key_skew", """
WITH k AS (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey),
t AS (SELECT count(*) AS n_keys, sum(cnt) AS total_rows, CAST(ceil(count(*) * 0.01) AS BIGINT) AS top_keys FROM k),
r AS (SELECT cnt, row_number() OVER (ORDER BY cnt DESC, o_custkey) AS rk FROM k)
SELECT 'o_custkey' AS key_column, t.n_keys, t.top_keys, CAST(sum(r.cnt) AS BIGINT) AS top_rows, t.total_rows,
       round(sum(r.cnt) * 100.0 / t.total_rows, 4) AS top_share_pct
FROM r, t WHERE r.rk <= t.top_keys GROUP BY t.n_keys, t.top_keys, t.total_rows""")
def key_skew(spark, d):
    return R.key_skew(T(spark, d, "orders"), "o_custkey", top_pct=1.0)


@case("partition_report", """
SELECT CAST(year(l_shipdate) AS INT) AS year, CAST(month(l_shipdate) AS INT) AS month, count(*) AS n_rows,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price
FROM lineitem GROUP BY 1, 2""")
def partition_report(spark, d):
    li = T(spark, d, "lineitem")
    return li.groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("l_extendedprice").alias("min_price"),
        F.max("l_extendedprice").alias("max_price"))


@case("agg_salted", """
SELECT l_suppkey, round(sum(l_quantity), 2) AS sum_value, count(*) AS n_rows, max(l_quantity) AS max_value
FROM lineitem GROUP BY l_suppkey""")
def agg_salted(spark, d):
    r = R.salted_agg(T(spark, d, "lineitem"), "l_suppkey", "l_quantity", salts=16)
    return r.withColumn("sum_value", F.round("sum_value", 2))


# ------------------------------------------------------------------ 2.7 sort / limit

@case("sort", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders ORDER BY o_orderdate, o_totalprice DESC")
def sort(spark, d):
    return T(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_totalprice").orderBy(
        "o_orderdate", F.desc("o_totalprice"))


@case("sort_case", """
SELECT o_orderkey, o_orderpriority FROM orders
ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, o_orderkey""")
def sort_case(spark, d):
    o = T(spark, d, "orders")
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2).otherwise(3)
    return o.select("o_orderkey", "o_orderpriority").orderBy(rank, "o_orderkey")


@case("top_k", """
SELECT l_partkey, round(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY l_partkey
ORDER BY qty DESC, l_partkey LIMIT 10""")
def top_k(spark, d):
    li = T(spark, d, "lineitem")
    return (li.groupBy("l_partkey").agg(F.round(F.sum("l_quantity"), 2).alias("qty"))
            .orderBy(F.desc("qty"), "l_partkey").limit(10))


@case("sort_within", """SELECT * FROM lineitem""")
def sort_within(spark, d):
    li = T(spark, d, "lineitem")
    return li.repartition(R.partition_count(li, 8), "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber")


@case("repartition", """SELECT * FROM lineitem""")
def repartition(spark, d):
    li = T(spark, d, "lineitem")
    return li.repartition(R.partition_count(li, 16), "l_orderkey")


@case("coalesce", """SELECT * FROM lineitem""")
def coalesce(spark, d):
    li = T(spark, d, "lineitem")
    parts = R.partition_count(li, 4)
    return li.repartition(4 * parts).coalesce(parts)


@case("partition_sizes", check="A")
def partition_sizes(spark, d):
    li = T(spark, d, "lineitem")
    return R.partition_sizes(li.repartition(R.partition_count(li, 8), "l_orderkey"))


# ------------------------------------------------------------------ 2.8 set ops, dedup

@case("union_all", """
SELECT c_name AS name, 'customer' AS kind FROM customer UNION ALL SELECT s_name, 'supplier' FROM supplier""")
def union_all(spark, d):
    c = T(spark, d, "customer").select(F.col("c_name").alias("name"), F.lit("customer").alias("kind"))
    s = T(spark, d, "supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return c.union(s)


@case("union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, NULL::INTEGER AS nationkey FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""")
def union_by_name(spark, d):
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                       F.col("c_acctbal").alias("balance"))
    s = T(spark, d, "supplier").select(F.col("s_nationkey").alias("nationkey"), F.col("s_name").alias("name"),
                                       F.col("s_suppkey").alias("id"))
    return c.unionByName(s, allowMissingColumns=True)


@case("dedup_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_discount FROM lineitem")
def dedup_rows(spark, d):
    return T(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_discount").dropDuplicates()


@case("dedup_key", "SELECT DISTINCT o_custkey FROM orders")
def dedup_key(spark, d):
    # arbitrary survivor per key: only the key set is deterministic
    return T(spark, d, "orders").dropDuplicates(["o_custkey"]).select("o_custkey")


@case("distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(spark, d):
    return T(spark, d, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@case("dedup_first", """
SELECT o_orderkey, o_custkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1""")
def dedup_first(spark, d):
    o = T(spark, d, "orders")
    return R.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice")


@case("dedup_replay", """
SELECT 'orders.parquet' AS file_path, o_orderkey AS record_id, 1 AS load_id FROM orders""")
def dedup_replay(spark, d):
    """A load replayed: every (file, record) arrives twice; keep the first ingest."""
    o = T(spark, d, "orders").select(F.lit("orders.parquet").alias("file_path"),
                                     F.col("o_orderkey").alias("record_id"))
    loads = o.withColumn("load_id", F.lit(1)).unionByName(o.withColumn("load_id", F.lit(2)))
    loads = loads.withColumn("_ingested_at", F.timestamp_seconds(F.col("load_id") * 3600))
    return R.first_per_key(loads, ["file_path", "record_id"], ["_ingested_at", "load_id"]).select(
        "file_path", "record_id", "load_id")
