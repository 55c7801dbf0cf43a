"""Cases for user functions."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from driftwood.functions import nested
from driftwood.functions import sql_functions as SF
from driftwood.functions import udfs as U
from driftwood.operators.joins import small_enough, with_lookup
from driftwood.plans.registry import case
from driftwood.plans.relational import TIER_SQL
from driftwood.session import workdir
from driftwood.sources.sinks import table_name
from driftwood.tables import load


@case("udf_sql", TIER_SQL)
def udf_sql(spark, d):
    SF.register_tier_function(spark)
    v = table_name("cust")
    load(spark, d, "customer").createOrReplaceTempView(v)
    return spark.sql(f"SELECT c_custkey, customer_tier(c_acctbal) AS tier FROM {v}")


@case("udtf_sql", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def udtf_sql(spark, d):
    v = table_name("orders_v")
    load(spark, d, "orders").createOrReplaceTempView(v)
    SF.register_big_orders(spark, v)
    return spark.sql("SELECT * FROM big_orders(400000.0)")


@case("udf_python", "SELECT c_custkey, upper(left(c_mktsegment, 3)) AS code, upper(left(c_mktsegment, 3)) AS code_sql "
      "FROM customer")
def udf_python(spark, d):
    U.register_python_udfs(spark)
    c = load(spark, d, "customer")
    return c.select("c_custkey", U.segment_code("c_mktsegment").alias("code"),
                    F.expr("segment_code(c_mktsegment)").alias("code_sql"))


@case("udf_pandas", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem""")
def udf_pandas(spark, d):
    li = load(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.round(U.net_price("l_extendedprice", "l_discount"), 4).alias("net"))


@case("udf_struct", """
SELECT l_orderkey AS o, l_linenumber, '****' || right(CAST(l_suppkey AS VARCHAR), 2) AS supplier_ref FROM lineitem""")
def udf_struct(spark, d):
    li = load(spark, d, "lineitem")
    tx = li.groupBy(F.col("l_orderkey").alias("o")).agg(
        F.collect_list(F.struct("l_linenumber", F.col("l_suppkey").cast("string").alias("supplier_ref"))).alias("items"))
    flat = tx.select("o", F.inline("items"))
    # native struct rewrite where possible; the leaf value goes through the pandas UDF
    s = flat.select("o", F.struct("l_linenumber", "supplier_ref").alias("it"))
    s = nested.rewrite_nested(s, {"it.supplier_ref": U.mask_account})
    return s.select("o", "it.l_linenumber", "it.supplier_ref")


@case("udf_broadcast", "SELECT c.c_custkey, n.n_name FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey")
def udf_broadcast(spark, d):
    n = load(spark, d, "nation")
    if not small_enough(n.select("n_nationkey", "n_name"), 100_000):  # beyond the bound the lookup is a join
        c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
        return with_lookup(c, "c_nationkey", n, "n_nationkey", "n_name", "n_name").select("c_custkey", "n_name")
    mapping = {r.n_nationkey: r.n_name for r in n.select("n_nationkey", "n_name").collect()}
    look = U.lookup_udf(spark, mapping)
    return load(spark, d, "customer").select("c_custkey", look("c_nationkey").alias("n_name"))


@case("udf_score", """
SELECT event_id, round(0.5 * value - 0.25 * CAST(user_id AS DOUBLE)
       + 0.01 * CAST(json_extract(props, '$.k') AS DOUBLE), 6) AS score FROM events""")
def udf_score(spark, d):
    e = load(spark, d, "events")
    k = F.from_json("props", "k DOUBLE")["k"]
    return e.select("event_id", F.round(U.score_col(F.col("value"), F.col("user_id").cast("double"), k), 6).alias("score"))


@case("procedure_job", """
SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1""")
def procedure_job(spark, d):
    """A stored-procedure-like job: parameters in, SQL scripting for control
    flow, a result table out."""
    from driftwood.operators.datasets import publish

    v = table_name("orders_p")
    load(spark, d, "orders").createOrReplaceTempView(v)
    res = spark.sql(f"""BEGIN
      DECLARE since TIMESTAMP_NTZ DEFAULT TIMESTAMP_NTZ '1998-01-01 00:00:00';
      SELECT o_orderstatus, count(*) AS n FROM {v} WHERE o_orderdate >= since GROUP BY o_orderstatus;
    END""")
    return spark.read.parquet(publish(res, workdir(spark, "procedure"), "status_counts"))


@case("side_counter", """
SELECT count(*) AS rows_written, count_if(o_orderstatus = 'F') AS fulfilled FROM orders""")
def side_counter(spark, d):
    obs = Observation("side")
    o = load(spark, d, "orders").observe(obs, F.count(F.lit(1)).alias("rows_written"),
                                         F.count_if(F.col("o_orderstatus") == "F").alias("fulfilled"))
    o.write.parquet(workdir(spark, "side_counter"))
    m = obs.get
    return spark.createDataFrame([(m["rows_written"], m["fulfilled"])], "rows_written long, fulfilled long")


@case("udtf_python", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word,
       CAST(generate_subscripts(string_split(p_name, ' '), 1) - 1 AS INT) AS pos FROM part""")
def udtf_python(spark, d):
    p = load(spark, d, "part")
    return p.select("p_partkey", "p_name").lateralJoin(U.Words(F.col("p_name").outer())).select(
        "p_partkey", "word", "pos")
