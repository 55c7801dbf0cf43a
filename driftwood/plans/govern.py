"""Cases for governance operators.

The membership and tag tables are small policy tables built at run time
(the session user is a member of ``analysts`` only); the data read is always
the ``customer`` table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.functions import masks
from driftwood.operators import govern as G
from driftwood.plans.registry import case
from driftwood.session import workdir
from driftwood.tables import load


def members(spark):
    me = spark.range(1).select(F.current_user().alias("user_name"), F.lit("analysts").alias("group_name"))
    other = spark.range(1).select(F.lit("auditor@corp").alias("user_name"), F.lit("finance").alias("group_name"))
    return me.unionByName(other)


EMAIL = "'user' || CAST(c_custkey AS VARCHAR) || '@' || lower(c_mktsegment) || '.example.com'"


def customers(spark, d):
    c = load(spark, d, "customer")
    return c.withColumn("email", F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@"),
                                          F.lower("c_mktsegment"), F.lit(".example.com")))


@case("column_mask", f"""
SELECT c_custkey, NULL::DOUBLE AS c_acctbal, left({EMAIL}, 2) || '***@' || split_part({EMAIL}, '@', 2) AS email
FROM customer""")
def column_mask(spark, d):
    m = members(spark)
    finance = G.is_member(m, "finance")
    pol = G.Policy(masks={"c_acctbal": F.when(finance, F.col("c_acctbal")),
                          "email": F.when(finance, F.col("email")).otherwise(masks.mask_email("email"))})
    return G.secured_read(customers(spark, d), pol).select("c_custkey", "c_acctbal", "email")


@case("row_filter", """
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')""")
def row_filter(spark, d):
    m = members(spark)
    analysts = G.is_member(m, "analysts")
    pol = G.Policy(row_filter=F.when(analysts, F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
                   .otherwise(F.lit(False)))
    return G.secured_read(customers(spark, d), pol).select("c_custkey", "c_mktsegment")


@case("dynamic_view", """
SELECT c_custkey, c_name, CASE WHEN c_acctbal >= 5000 THEN 'high' ELSE 'standard' END AS balance_band
FROM customer WHERE c_nationkey < 10""")
def dynamic_view(spark, d):
    m = members(spark)
    c = customers(spark, d)
    analysts, finance = G.is_member(m, "analysts"), G.is_member(m, "finance")
    view = c.filter(F.when(finance, F.lit(True)).otherwise(F.col("c_nationkey") < 10)).select(
        "c_custkey", "c_name",
        F.when(finance, F.col("c_acctbal").cast("string"))
        .when(analysts, F.when(F.col("c_acctbal") >= 5000, "high").otherwise("standard")).alias("balance_band"))
    return view


@case("tag_mask", "SELECT c_custkey, 'REDACTED' AS c_name, NULL::DOUBLE AS c_acctbal, c_mktsegment FROM customer")
def tag_mask(spark, d):
    tags = spark.createDataFrame([("c_name", "pii", "true"), ("c_acctbal", "pii", "true"),
                                  ("c_mktsegment", "pii", "false")], "column_name string, tag string, value string")
    c = load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return G.secured_read(c, G.Policy(masks=G.tag_masks(c, tags)))


@case("share_export", """
SELECT c.c_custkey, c.c_name, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_regionkey = 1""")
def share_export(spark, d):
    c, n = load(spark, d, "customer"), load(spark, d, "nation")
    shared = c.join(n, c.c_nationkey == n.n_nationkey)
    path = G.share_export(shared, f"{workdir(spark, 'share')}/recipient_america", "n_regionkey = 1",
                          ["c_custkey", "c_name", "n_name"])
    return spark.read.parquet(path)


@case("mask_functions", f"""
SELECT c_custkey, left({EMAIL}, 2) || '***@' || split_part({EMAIL}, '@', 2) AS email,
       '***-**-' || right(lpad(CAST(c_custkey AS VARCHAR), 9, '0'), 4) AS ssn,
       CAST(floor(c_acctbal / 1000) * 1000 AS BIGINT) AS salary_band FROM customer""")
def mask_functions(spark, d):
    from driftwood.functions.sql_functions import register_mask_functions

    register_mask_functions(spark)
    customers(spark, d).createOrReplaceTempView("customers_masked_src")
    return spark.sql("""SELECT c_custkey, mask_email(email) AS email,
        mask_ssn(lpad(CAST(c_custkey AS STRING), 9, '0')) AS ssn, mask_salary(c_acctbal) AS salary_band
        FROM customers_masked_src""")
