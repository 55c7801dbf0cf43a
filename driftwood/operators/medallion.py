"""Bronze -> silver -> gold chain over orders and line items.

bronze: rows as received plus file lineage.
silver: typed, validated (rules drop failing rows), one row per order.
gold:   daily revenue per nation with a running total.

Scale notes: line items are reduced to one row per order *before* the join to
orders, so the big shuffle carries one row per order instead of one per item,
and the join reuses that hash partitioning. Nations are a bounded dimension and
go through the size-checked broadcast. The running total is computed on the
small gold aggregate, never on the fact rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftwood.operators import quality
from driftwood.operators.joins import broadcast_checked
from driftwood.sources.lineage import with_lineage

SILVER_RULES = {
    "positive_amount": "o_totalprice > 0",
    "customer_present": "o_custkey IS NOT NULL",
    "known_status": "o_orderstatus IN ('F', 'O', 'P')",
}


def bronze(orders_scan: DataFrame) -> DataFrame:
    return with_lineage(orders_scan)


def silver_orders(bronze_orders: DataFrame, rules=SILVER_RULES) -> DataFrame:
    kept = quality.expect(bronze_orders, rules, action="drop")
    return kept.select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


def order_revenue(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))


def gold_daily_nation(silver: DataFrame, lineitem: DataFrame, customer: DataFrame,
                      nation: DataFrame) -> DataFrame:
    rev = order_revenue(lineitem)
    o = silver.join(rev, silver.o_orderkey == rev.l_orderkey, "inner")
    cust = customer.select("c_custkey", "c_nationkey")
    o = o.join(cust, o.o_custkey == cust.c_custkey, "inner")
    nat = broadcast_checked(nation.select("n_nationkey", "n_name"), max_rows=10_000)
    o = o.join(nat, o.c_nationkey == nat.n_nationkey, "inner")
    g = o.groupBy("order_date", "n_name").agg(
        F.sum("rev").alias("revenue_raw"),
        F.count(F.lit(1)).alias("n_orders"),
        F.avg(F.col("amount").cast("double")).alias("avg_amount_raw"),
    )
    w = Window.partitionBy("n_name").orderBy("order_date").rowsBetween(Window.unboundedPreceding, 0)
    return g.select(
        "order_date", "n_name",
        F.round("revenue_raw", 4).alias("revenue"),
        "n_orders",
        F.round("avg_amount_raw", 4).alias("avg_amount"),
        F.round(F.sum("revenue_raw").over(w), 4).alias("running_revenue"),
    )
