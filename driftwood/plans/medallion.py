"""Flagship case: bronze -> silver -> gold (Q10, with S14, Q02, F47, N09)."""

from __future__ import annotations

from driftwood.operators import medallion as m
from driftwood.plans.registry import case
from driftwood.tables import load

MEDALLION_SQL = """
WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         CAST(o_orderdate AS DATE) AS order_date
  FROM orders
  WHERE o_totalprice > 0 AND o_custkey IS NOT NULL AND o_orderstatus IN ('F','O','P')),
r AS (SELECT l_orderkey, SUM(l_extendedprice * (1 - l_discount)) AS rev FROM lineitem GROUP BY l_orderkey),
g AS (
  SELECT o.order_date, n.n_name, SUM(r.rev) AS revenue_raw, COUNT(*) AS n_orders,
         AVG(CAST(o.amount AS DOUBLE)) AS avg_amount_raw
  FROM o JOIN r ON r.l_orderkey = o.o_orderkey
         JOIN customer c ON c.c_custkey = o.o_custkey
         JOIN nation n ON n.n_nationkey = c.c_nationkey
  GROUP BY o.order_date, n.n_name)
SELECT order_date, n_name, ROUND(revenue_raw, 4) AS revenue, n_orders,
       ROUND(avg_amount_raw, 4) AS avg_amount,
       ROUND(SUM(revenue_raw) OVER (PARTITION BY n_name ORDER BY order_date
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_revenue
FROM g
"""


def medallion_gold(spark, d):
    silver = m.silver_orders(m.bronze(load(spark, d, "orders")))
    return m.gold_daily_nation(silver, load(spark, d, "lineitem"), load(spark, d, "customer"),
                               load(spark, d, "nation"))


case("medallion", MEDALLION_SQL)(medallion_gold)
