"""SQL user functions (temporary, session-scoped): scalar masks, a tier
function and a table function. They are SQL bodies, inlined by Catalyst like
any expression, so they stay JVM-side."""

from __future__ import annotations

from pyspark.sql import SparkSession

MASK_FUNCTIONS = {
    "mask_email": "CREATE OR REPLACE TEMPORARY FUNCTION mask_email(e STRING) RETURNS STRING "
                  "RETURN concat(left(e, 2), '***@', split_part(e, '@', 2))",
    "mask_ssn": "CREATE OR REPLACE TEMPORARY FUNCTION mask_ssn(s STRING) RETURNS STRING "
                "RETURN concat('***-**-', right(s, 4))",
    "mask_salary": "CREATE OR REPLACE TEMPORARY FUNCTION mask_salary(x DOUBLE) RETURNS BIGINT "
                   "RETURN CAST(floor(x / 1000) * 1000 AS BIGINT)",
}


def register_mask_functions(spark: SparkSession) -> None:
    for ddl in MASK_FUNCTIONS.values():
        spark.sql(ddl)


def register_tier_function(spark: SparkSession) -> None:
    spark.sql("""CREATE OR REPLACE TEMPORARY FUNCTION customer_tier(bal DOUBLE) RETURNS STRING
      RETURN CASE WHEN bal >= 8000 THEN 'VIP' WHEN bal >= 5000 THEN 'Premium'
                  WHEN bal >= 0 THEN 'Standard' ELSE 'Inactive' END""")


def register_big_orders(spark: SparkSession, view: str) -> None:
    """Table function over a registered view: orders above a price."""
    spark.sql(f"""CREATE OR REPLACE TEMPORARY FUNCTION big_orders(min_price DOUBLE)
      RETURNS TABLE (o_orderkey BIGINT, o_totalprice DOUBLE)
      RETURN SELECT o_orderkey, o_totalprice FROM {view} WHERE o_totalprice > min_price""")
