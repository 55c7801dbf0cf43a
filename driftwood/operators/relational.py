"""Relational operators that need more than one DataFrame call.

Everything here is a DataFrame rewrite that Catalyst plans; no row reaches
the driver except bounded lists (hot keys, histogram edges).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------- projections

def with_columns_chain(df: DataFrame, layers: Sequence[dict[str, Column]]) -> DataFrame:
    """Dependent computed columns: each layer may use the columns of earlier
    layers; one ``withColumns`` (one Project) per layer."""
    for layer in layers:
        df = df.withColumns(layer)
    return df


# -------------------------------------------------------------- predicates

def sargable_year(col: str, year: int) -> Column:
    """``year(col) = y`` rewritten as a range the Parquet reader can push down."""
    lo = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (F.col(col) >= lo) & (F.col(col) < hi)


def sargable_scaled(col: str, factor: float, op: str, bound: float) -> Column:
    """``col * factor <op> bound`` rewritten as ``col <op'> bound / factor``."""
    if factor == 0:
        raise ValueError("factor 0")
    flip = {">": "<", ">=": "<=", "<": ">", "<=": ">=", "=": "="}
    o = op if factor > 0 else flip[op]
    return F.expr(f"`{col}` {o} {bound / factor!r}")


# ------------------------------------------------------------------ dedup

def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                  latest: bool = False) -> DataFrame:
    """Keep one row per key: the smallest (or largest) by ``order``.

    Uses ``min_by``/``max_by`` of the whole row, which plans a sort aggregate
    with a map-side partial step: a key holding a third of the rows is
    reduced on every mapper before the shuffle, instead of being sorted in
    one task as ``row_number() = 1`` would. ``order`` must be unique per key
    for a deterministic survivor.
    """
    cols = [c for c in df.columns]
    row = F.struct(*[F.col(c) for c in cols])
    ordc = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    pick = F.max_by(row, ordc) if latest else F.min_by(row, ordc)
    return df.groupBy(*keys).agg(pick.alias("__r")).select("__r.*")


# ------------------------------------------------------------- aggregation

def salted_agg(df: DataFrame, key: str, value: str, salts: int = 16) -> DataFrame:
    """Two-level sum/count/max: first on (key, salt), then on key.

    The first level spreads one hot key over ``salts`` reducers; the second
    level sees at most ``salts`` rows per key.
    """
    salt = F.pmod(F.xxhash64(key, value), F.lit(salts))  # only the columns at hand, so the scan stays narrow
    lvl1 = (df.withColumn("__salt", salt).groupBy(key, "__salt")
            .agg(F.sum(value).alias("s"), F.count(F.lit(1)).alias("n"), F.max(value).alias("m")))
    return lvl1.groupBy(key).agg(F.sum("s").alias("sum_value"), F.sum("n").alias("n_rows"),
                                 F.max("m").alias("max_value"))


def key_skew(df: DataFrame, key: str, top_pct: float = 1.0) -> DataFrame:
    """Share of rows held by the top ``top_pct`` percent of keys (exact).

    Works on the histogram of key counts (how many keys have each count),
    which is tiny compared with the key set (at most about sqrt(2 * rows)
    distinct counts), so its ranking window runs in one small task; the data
    is scanned once.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"))
    hist = per_key.groupBy("cnt").agg(F.count(F.lit(1)).alias("n_keys"))
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = Window.orderBy(F.desc("cnt")).rowsBetween(Window.unboundedPreceding, -1)
    h = (hist.withColumn("keys", F.sum("n_keys").over(everything))
         .withColumn("rows", F.sum(F.col("cnt") * F.col("n_keys")).over(everything))
         .withColumn("keys_before", F.coalesce(F.sum("n_keys").over(before), F.lit(0)))
         .withColumn("top_k", F.ceil(F.col("keys") * F.lit(top_pct / 100.0))))
    take = F.greatest(F.lit(0), F.least(F.col("n_keys"), F.col("top_k") - F.col("keys_before")))
    agg = h.agg(F.first("keys").alias("n_keys"), F.first("top_k").cast("bigint").alias("top_keys"),
                F.sum(take * F.col("cnt")).cast("bigint").alias("top_rows"), F.first("rows").alias("total_rows"))
    return agg.select(F.lit(key).alias("key_column"), "n_keys", "top_keys", "top_rows", "total_rows",
                      F.round(F.col("top_rows") * 100.0 / F.col("total_rows"), 4).alias("top_share_pct"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True,
                   rsd: float = 0.01) -> DataFrame:
    """One aggregate pass over all columns, unpivoted to one row per column.

    count, distinct, cardinality pct, nulls, min, max (as strings),
    average and max string length. Exact distinct counts are an aggregate of their own for each
    column, which moves that column's distinct values alone (together in one aggregate, Spark would
    expand every row once per column and sort the copies); ``exact=False`` uses
    HyperLogLog++ sketches (``rsd`` relative error) in the one pass, the
    choice for very wide or very large tables.
    """
    cols = list(columns or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        s = F.col(c).cast("string")
        aggs += [] if exact else [F.approx_count_distinct(F.col(c), rsd).alias(f"d{i}")]
        aggs += [
            F.count_if(F.col(c).isNull()).alias(f"z{i}"),
            F.min(F.col(c)).cast("string").alias(f"lo{i}"),
            F.max(F.col(c)).cast("string").alias(f"hi{i}"),
            F.avg(F.length(s)).alias(f"al{i}"),
            F.max(F.length(s)).alias(f"ml{i}"),
        ]
    wide = df.agg(*aggs)
    if exact:
        # distinct rows, then a count: Spark would merge count_distinct of several columns into one aggregate again
        wide = wide.select("*", *[df.select(F.col(c).alias("v")).distinct().select(F.count("v")).scalar().alias(f"d{i}") for i, c in enumerate(cols)])
    parts = ", ".join(f"'{c}', d{i}, z{i}, lo{i}, hi{i}, al{i}, ml{i}" for i, c in enumerate(cols))
    long = wide.selectExpr(
        "__n",
        f"stack({len(cols)}, {parts}) AS (column_name, distinct_count, null_count, min_value, "
        "max_value, avg_len, max_len)")
    return long.select(
        "column_name",
        F.col("__n").alias("row_count"),
        "distinct_count",
        F.round(F.col("distinct_count") * 100.0 / F.nullif(F.col("__n"), F.lit(0)), 4).alias("cardinality_pct"),
        "null_count", "min_value", "max_value",
        F.round("avg_len", 4).alias("avg_len"),
        F.col("max_len").cast("int").alias("max_len"),
    )


def equi_height_histogram(df: DataFrame, col: str, bins: int = 10, accuracy: int = 10000) -> DataFrame:
    """Equi-height histogram: bin edges from ``percentile_approx``, then per bin
    row count and distinct count. Edges are a bounded list (``bins`` + 1)."""
    qs = [i / bins for i in range(bins + 1)]
    edges = df.agg(F.percentile_approx(col, qs, accuracy).alias("e"))
    e = edges.select("e").scalar()
    b = F.least(F.greatest(
        F.expr(f"array_position(transform(e, x -> {col} <= x), true)") - 1, F.lit(1)), F.lit(bins))
    binned = df.select(col).filter(F.col(col).isNotNull()).withColumn("e", e).withColumn("bin", b)
    return (binned.groupBy("bin").agg(
        F.count(F.lit(1)).alias("height"), F.count_distinct(col).alias("ndv"),
        F.min(col).alias("lo"), F.max(col).alias("hi")))


# ---------------------------------------------------------------- windows

def total_over_all(df: DataFrame, agg: Column, name: str) -> DataFrame:
    """``agg OVER ()`` without the single-partition window: the aggregate runs
    as a scalar subquery (partial + final) and is attached to every row."""
    return df.withColumn(name, df.select(agg).scalar())


def moving_avg_days(df: DataFrame, part: str, day_col: str, value: str, days: int = 2,
                    name: str = "moving_avg") -> DataFrame:
    """Average over the last ``days`` calendar days (current included) per key; sums and counts of blocks of days, so
    a hot key spreads over the partitions it fills."""
    from driftwood.operators.windows import keyed_range_agg

    day_num = F.datediff(F.to_date(F.col(day_col)), F.lit("1970-01-01").cast("date"))
    both = keyed_range_agg(df.withColumn("__d", day_num.cast("long")), [part], "__d", days - 1, {"__s": (value, "sum"), "__n": (value, "count")})
    return both.withColumn(name, F.col("__s") / F.nullif(F.col("__n"), F.lit(0))).drop("__d", "__s", "__n")


# -------------------------------------------------------------- partitions

#: rows that a partition is meant to hold
PARTITION_ROWS = 4_000_000


def partition_count(df: DataFrame, least: int, rows: int = PARTITION_ROWS) -> int:
    """Partitions for ``df``: ``least``, or one for each ``rows`` rows (a Parquet table is counted by its footers), so that a
    task's share doesn't grow with the table."""
    return max(least, -(-df.count() // rows))


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per physical partition, as a DataFrame (no mapPartitions)."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(
        F.count(F.lit(1)).alias("rows"))
