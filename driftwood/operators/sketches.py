"""Mergeable column sketches: HyperLogLog for distinct counts, KLL for quantiles.

Sketches of a table's parts (days, files, loads) are rows of a table of their own: a new part adds its rows, and the
profile of any set of parts is a merge of theirs, without reading the parts again. Building them is one aggregate pass with a
map-side partial step and, unlike exact distinct counts, no copy of a row for each column.

Stated errors: a distinct count is within 3 * 1.04 / sqrt(2**LG_K) of the exact one (about 5% for 12) in 99 of 100
cases, a quantile's rank within 2% of the rows. Exact figures: ``relational.column_profile``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: log2 of the HyperLogLog registers, and the KLL sketch's accuracy parameter
LG_K, KLL_K = 12, 400


def _hashable(df: DataFrame, c: str) -> Column:
    """What the distinct sketch takes: whole numbers and text as they are, other types in their text form."""
    kind = df.schema[c].dataType
    return F.col(c) if isinstance(kind, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else F.col(c).cast("string")


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None, by: Sequence[str] = (), lg_k: int = LG_K, kll_k: int = KLL_K) -> DataFrame:
    """``by``, column_name, row_count, null_count, distinct_sketch and quantile_sketch (numbers only), a row for each part and column."""
    cols = [c for c in columns or df.columns if c not in by]
    aggs, parts = [F.count(F.lit(1)).alias("row_count")], []
    for i, c in enumerate(cols):
        number = isinstance(df.schema[c].dataType, T.NumericType)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"z{i}"), F.hll_sketch_agg(_hashable(df, c), F.lit(lg_k)).alias(f"d{i}"),
                 (F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(kll_k)) if number else F.lit(None).cast("binary")).alias(f"q{i}")]
        parts.append(F.struct(F.lit(c).alias("column_name"), F.col(f"z{i}").alias("null_count"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch")))
    wide = df.groupBy(*by).agg(*aggs)
    return wide.select(*by, "row_count", F.explode(F.array(*parts)).alias("s")).select(*by, "s.column_name", "row_count", "s.null_count", "s.distinct_sketch", "s.quantile_sketch")


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of several parts as those of one (for each ``by`` and column)."""
    return sketches.groupBy(*by, "column_name").agg(
        F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"), F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def profile(sketches: DataFrame, quantiles: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0)) -> DataFrame:
    """column_name, row_count, null_count, distinct_count and quantiles (null for other than numbers, or without any value)."""
    held = F.when(F.col("quantile_sketch").isNotNull() & (F.kll_sketch_get_n_double("quantile_sketch") > 0), F.col("quantile_sketch"))
    edges = F.kll_sketch_get_quantile_double(held, F.array(*[F.lit(float(q)) for q in quantiles]))
    return sketches.select("column_name", "row_count", "null_count", F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
                           F.when(held.isNotNull(), edges).alias("quantiles"))


def equi_height(sketches: DataFrame, bins: int = 10) -> DataFrame:
    """column_name, bin (from 1), lo, hi and height (rows, by the bins' equal share) of the number columns."""
    p = profile(sketches, [k / bins for k in range(bins + 1)]).filter("quantiles IS NOT NULL")
    b = F.explode(F.sequence(F.lit(1), F.lit(bins)))
    rows = (F.col("row_count") - F.col("null_count")) / F.lit(float(bins))
    out = p.select("column_name", "quantiles", rows.alias("height"), b.alias("bin"))
    return out.select("column_name", "bin", F.element_at("quantiles", F.col("bin")).alias("lo"), F.element_at("quantiles", F.col("bin") + 1).alias("hi"), "height")
