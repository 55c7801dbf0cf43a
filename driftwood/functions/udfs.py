"""Python user functions, used only where a built-in expression cannot say it.

Row-at-a-time ``udf`` exists for parity but the vectorised forms (pandas
UDF, iterator pandas UDF, Python UDTF) are what the library uses: Arrow
batches cross the JVM/Python boundary, not single rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udtf


def segment_code_py(seg):
    # plain (unannotated) function: a row-at-a-time Python UDF
    return None if seg is None else seg[:3].upper()


segment_code = F.udf(segment_code_py, T.StringType())


def register_python_udfs(spark: SparkSession) -> None:
    spark.udf.register("segment_code", segment_code_py, T.StringType())


@F.pandas_udf(T.DoubleType())
def net_price(price: pd.Series, discount: pd.Series) -> pd.Series:
    return price * (1.0 - discount)


@F.pandas_udf(T.StringType())
def mask_account(v: pd.Series) -> pd.Series:
    """Leaf-value transform for nested rewrites: keep the last two characters."""
    return "****" + v.str[-2:]


def lookup_udf(spark: SparkSession, mapping: dict, return_type=T.StringType()):
    """Pandas UDF closing over a broadcast dict (the dict is bounded by the caller)."""
    b = spark.sparkContext.broadcast(mapping)

    @F.pandas_udf(return_type)
    def look(keys: pd.Series) -> pd.Series:
        m = b.value
        return keys.map(lambda k: m.get(k))

    return look


# Fixed model weights of the deterministic linear stand-in scorer.
SCORE_WEIGHTS = (0.5, -0.25, 0.01)


@F.pandas_udf(T.DoubleType())
def linear_score(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Iterator pandas UDF: the 'model' is loaded once per task, then applied
    to every Arrow batch."""
    w0, w1, w2 = SCORE_WEIGHTS
    for a, b, c in batches:
        yield w0 * a + w1 * b + w2 * c


@udtf(returnType="word: string, pos: int")
class Words:
    """Python table function: one row per word of a short label."""

    def eval(self, text: str):
        if text is None:
            return
        for i, w in enumerate(text.split(" ")):
            yield w, i


def score_col(a: Column, b: Column, c: Column) -> Column:
    return linear_score(a, b, c)
