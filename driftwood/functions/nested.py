"""Nested-data helpers: map merge, nested field rewrite, JSON item flattening.

All are Column expressions or single DataFrame projections; nothing is
decoded row by row in Python.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ITEMS_SCHEMA = ("order_id BIGINT, items ARRAY<STRUCT<line: INT, product_id: BIGINT, "
                "quantity: DOUBLE, price: DOUBLE>>")


def map_merge_last_wins(*maps: Column) -> Column:
    """``map_concat`` where a key present in a later map overrides earlier ones.

    Plain ``map_concat`` raises on duplicate keys unless the session sets
    ``mapKeyDedupPolicy=LAST_WIN``; this form needs no session conf.
    """
    out = maps[0]
    for m in maps[1:]:
        later_keys = F.map_keys(m)
        out = F.map_concat(F.map_filter(out, lambda k, v: ~F.array_contains(later_keys, k)), m)
    return out


def rewrite_nested(df: DataFrame, struct_fields: Mapping[str, Callable[[Column], Column]] | None = None,
                   array_fields: Mapping[str, Mapping[str, Callable[[Column], Column]]] | None = None) -> DataFrame:
    """Rewrite leaves inside structs (``"a.b"``) and inside arrays of structs
    (``{"arr": {"field": fn}}``) without unpacking the rows."""
    for path, fn in (struct_fields or {}).items():
        top, rest = path.split(".", 1)
        df = df.withColumn(top, F.col(top).withField(rest, fn(F.col(path))))
    for arr, fields in (array_fields or {}).items():
        df = df.withColumn(arr, F.transform(F.col(arr), _element_updater(fields)))
    return df


def _element_updater(fields: Mapping[str, Callable[[Column], Column]]) -> Callable[[Column], Column]:
    # one-argument lambda: F.transform reads a two-argument one as (element, index)
    def upd(s: Column) -> Column:
        for f, fn in fields.items():
            s = s.withField(f, fn(s[f]))
        return s
    return upd


def flatten_order_items(df: DataFrame, json_col: str, schema: str = ITEMS_SCHEMA) -> DataFrame:
    """Parse an order JSON document and return one row per item."""
    parsed = df.select(F.from_json(F.col(json_col), schema).alias("__o"))
    return parsed.select("__o.order_id", F.inline("__o.items"))
