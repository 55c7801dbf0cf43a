"""Declared datasets: streaming tables, materialized views (full and
incremental refresh), dependency-ordered runs, views and table equality.

A dataset is a named function returning a DataFrame; the runner orders them
by declared dependencies and runs each as a normal Spark job. Publishing
writes a new directory per refresh and repoints the name (last writer wins).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.streaming.runner import read_sink, run_available_now


def streaming_table(spark: SparkSession, name: str, source_dir: str, fmt: str, schema: T.StructType,
                    query: Callable[[DataFrame], DataFrame], root: str, **reader_options) -> DataFrame:
    """Append-only table fed incrementally from a landing directory.

    Each refresh processes only files not seen by the checkpoint
    (``availableNow``) and appends to ``root/name``; returns the table.
    """
    s = spark.readStream.schema(schema).format(fmt).options(**reader_options).load(source_dir)
    run_available_now(query(s), f"{root}/{name}", f"{root}/_checkpoints/{name}")
    return read_sink(spark, f"{root}/{name}")


def publish(df: DataFrame, root: str, name: str, mode: str = "overwrite") -> str:
    """Write a new version directory and return its path (readers resolve the
    latest version once per read)."""
    path = f"{root}/{name}/v={uuid.uuid4().hex[:12]}"
    df.write.mode(mode).parquet(path)
    return path


def mv_full_refresh(spark: SparkSession, query: Callable[[], DataFrame], root: str, name: str) -> DataFrame:
    """Materialized view, full refresh: recompute and replace."""
    return spark.read.parquet(publish(query(), root, name))


# Aggregates whose partial states merge by the same function.
MERGEABLE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def mv_incremental(new_rows: DataFrame, stored: DataFrame | None, keys: Sequence[str],
                   aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Incremental refresh of a grouped view over an append-only source.

    ``aggs`` maps output name -> (function, input column) with function in
    sum / count / min / max. The new rows are aggregated alone and merged with
    the stored partials; averages are derived as sum / count by the reader.
    """
    exprs = []
    for out, (fn, colname) in aggs.items():
        if fn not in MERGEABLE:
            raise ValueError(f"{fn} is not incrementally mergeable: full refresh needed")
        base = F.count(F.col(colname)) if fn == "count" else getattr(F, fn)(colname)
        exprs.append(base.alias(out))
    delta = new_rows.groupBy(*keys).agg(*exprs)
    if stored is None:
        return delta
    both = stored.unionByName(delta)
    return both.groupBy(*keys).agg(*[MERGEABLE[fn](out).alias(out) for out, (fn, _) in aggs.items()])


def mv_refresh(new_rows: DataFrame, all_rows: DataFrame, stored: DataFrame | None, keys: Sequence[str],
               aggs: dict[str, tuple[str, str]], source_rewritten: bool = False) -> tuple[DataFrame, str]:
    """Choose the refresh kind the way the guides describe: incremental when
    the source only appended rows and every aggregate merges; full on the
    first run, after updates/deletes or a schema change in the source
    (``source_rewritten``), or for aggregates that do not merge. Returns
    (result, "incremental" | "full")."""
    mergeable = all(fn in MERGEABLE for fn, _ in aggs.values())
    if stored is None or source_rewritten or not mergeable:
        exprs = []
        for out, (fn, colname) in aggs.items():
            exprs.append((F.count(F.col(colname)) if fn == "count" else getattr(F, fn)(colname)).alias(out))
        return all_rows.groupBy(*keys).agg(*exprs), "full"
    if set(stored.columns) != set(keys) | set(aggs):
        return mv_refresh(new_rows, all_rows, None, keys, aggs)
    return mv_incremental(new_rows, stored, keys, aggs), "incremental"


@dataclass
class Dataset:
    name: str
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    kind: str = "table"  # table | view | streaming
    expectations: dict = field(default_factory=dict)


class DatasetGraph:
    """Decorator registry of datasets with a topological run."""

    def __init__(self):
        self.datasets: dict[str, Dataset] = {}

    def table(self, name: str | None = None, inputs: Sequence[str] = (), kind: str = "table",
              expect_or_drop: dict | None = None):
        def deco(fn):
            n = name or fn.__name__
            self.datasets[n] = Dataset(n, fn, tuple(inputs), kind, dict(expect_or_drop or {}))
            return fn
        return deco

    def view(self, name: str | None = None, inputs: Sequence[str] = ()):
        return self.table(name, inputs, kind="view")

    def order(self) -> list[str]:
        seen, out, stack = set(), [], set()

        def visit(n):
            if n in stack:
                raise ValueError(f"cycle at {n}")
            if n in seen:
                return
            stack.add(n)
            for i in self.datasets[n].inputs:
                if i in self.datasets:
                    visit(i)
            stack.discard(n)
            seen.add(n)
            out.append(n)

        for n in self.datasets:
            visit(n)
        return out

    def run(self, spark: SparkSession, root: str) -> dict[str, DataFrame]:
        from driftwood.operators import quality

        results: dict[str, DataFrame] = {}
        for n in self.order():
            ds = self.datasets[n]
            df = ds.fn(*[results[i] for i in ds.inputs])
            if ds.expectations:
                df = quality.expect(df, ds.expectations, action="drop")
            if ds.kind == "view":
                results[n] = df
            else:
                results[n] = spark.read.parquet(publish(df, root, n))
        return results


def tables_equal(a: DataFrame, b: DataFrame) -> DataFrame:
    """Equality check of two tables as one report row: counts and the
    multiset differences both ways (``exceptAll``)."""
    only_a = a.exceptAll(b).agg(F.count(F.lit(1)).alias("only_in_a"))
    only_b = b.exceptAll(a).agg(F.count(F.lit(1)).alias("only_in_b"))
    ca = a.select(F.count(F.lit(1))).scalar()
    cb = b.select(F.count(F.lit(1))).scalar()
    return only_a.select(ca.alias("count_a"), cb.alias("count_b"), "only_in_a",
                         only_b.select("only_in_b").scalar().alias("only_in_b")).withColumn(
        "equal", (F.col("only_in_a") == 0) & (F.col("only_in_b") == 0))
