"""Connected components by alternating large-star and small-star steps, each a join and an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftwood.llm.store import stored


def _state(edges: DataFrame) -> tuple[int, int]:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"] or 0


def _large(e: DataFrame) -> DataFrame:
    """Every neighbour greater than a node is linked to the node's smallest neighbour (itself included)."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are linked to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: comparable, not null) -> one row (u, root) for each node that is not its component's smallest.

    Each round is written to the shared folder, so a lost executor costs one round at most.
    Edges leave each round with u > v; rounds end when one changes nothing.
    """
    e = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    state = _state(e)
    while state[0]:
        e = stored(_small(_large(e)), "components")
        last, state = state, _state(e)
        if state == last:
            break
    return e.select("u", F.col("v").alias("root"))
