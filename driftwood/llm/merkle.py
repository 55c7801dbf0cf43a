"""Merkle manifest of a data set: a digest for each row, a tree of fan 3 for each group, and a tree of the groups' roots.

H is SHA-256 in lowercase hex of its inputs' concatenation. Every 3 consecutive nodes become their H (the last run has fewer, even
one) while a group has several. A group is numbered on range partitions and cut into blocks of 3**DEPTH leaves: a block
is a whole subtree, so windows over (group, block) never cut a run and a hot group fills many tasks.

Within a block, the node of level k stands on the row of its first leaf. Lag and lead by 3**k and 2 * 3**k, masked by the
node's slot and the length of its run, are its siblings; rows of first children hash the parents. All levels of a block share one
shuffle and sort. Blocks' roots are the leaves of the next phase, log(rows) / log(3**DEPTH) phases in all, each written to the
shared folder. On the way back the upper part of a path joins the rows by (group, block).

A path lists, level by level from the leaf to the root, the siblings to the ``left`` and ``right`` as concatenated digests.

Defined cases: a null field is ``-``, so it differs from an empty text; a null group is one of its own and comes first; null order values
come first; ties fall by leaf, and equal rows each have their leaf; an empty table has an empty manifest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwood.llm.store import stored
from driftwood.operators.windows import global_row_number, keyed_row_number, on_keys

FAN, DEPTH = 3, 6
PATH = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its size before it, so that fields cannot run into one another."""
    v = value.cast("string")
    return F.when(v.isNull(), "-").otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def _phase(nodes: DataFrame, group: Sequence[str], depth: int) -> DataFrame:
    """``nodes`` (group, pos from 0, node) with block, place in it, the siblings s0, s1, ... of its ancestors in the block
    (null where the group's tree has ended) and, on the block's first row, its root ``top``."""
    size = FAN**depth
    out = nodes.withColumns({"block": F.floor(F.col("pos") / size).cast("long"), "place": (F.col("pos") % size).cast("int"), "n0": F.col("node")})
    in_block = W.partitionBy(*group, "block").orderBy("place")
    for k in range(depth):
        step, here = FAN**k, F.col(f"n{k}")
        near = {f"{way.__name__}{m}": way(here, m * step).over(in_block) for way in (F.lag, F.lead) for m in (1, 2)}
        out = out.withColumns(near)
        slot = F.floor(F.col("place") / step) % FAN
        none = F.lit("")
        before = F.when(slot == 0, none).when(slot == 1, F.col("lag1")).otherwise(F.concat("lag2", "lag1"))
        after = F.when(slot == 0, F.concat(F.coalesce("lead1", none), F.coalesce("lead2", none))).when(slot == 1, F.coalesce("lead1", none)).otherwise(none)
        # one node is left only where the first leaf's has no neighbour
        many = (F.col("block") > 0) | (F.col("place") > 0) | F.col("lead1").isNotNull()
        out = out.withColumn(f"s{k}", F.when((F.col("place") % step == 0) & many, F.struct(before.alias("left"), after.alias("right"))))
        parent = F.when(many, digest(F.col(f"s{k}.left"), here, F.col(f"s{k}.right"))).otherwise(here)
        out = out.withColumn(f"n{k + 1}", F.when(F.col("place") % (step * FAN) == 0, parent)).drop(*near, f"n{k}")
    so_far = in_block.rowsBetween(W.unboundedPreceding, 0)
    # the last siblings set so far are those of the row's own ancestor
    out = out.withColumns({f"s{k}": F.last(f"s{k}", ignorenulls=True).over(so_far) for k in range(depth)})
    return out.withColumnRenamed(f"n{depth}", "top")


def _own(depth: int) -> Column:
    return F.filter(F.array(*[F.col(f"s{k}") for k in range(depth)]), lambda s: s.isNotNull())


def _upper(phase: DataFrame, group: Sequence[str], depth: int) -> DataFrame:
    """group, pos (a block's number), path and top: from every block's root to its group's root."""
    tops = phase.filter("place = 0").select(*group, F.col("block").alias("pos"), F.col("top").alias("node"))
    if (phase.agg(F.max("block").alias("b")).first()["b"] or 0) == 0:
        return tops.withColumn("path", F.array().cast(PATH)).withColumnRenamed("node", "top")
    return tree(tops, group, depth).drop("node")


def tree(nodes: DataFrame, group: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``nodes`` (group, pos from 0, node, others) with ``path`` to the group's root and the root, ``top``."""
    phase = stored(_phase(nodes, group, depth), "merkle-nodes")
    over = _upper(phase, group, depth).withColumnsRenamed({"pos": "block", "path": "above"})
    joined = on_keys(phase.drop("top"), over, [*group, "block"])
    return joined.select(*nodes.columns, F.concat(_own(depth), F.col("above")).alias("path"), "top")


def manifest(leaves: DataFrame, group: str, order: Sequence[str], depth: int = DEPTH) -> DataFrame:
    """``leaves`` (with a column ``leaf``) with ``subroot`` (its group's root), ``root`` and ``path``, the siblings from the leaf to the root."""
    numbered = keyed_row_number(stored(leaves, "merkle-leaves"), [group], [*order, "leaf"], "pos")
    nodes = numbered.withColumn("pos", F.col("pos") - 1).withColumn("node", F.col("leaf"))
    phase = stored(_phase(nodes, [group], depth), "merkle-nodes")
    over = stored(_upper(phase, [group], depth).withColumnsRenamed({"pos": "block", "path": "above", "top": "subroot"}), "merkle-blocks")

    # one row a group: their roots in order are the leaves of the last tree
    roots = over.filter("block = 0").select(group, F.col("subroot").alias("node"))
    roots = global_row_number(roots, [group], "pos").withColumn("pos", F.col("pos") - 1).withColumn("all", F.lit(0))
    last = tree(roots, ["all"], depth).select(group, F.col("path").alias("last"), F.col("top").alias("root"))
    over = on_keys(over, last, [group]).select(group, "block", "subroot", "root", F.concat("above", "last").alias("above"))
    joined = on_keys(phase.drop("top"), over, [group, "block"])
    return joined.select(*leaves.columns, "subroot", "root", F.concat(_own(depth), F.col("above")).alias("path"))


def proof(path: Column) -> Column:
    """The digest of all siblings on the way to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the siblings of ``path`` give."""
    return F.aggregate(path, start, lambda node, s: digest(s["left"], node, s["right"]))
