"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

1. Sources share ``share`` of all words by weight; no target exceeds ``most`` times its source,
   and the excess is shared again among the others (water filling).
2. The mix has ``share`` * words / ``block`` blocks. Highest quotients w/1, w/3, w/5, ... give every
   source an integer number of blocks, and in the same way every shard of the source. A shard is
   the documents of a source with one remainder of a seeded hash: about ``shard_words`` words,
   so a hot source has many shards.
3. Within a shard the documents stand in seeded order and their words are cut into blocks of
   ``block`` words. Every block is taken quota // blocks times, and the rest of the quota goes to the
   blocks of lowest seeded hash.

Reruns agree: order, shards and blocks come from hashes of the rows. Defined cases: null or empty
text has size 0 and nothing is taken; a null source is a source of its own, last in order; repeated rows
count each; with no words at all every target is 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from driftwood.llm.store import stored
from driftwood.operators.windows import global_row_number, global_running_sums, keyed_row_number, on_keys

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: words of a block and of a shard
BLOCK, SHARD_WORDS = 32, 1 << 18
BUCKETS = 1024
PIECES = "array<struct<first: bigint, stop: bigint, times: bigint>>"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size -> the same with weight and target. One row per source; ranks and running sums come from range
    partitions, so many sources are no single task."""
    s = global_row_number(sizes.withColumn("__none", F.col("source").isNull()), ["__none", "source"], "__n")
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("__n") - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("limit", most * F.col("source_size")).withColumn("__by", F.col("limit") / F.col("weight"))
    # by limit per weight, the first sources are full; the rest share what is left at one level
    s = global_running_sums(s, ["__by", "__none", "source"], {"limit": ("__before", "__limits"), "weight": ("__lighter", "__weights"), "source_size": ("__smaller", "__all")})
    s = s.withColumn("level", (share * F.col("__all") - F.col("__before")) / (F.col("__weights") - F.col("__lighter")))
    s = s.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    # the level of the first open source in that order: a tied one's level counts it as full
    open_level = s.filter("NOT full").agg(F.min(F.struct("__by", "__none", "source", "level")).alias("o")).select("o.level").scalar()
    return s.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.coalesce(open_level, F.lit(0.0)) * F.col("weight"))).select("source", "source_size", "weight", "target")


def _with_sums(df: DataFrame, group: list[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with aggregates of each row's group: reduced on the map side and joined back, so a group of many rows is no single task."""
    if not group:
        return df.withColumns({name: df.select(x).scalar() for name, x in sums.items()})
    return on_keys(df, df.groupBy(*group).agg(*[x.alias(name) for name, x in sums.items()]), group)


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], weight: str, seats: str) -> DataFrame:
    """``parties`` with ``quota``: the group's ``seats`` go to the highest quotients weight / (2k - 1).

    With n parties of total weight w, the quotients that decide lie between w / (2 * (seats + n)) and
    w / (2 * (seats - n)), so seats above that range are given at once and at most 3n quotients compete.
    These are ranked by a histogram of BUCKETS parts; only those in the deciding part are sorted, over range partitions.
    Ties go to the party first in order (nulls last). Parties of weight 0 get nothing.
    """
    live = _with_sums(parties.filter(F.col(weight) > 0), group, {"__parties": F.count(F.lit(1)), "__sum": F.sum(F.col(weight).cast("double"))})
    low, high = F.greatest(F.lit(0.0), (F.col(seats) - F.col("__parties")) / F.col("__sum")), (F.col(seats) + F.col("__parties")) / F.col("__sum")
    # written, so that the bounds are the same numbers wherever they are used
    live = stored(live.withColumns({"__low": low, "__high": high}).drop("__parties", "__sum"), "mixing-parties")
    p = live.withColumns({"__sure": F.floor(F.col(weight) * F.col("__low") + 0.5).cast("long"), "__may": F.floor(F.col(weight) * F.col("__high") + 0.5).cast("long")})
    # a seat's price is the inverse quotient (2k - 1) / (2 * weight); the cheapest go first
    none = F.array().cast("array<bigint>")
    c = (p.withColumn("__k", F.explode(F.when(F.col("__may") > F.col("__sure"), F.sequence(F.col("__sure") + 1, F.col("__may"))).otherwise(none)))
         .withColumn("__price", (2 * F.col("__k") - 1) / (2.0 * F.col(weight)))
         .withColumn("__bin", F.least(F.lit(BUCKETS - 1), F.floor((F.col("__price") - F.col("__low")) / (F.col("__high") - F.col("__low")) * BUCKETS)).cast("int")))
    left = p.groupBy(*group).agg((F.first(seats) - F.sum("__sure")).alias("__left"))
    hist = c.groupBy(*group, "__bin").agg(F.count(F.lit(1)).alias("__in"))
    hist = on_keys(hist, left, group) if group else hist.withColumn("__left", left.scalar())
    # at most BUCKETS rows a group
    hg = W.partitionBy(*group).orderBy("__bin") if group else W.orderBy("__bin")
    hist = hist.withColumn("__room", F.greatest(F.lit(0), F.least("__in", F.col("__left") - (F.sum("__in").over(hg) - F.col("__in"))))).drop("__left")
    ranked = on_keys(c, hist, [*group, "__bin"]).filter("__room > 0")
    whole = ranked.filter("__room = __in")
    edge = ranked.filter("__room < __in").withColumns({f"__none{i}": F.col(x).isNull() for i, x in enumerate(party)})
    order = ["__price", *[y for i, x in enumerate(party) for y in (f"__none{i}", x)]]
    edge = keyed_row_number(edge, [*group, "__bin"], order, "__n").filter("__n <= __room")
    names = list(dict.fromkeys([*group, *party]))
    won = whole.select(*names).unionByName(edge.select(*names)).groupBy(*names).agg(F.count(F.lit(1)).alias("__won"))
    return on_keys(p, won, names, "left").select(*parties.columns, (F.col("__sure") + F.coalesce("__won", F.lit(0))).alias("quota"))


def _hash(x: np.ndarray, seed: int) -> np.ndarray:
    """Seeded 64-bit hash of integers."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def take(order: np.ndarray, sizes: np.ndarray, quota: int, block: int, most: int, seed: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]]]:
    """Words taken of each document of a shard, and the stretches (first word, end, times) they come from."""
    rank = np.lexsort((sizes, order))
    at = np.empty(len(sizes), np.int64)
    at[rank] = np.concatenate([[0], np.cumsum(sizes[rank])[:-1]])
    total = int(sizes.sum())
    n = -(-total // block)
    if not n:
        return np.zeros(len(sizes), np.int64), [[] for _ in sizes]
    quota = min(quota, most * n)
    times = np.full(n, quota // n, np.int64)
    times[np.argsort(_hash(np.arange(n), seed), kind="stable")[: quota % n]] += 1
    # words taken before each block, then at any word by interpolation inside its block
    edge = np.minimum(np.arange(n + 1) * block, total)
    upto = np.concatenate([[0], np.cumsum(times * np.diff(edge))])

    def before(x):
        b = np.minimum(x // block, n - 1)
        return upto[b] + times[b] * (x - edge[b])

    taken = before(at + sizes) - before(at)
    pieces = []
    for a, size in zip(at, sizes):
        out: list[tuple[int, int, int]] = []
        for b in range(a // block, -(-(a + size) // block)) if size else ():
            if times[b]:
                lo, hi = int(max(a, edge[b]) - a), int(min(a + size, edge[b + 1]) - a)
                if out and out[-1][1] == lo and out[-1][2] == times[b]:
                    out[-1] = (out[-1][0], hi, out[-1][2])
                else:
                    out.append((lo, hi, int(times[b])))
        pieces.append(out)
    return taken, pieces


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = 2, block: int = BLOCK,
        shard_words: int = SHARD_WORDS, seed: int = 7, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken and pieces (stretches of words and how often they are taken), a row for each row of ``docs``."""
    sized = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"),
                        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("h"))
    sized = stored(sized, "mixing-sizes")
    goals = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, float(most))
    goals = goals.withColumn("__seats", goals.select(F.round(F.sum("target") / block).cast("long")).scalar())
    seats = sainte_lague(goals, [], ["source"], "target", "__seats").select(F.col("source").alias("s"), F.col("quota").alias("blocks"))
    goals = goals.join(seats, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", F.coalesce("blocks", F.lit(0)).alias("blocks"))
    goals = stored(goals.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))), "mixing-sources")

    g = goals.select(F.col("source").alias("s"), "source_size", "target", "blocks", "shards")
    known = sized.join(g, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    # rows without words need no selection: they stay out of the shards, so a shard has at most as many rows as words
    placed = known.filter("size > 0").withColumn("shard", F.pmod(F.shiftrightunsigned("h", 1), F.col("shards")))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("words"), F.first("blocks").alias("blocks"))
    quotas = stored(sainte_lague(shards, ["source"], ["shard"], "words", "blocks").select("source", "shard", "quota"), "mixing-shards")
    q = quotas.select(F.col("source").alias("s"), F.col("shard").alias("k"), "quota")
    full = placed.join(q, F.col("source").eqNullSafe(F.col("s")) & (F.col("shard") == F.col("k")), "left").select(
        "doc_id", "source", "size", "source_size", "target", "shard", F.coalesce("quota", F.lit(0)).alias("quota"), "h")

    def pick(key, pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["size"].to_numpy(np.int64)
        order = _hash(pdf["h"].to_numpy(np.int64).view(np.uint64), seed)
        taken, pieces = take(order, sizes, int(pdf["quota"].iloc[0]), block, most, seed + int(key[1]))
        out = pdf[["doc_id", "source", "size", "source_size", "target"]].copy()
        out["taken"] = taken
        out["pieces"] = [[{"first": a, "stop": b, "times": t} for a, b, t in p] for p in pieces]
        return out

    kind = "doc_id bigint, source string, size bigint, source_size bigint, target double, taken bigint, pieces " + PIECES
    bare = known.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.array().cast(PIECES).alias("pieces"))
    return full.groupBy("source", "shard").applyInPandas(pick, kind).unionByName(bare)
