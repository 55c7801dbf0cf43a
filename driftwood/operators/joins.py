"""Join helpers: size-checked broadcast, range joins by bins, salted and
hot-key skew joins, as-of joins, nested-loop guards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood import constants as C


class TooLargeToBroadcast(ValueError):
    pass


#: bytes a side may have (as text) to be broadcast
MAX_BROADCAST_BYTES = 64 << 20


def small_enough(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes; reads no more than ``max_rows`` + 1 rows."""
    size = F.octet_length(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    return r["n"] <= max_rows and (r["b"] or 0) <= max_bytes


def broadcast_checked(df: DataFrame, max_rows: int = 1_000_000, fallback: bool = True) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows and MAX_BROADCAST_BYTES bytes.

    When the bound fails the side is returned unchanged (``fallback``) so the
    planner picks a shuffle join, or an error is raised.
    """
    if small_enough(df, max_rows):
        return F.broadcast(df)
    if fallback:
        return df
    raise TooLargeToBroadcast(f"more than {max_rows} rows or {MAX_BROADCAST_BYTES} bytes")


def cross_join_bounded(big: DataFrame, small: DataFrame, max_small_rows: int = 10_000) -> DataFrame:
    """Cartesian product. A side proven to hold at most ``max_small_rows`` rows is
    broadcast, so ``big`` is never shuffled; a larger one is paired with ``big`` partition by partition.
    """
    if small_enough(small, max_small_rows):
        return big.crossJoin(F.broadcast(small))
    return big.crossJoin(small.hint("shuffle_replicate_nl"))


def _bin(ts: str, seconds: int):
    return F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / F.lit(seconds)).cast("long")


def _levelled(points: DataFrame, x: Column, intervals: DataFrame, lo: Column, hi: Column, unit: float):
    """Both sides with ``__pl``/``__pb`` and ``__il``/``__ib``: level and bin.

    An interval lies at the level whose bins (``unit`` * 2**level wide) are at least as wide as itself, so it is
    copied to two bins or so however long it is; a point is copied to each level in use, at most one for
    each doubling of the length.
    """
    level = F.ceil(F.log2(F.greatest(hi - lo, F.lit(unit)) / F.lit(unit))).cast("int")
    iv = intervals.withColumn("__il", level)
    levels = sorted(r[0] for r in iv.select("__il").distinct().collect() if r[0] is not None)
    width = F.lit(float(unit)) * F.pow(F.lit(2.0), F.col("__il"))
    first, last = F.floor(lo / width).cast("long"), F.floor(hi / width).cast("long")
    iv = iv.withColumn("__ib", F.explode(F.when(last >= first, F.sequence(first, last))))
    pt = points.withColumn("__pl", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    return pt.withColumn("__pb", F.floor(x / (F.lit(float(unit)) * F.pow(F.lit(2.0), F.col("__pl")))).cast("long")), iv


def band_join(points: DataFrame, x: str, bands: DataFrame, lo: str, hi: str, max_small_rows: int = 10_000, unit: float = 1.0) -> DataFrame:
    """Points joined to the bands with ``lo <= x < hi``. Few bands are broadcast; many are joined by bins of
    their own widths (``unit``: the narrowest), never all against all."""
    inside = (F.col(x) >= F.col(lo)) & (F.col(x) < F.col(hi))
    if small_enough(bands, max_small_rows):
        return points.join(F.broadcast(bands), inside)
    pt, iv = _levelled(points, F.col(x).cast("double"), bands, F.col(lo).cast("double"), F.col(hi).cast("double"), unit)
    return pt.join(iv, (F.col("__pl") == F.col("__il")) & (F.col("__pb") == F.col("__ib")) & inside).drop("__pl", "__pb", "__il", "__ib")


def range_join_binned(points: DataFrame, ts: str, intervals: DataFrame, start: str, end: str,
                      bin_seconds: int, keys: tuple[tuple[str, str], ...] = (), max_small_rows: int = 10_000) -> DataFrame:
    """Points joined to the intervals that contain them (closed bounds).

    Intervals of up to ``bin_seconds`` go to the one or two time bins they touch, longer ones to
    bins of twice, four times, ... the width, so no interval is copied more than a few times. The
    equi-join on (keys, level, bin) is followed by the exact bound check. Each (point, interval)
    pair appears once because a point lives in one bin of a level. Pairs are only formed inside a bin, never
    across a whole key group.

    Without keys a bin of n points and m intervals makes some n * m pairs, so few bytes are much work: few intervals are
    broadcast, more are dealt over all shuffle partitions, which Spark would else join into a few by their bytes.
    """
    def seconds(c):
        return F.unix_seconds(F.col(c).cast("timestamp"))

    pt, iv = _levelled(points, seconds(ts), intervals, seconds(start), seconds(end), bin_seconds)
    cond = (pt["__pl"] == iv["__il"]) & (pt["__pb"] == iv["__ib"]) & (pt[ts] >= iv[start]) & (pt[ts] <= iv[end])
    for lk, rk in keys:
        cond = cond & (pt[lk] == iv[rk])
    if not keys:
        if small_enough(intervals, max_small_rows):
            iv = F.broadcast(iv)
        else:
            n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
            pt, iv = pt.repartition(n, "__pl", "__pb"), iv.repartition(n, "__il", "__ib")
    return pt.join(iv, cond, "inner").drop("__pl", "__pb", "__il", "__ib")


def interval_join(left: DataFrame, lkey: str, lts: str, right: DataFrame, rkey: str, rts: str,
                  seconds: int) -> DataFrame:
    """``right.rts BETWEEN left.lts AND left.lts + seconds`` on equal keys,
    binned on time so a busy key is not paired all-against-all."""
    lv = left.withColumn("__end", F.col(lts) + F.make_dt_interval(secs=F.lit(seconds)))
    out = range_join_binned(right, rts, lv, lts, "__end", bin_seconds=seconds, keys=((rkey, lkey),))
    return out.drop("__end")


def salted_join(big: DataFrame, bkey: str, small: DataFrame, skey: str, salts: int = 8,
                salt_by: Sequence[str] | None = None) -> DataFrame:
    """Skew-tolerant equi-join: the big side gets a deterministic salt in
    ``[0, salts)`` from a row hash (stable under task retries, unlike
    ``rand``); the small side is replicated once per salt. ``salt_by`` names the columns hashed
    (those that tell rows apart; all by default), so that the scan reads no others for it. The join is always
    shuffled: Spark's size estimate of the replicated side doesn't count the copies, and a broadcast holds them all in the driver."""
    b = big.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(c) for c in salt_by or big.columns]), F.lit(salts)))
    s = small.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return b.join(s.hint("merge"), (b[bkey] == s[skey]) & (b["__salt"] == s["__salt"])).drop("__salt")


# Runtime skew split as configured in the guides (values are Spark's names).
AQE_SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": C.AQE_SKEW_FACTOR,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": C.AQE_SKEW_THRESHOLD,
}


def hot_keys(df: DataFrame, key: str, min_share: float) -> list:
    """Keys holding at least ``min_share`` of the rows that have one; at most 1/min_share of them. Null is never one."""
    df = df.filter(F.col(key).isNotNull())
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.select(F.count(F.lit(1))).scalar()
    hot = counts.filter(F.col("n") >= total * F.lit(min_share)).select(key)
    limit = int(1 / min_share) + 1
    return [r[0] for r in hot.limit(limit).collect()]


def hot_key_join(big: DataFrame, bkey: str, small: DataFrame, skey: str, min_share: float = 0.01,
                 max_hot_rows: int = 1_000_000) -> DataFrame:
    """Declared-skew join: rows of hot keys join a broadcast slice of the small
    side (no shuffle of the hot rows), or by salts where that slice is not small; the rest takes a normal shuffle join."""
    keys = hot_keys(big, bkey, min_share)
    if not keys:
        return big.join(small, big[bkey] == small[skey])
    is_hot = F.col(bkey).isin(keys)
    small_hot = small.filter(F.col(skey).isin(keys))
    if small_enough(small_hot, max_hot_rows):
        hot = big.filter(is_hot).join(F.broadcast(small_hot), F.col(bkey) == F.col(skey))
    else:
        hot = salted_join(big.filter(is_hot), bkey, small_hot, skey)
    cold_small = small.filter(~F.col(skey).isin(keys))
    cold = big.filter(~is_hot | F.col(bkey).isNull()).join(cold_small, F.col(bkey) == cold_small[skey])
    return hot.unionByName(cold)


#: rows of the larger side that a bucket is meant to hold
BUCKET_ROWS = 4_000_000


def bucket_count(least: int, *sides: DataFrame, rows: int = BUCKET_ROWS) -> int:
    """Buckets for tables that are to be joined bucket by bucket: ``least``, or one for each ``rows`` rows of the larger table, so
    that a bucket's task stays the same size however large the tables are (Parquet tables are counted by their footers)."""
    return max(least, -(-max(s.count() for s in sides) // rows))


def write_bucketed(df: DataFrame, key: str, buckets: int, root: str, name: str, partition_by: str | None = None) -> str:
    """Write ``df`` as a bucketed, sorted Parquet table at ``root/name`` (in folders of ``partition_by``, if given); returns
    the table name. Two tables bucketed alike on the join key join without an
    Exchange. Rows go to their bucket's task first, so a folder has one file for each bucket."""
    import uuid

    table = f"{name}_{uuid.uuid4().hex[:8]}"
    w = (df.repartition(buckets, key) if partition_by else df).write
    w = w.partitionBy(partition_by) if partition_by else w
    (w.bucketBy(buckets, key).sortBy(key).format("parquet")
     .option("path", f"{root}/{name}").saveAsTable(table))
    return table


def session_with(spark, confs: dict[str, str]):
    """A session beside ``spark`` (same catalog tables) with settings of its own."""
    other = spark.newSession()
    for k, v in confs.items():
        other.conf.set(k, v)
    return other


#: a bucket of the key holds all of a (partition, key) pair, so the two sides' buckets meet without a shuffle
ALIGNED_CONF = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.session.timeZone": "UTC"}


def aligned_join(spark, left: str, right: str, on: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join of two catalog tables written by ``write_bucketed`` with equal partition columns and equal buckets, on pairs of
    columns that hold both; a filter on the partition prunes both sides."""
    s = session_with(spark, ALIGNED_CONF)
    a, b = s.table(left), s.table(right)
    cond = F.lit(True)
    for x, y in on:
        cond = cond & (a[x] == b[y])
    return a.join(b, cond)


def lookup_map(df: DataFrame, key: str, value: str, max_rows: int = 10_000):
    """A small key/value table as a literal map column (size proven first)."""
    if not small_enough(df.select(key, value), max_rows):
        raise TooLargeToBroadcast(f"lookup table above {max_rows} rows")
    pairs = df.select(key, value).collect()
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.create_map(*flat)


def with_lookup(df: DataFrame, col: str, table: DataFrame, key: str, value: str, name: str, max_rows: int = 10_000) -> DataFrame:
    """``df`` with ``name``: the ``value`` that ``table`` has for ``col`` (one row a key), else null. A small table is a
    literal map, a larger one is joined."""
    if small_enough(table.select(key, value), max_rows):
        return df.withColumn(name, F.element_at(lookup_map(table, key, value, max_rows), F.col(col)))
    return df.join(table.select(F.col(key).alias("__key"), F.col(value).alias(name)), F.col(col) == F.col("__key"), "left").drop("__key")


def asof_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str,
              right_tiebreak: str | None = None, bucket_seconds: int | None = None, null_safe: bool = False,
              partitions: int | None = None) -> DataFrame:
    """For each left row, the latest right row of the same key with
    ``right_ts <= left_ts`` (NULL columns when none). Ties on ``right_ts``
    go to the largest ``right_tiebreak``. NULL times match nothing; NULL keys
    match one another only when ``null_safe``. ``bucket_seconds`` is kept for callers of the
    bucketed form and has no effect.

    Both sides go through one range shuffle by (key, time): inside (key, partition) the last right row is carried
    forward, and a table with one row for each key and partition carries it on to the key's next partitions. A key that holds a
    third of the rows fills as many partitions as its rows need, whatever its times; no group is paired all-against-all.
    """
    from driftwood.operators.windows import _ranged, on_keys

    rcols = [c for c in right.columns if c != key]
    right = right.filter(F.col(right_ts).isNotNull())
    if not null_safe:
        right = right.filter(F.col(key).isNotNull())
    payload, row = F.struct(*rcols), F.struct(*left.columns)
    order = F.struct(right_tiebreak) if right_tiebreak else F.lit(None).cast("struct<none: int>")
    nothing = {"l": F.lit(None).cast(left.select(row.alias("r")).schema["r"].dataType), "p": F.lit(None).cast(right.select(payload.alias("r")).schema["r"].dataType),
               "o": F.lit(None).cast(right.select(order.alias("r")).schema["r"].dataType)}
    # of one time, right rows stand first, the largest tie-break last of them
    r = right.select(F.col(key).alias("__k"), F.col(right_ts).alias("__t"), F.lit(0).alias("__side"), order.alias("__o"), nothing["l"].alias("__l"), payload.alias("__p"))
    lrows = left.select(F.col(key).alias("__k"), F.col(left_ts).alias("__t"), F.lit(1).alias("__side"), nothing["o"].alias("__o"), row.alias("__l"), nothing["p"].alias("__p"))
    rows = _ranged(lrows.unionByName(r), ["__k"], ["__t", "__side", "__o"], True, partitions)
    w = Window.partitionBy("__k", "__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    merged = rows.withColumn("__in", F.last("__p", ignorenulls=True).over(w)).filter("__side = 1")
    last = rows.groupBy("__k", "__part").agg(F.max_by("__p", F.when(F.col("__side") == 0, F.col("__id"))).alias("__last"))
    wc = Window.partitionBy("__k").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("__k", "__part", F.last("__last", ignorenulls=True).over(wc).alias("__carry")).filter("__carry IS NOT NULL")
    out = on_keys(merged, carry, ["__k", "__part"], "left")
    best = F.coalesce(F.col("__in"), F.col("__carry"))
    return out.select("__l.*", *[best[c].alias(c) for c in rcols])
