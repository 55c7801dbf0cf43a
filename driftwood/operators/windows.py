"""Window operators that stay parallel when one key is hot or when the
window has no PARTITION BY.

Spark evaluates ``f() OVER (PARTITION BY k ORDER BY t)`` by clustering each
``k`` into one task, and ``OVER (ORDER BY t)`` with no partition in a single
task. The helpers below compute the same values with bounded work per task:

* ``global_row_number`` / ``global_ntile`` / ``keyed_row_number``: one range shuffle by
  (keys, order), written once; rows are numbered inside their range partition and
  shifted by the sizes of the key's earlier ones from a small count table;
  ``keyed_shift`` (lag/lead) and ``keyed_rank`` build on it with equi-joins.
* ``running_sum``: prefix sums inside (key, range partition) plus the carried total
  of the key's earlier partitions.
* ``partition_agg``: aggregate per key (map-side partial) joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftwood.session import stored


def _ranged(df: DataFrame, keys: Sequence[str], order: Sequence[str], ascending: bool, partitions: int | None) -> DataFrame:
    """``df`` in (keys, order) order over range partitions, written once to the shared folder, with ``__part``
    (its partition) and ``__id`` (rises by one from row to row of a partition).

    One shuffle whatever the types of the columns. A hash of the row ends the order, so neither a hot key nor
    a value tied in the whole order column is bound to one partition; what is read back never changes, so
    parts of a plan that are computed apart agree on it.
    """
    hashed = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    by = [F.col(k).asc_nulls_first() for k in keys] + _orders(order, ascending) + [F.xxhash64(*hashed).asc()]
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rows = stored(spread.sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id()), "ranged")
    return rows.withColumn("__part", F.shiftright("__id", 33))


def on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL, as a window's partitions have it."""
    named = right.withColumnsRenamed({k: f"__j{i}" for i, k in enumerate(keys)})
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__j{i}"))
    return left.join(named, cond, how).drop(*[f"__j{i}" for i in range(len(keys))])


def _offsets(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For each (keys, partition) of ``_ranged`` rows: ``__off``, which makes ``__id`` the row number within the
    key, and ``__total``, the key's row count. A key has at most one row a partition here."""
    counts = rows.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__id").alias("__first"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    out = counts.select(*keys, "__part", (F.coalesce(F.sum("__cnt").over(before), F.lit(0)) + 1 - F.col("__first")).alias("__off"),
                        F.sum("__cnt").over(key).alias("__total"))
    return out if keys else F.broadcast(out)  # without keys: one row a partition


def _numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], ascending: bool,
             partitions: int | None, with_total: bool = False) -> DataFrame:
    """Adds ``__rn``: the row number within ``keys`` in ``order`` (and ``__total``, the key's row count, when ``with_total``)."""
    rows = _ranged(df, keys, order, ascending, partitions)
    out = on_keys(rows, _offsets(rows, keys), [*keys, "__part"]).withColumn("__rn", F.col("__id") + F.col("__off"))
    return out.drop("__id", "__part", "__off", *([] if with_total else ["__total"]))


def global_row_number(df: DataFrame, order: Sequence[str], name: str = "rn",
                      partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` without a single-task window:
    rows are numbered inside range partitions and shifted by the sizes of earlier
    ones. Ties in ``order`` fall by a hash of the row."""
    return _numbers(df, [], order, True, partitions).withColumnRenamed("__rn", name)


def global_ntile(df: DataFrame, buckets: int, order: Sequence[str], name: str = "ntile") -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY order)`` with the standard bucket sizes:
    the first ``N % buckets`` buckets hold one extra row. ``N`` comes from the
    per-partition count table, so the input is not scanned again for it."""
    numbered = _numbers(df, [], order, True, None, with_total=True)
    total = F.col("__total")
    base = F.floor(total / F.lit(buckets))
    rem = total - base * F.lit(buckets)
    big = (base + 1) * rem
    rn = F.col("__rn")
    nt = F.when(rn <= big, F.floor((rn - 1) / (base + 1)) + 1).otherwise(
        F.floor((rn - 1 - rem) / F.greatest(base, F.lit(1))) + 1)
    return numbered.withColumn(name, nt.cast("int")).drop("__rn", "__total")


def running_sum(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, name: str = "running",
                partitions: int | None = None) -> DataFrame:
    """``sum(value) OVER (PARTITION BY key ORDER BY ts, tiebreak ROWS UNBOUNDED
    PRECEDING)`` computed as (prefix inside the (key, range partition) group) + (total of
    the key's earlier partitions), so a hot key spreads over the partitions it fills."""
    rows = _ranged(df, [key], [ts, tiebreak], True, partitions)
    inner = Window.partitionBy(key, "__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumn("__in", F.sum(value).over(inner))
    totals = rows.groupBy(key, "__part").agg(F.sum(value).alias("__tot"))
    prev = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.withColumn("__carry", F.sum("__tot").over(prev)).drop("__tot")
    both = F.coalesce(F.col("__carry") + F.col("__in"), F.col("__carry"), F.col("__in"))
    return on_keys(summed, carry, [key, "__part"]).withColumn(name, both).drop("__id", "__part", "__in", "__carry")


def global_running_sums(df: DataFrame, order: Sequence[str], sums: dict[str, tuple[str, str]], partitions: int | None = None) -> DataFrame:
    """For each ``value: (name, total)`` of ``sums``: ``sum(value) OVER (ORDER BY order ROWS BETWEEN UNBOUNDED PRECEDING AND
    1 PRECEDING)`` as ``name``, 0 in the first row, and the sum of all rows as ``total``, without a single-task window."""
    rows = _ranged(df, [], order, True, partitions)
    inner = Window.partitionBy("__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, -1)
    prev = Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    at = list(enumerate(sums.items()))
    carry = (rows.groupBy("__part").agg(*[F.sum(v).alias(f"__sum{i}") for i, (v, _) in at])
             .select("__part", *[F.sum(f"__sum{i}").over(prev).alias(f"__carry{i}") for i, _ in at],
                     *[F.sum(f"__sum{i}").over(Window.partitionBy()).alias(total) for i, (_, (_, total)) in at]))
    out = rows.withColumns({f"__in{i}": F.sum(v).over(inner) for i, (v, _) in at}).join(F.broadcast(carry), "__part")  # one row a partition
    both = {name: F.coalesce(f"__in{i}", F.lit(0)) + F.coalesce(f"__carry{i}", F.lit(0)) for i, (_, (name, _)) in at}
    return out.withColumns(both).drop("__id", "__part", *[f"__{x}{i}" for i, _ in at for x in ("in", "carry")])


def running_max(df: DataFrame, order: Sequence[str], value: str, name: str, partitions: int | None = None) -> DataFrame:
    """``max(value) OVER (ORDER BY order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)`` without a single-task window."""
    rows = _ranged(df, [], order, True, partitions)
    inner = Window.partitionBy("__part").orderBy("__id").rowsBetween(Window.unboundedPreceding, -1)
    prev = Window.partitionBy().orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy("__part").agg(F.max(value).alias("__top")).withColumn("__carry", F.max("__top").over(prev)).drop("__top")
    out = rows.withColumn("__in", F.max(value).over(inner)).join(F.broadcast(carry), "__part")  # one row a partition
    return out.withColumn(name, F.greatest("__in", "__carry")).drop("__id", "__part", "__in", "__carry")


def partition_agg(df: DataFrame, keys: Sequence[str], agg: Column, name: str) -> DataFrame:
    """``agg OVER (PARTITION BY keys)`` as aggregate + join back: the aggregate
    has a map-side partial step. The per-key table's size decides at run time whether
    it is broadcast (the session's byte threshold); a shuffled hot key is split by AQE's skew join."""
    per_key = df.groupBy(*keys).agg(agg.alias(name)).select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], name)
    cond = None
    for i, k in enumerate(keys):  # null-safe: the NULL key is a group too
        c = df[k].eqNullSafe(per_key[f"__k{i}"])
        cond = c if cond is None else cond & c
    out = df.join(per_key, cond, "left")
    return out.drop(*[f"__k{i}" for i in range(len(keys))])


# ------------------------------------------------------------ per-key ordered windows

def _orders(order: Sequence[str], ascending: bool):
    return [F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last() for c in order]


def keyed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                     ascending: bool = True, partitions: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY keys ORDER BY order)`` that stays
    parallel when one key holds a large share of the rows.

    Rows are numbered inside (key, range partition) and shifted by the sizes of
    the key's earlier partitions. Ties in ``order`` fall by a hash of the row.
    NULL keys are one key, NULL order values come first, as in the plain window.
    """
    return _numbers(df, keys, order, ascending, partitions).withColumnRenamed("__rn", name)


def keyed_shift(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str], offset: int = 1,
                default=None, partitions: int | None = None) -> DataFrame:
    """``lag`` (offset > 0) or ``lead`` (offset < 0) of ``cols`` ({source: output})
    per key, by grouping on (key, position): positions come from
    ``keyed_row_number``, so no key is sorted in a single task."""
    numbered = keyed_row_number(df, keys, order, "__rn", partitions=partitions)
    # every row stands at its own position and, with the shifted columns only, at the one it shifts to:
    # the numbering is used once, so ties cannot fall differently on the two sides
    row = F.struct(*[F.col(c) for c in df.columns])
    shifted = F.struct(*[F.col(c).alias(o) for c, o in cols.items()])
    both = numbered.select(*keys, F.explode(F.array(
        F.struct(F.col("__rn").alias("p"), row.alias("r"), F.lit(None).cast(df.select(shifted.alias("s")).schema["s"].dataType).alias("s")),
        F.struct((F.col("__rn") + F.lit(offset)).alias("p"), F.lit(None).cast(df.select(row.alias("r")).schema["r"].dataType).alias("r"), shifted.alias("s")))).alias("__e"))
    met = both.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)], F.col("__e.p")).agg(
        F.first("__e.r", ignorenulls=True).alias("__r"), F.first("__e.s", ignorenulls=True).alias("__s"))
    out = met.filter("__r IS NOT NULL").select("__r.*", *[F.col(f"__s.{o}").alias(o) for o in cols.values()])
    if default is not None:
        out = out.fillna({o: default for o in cols.values()})
    return out


def keyed_rank(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rank",
               ascending: bool = True, dense: bool = False, partitions: int | None = None) -> DataFrame:
    """``rank()`` / ``dense_rank()`` per key without a per-key sort in one task.

    rank = smallest row number among the rows tied on ``order``; dense_rank =
    row number of the distinct ``order`` values. Both are worked out on a table with one row
    for each tie group and range partition, and joined back on these, so a hot tie group
    stays spread over the partitions it fills.
    """
    cols = [*keys, *order]
    rows = _ranged(df, keys, order, ascending, partitions)
    ties = rows.groupBy(*cols, "__part").agg(F.min("__id").alias("__least"))
    if dense:
        values = keyed_row_number(ties.select(*cols).distinct(), keys, order, name, ascending, partitions)
        ranks = on_keys(ties.drop("__least"), values, cols)
    else:
        numbered = on_keys(ties, _offsets(rows, keys).drop("__total"), [*keys, "__part"])
        least = F.min(F.col("__least") + F.col("__off")).over(Window.partitionBy(*cols))
        ranks = numbered.withColumn(name, least).drop("__least", "__off")
    return on_keys(rows, ranks, [*cols, "__part"]).drop("__id", "__part")


def keyed_rows_frame(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, lo: int, hi: int,
                     agg: str = "avg", name: str = "frame_value", partitions: int | None = None) -> DataFrame:
    """``agg(value) OVER (PARTITION BY keys ORDER BY order ROWS BETWEEN lo AND hi)`` (``lo`` <= 0 <= ``hi``; agg: sum, avg
    or count) as a difference of two prefix sums, so no row is copied and a hot key spreads over the partitions it fills.

    The prefix ``hi`` rows ahead and ``1 - lo`` rows back come from lead and lag inside (key, partition); rows near a
    partition's edge look them up among the few rows that the key has at the edges of its partitions. Prefix sums of doubles round at the size of the key's
    total. Frames that hold null values only are null, as in the plain window (a count is 0).
    """
    if agg not in ("sum", "avg", "count"):
        raise ValueError("sum, avg or count")
    rows = _ranged(df, keys, order, True, partitions)
    inner = Window.partitionBy(*keys, "__part").orderBy("__id")
    so_far = inner.rowsBetween(Window.unboundedPreceding, 0)
    v, back, ahead = F.col(value), 1 - lo, hi
    sums = rows.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__cnt"), F.min("__id").alias("__first"), F.sum(v).alias("__s"), F.count(v).alias("__c"))
    key = Window.partitionBy(*keys)
    before = key.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    carried = sums.select(*keys, "__part", F.coalesce(F.sum("__s").over(before), zero).alias("__s0"), F.coalesce(F.sum("__c").over(before), zero).alias("__c0"),
                          (F.coalesce(F.sum("__cnt").over(before), zero) + 1 - F.col("__first")).alias("__off"), F.sum("__cnt").over(key).alias("__total"),
                          (F.coalesce(F.sum("__cnt").over(before), zero) + F.col("__cnt")).alias("__last"), F.count(zero).over(key).alias("__parts"), "__cnt")
    p = on_keys(rows, carried, [*keys, "__part"]).withColumn("__rn", F.col("__id") + F.col("__off"))
    p = p.withColumn("__p", F.struct((F.coalesce(F.sum(v).over(so_far), zero) + F.col("__s0")).alias("s"), (F.count(v).over(so_far) + F.col("__c0")).alias("c")))
    p = p.withColumns({"__a": F.lag("__p", back).over(inner), "__z": F.lead("__p", ahead).over(inner) if ahead else F.col("__p")})
    p = p.withColumns({"__need_a": F.col("__rn") - back, "__need_z": F.least(F.col("__rn") + ahead, F.col("__total"))})
    # only keys in several partitions have rows whose frame crosses an edge
    here = F.col("__rn") - F.col("__last") + F.col("__cnt")
    edge = p.filter("__parts > 1").filter((here <= max(1, ahead)) | (F.col("__last") - F.col("__rn") < back) | (F.col("__rn") == F.col("__total")))
    edge = edge.select(*keys, F.col("__rn").alias("__at"), F.col("__p").alias("__q"))
    ends = on_keys(p, edge.filter("__q IS NOT NULL").withColumnsRenamed({"__at": "__need_a", "__q": "__qa"}), [*keys, "__need_a"], "left")
    ends = on_keys(ends, edge.withColumnsRenamed({"__at": "__need_z", "__q": "__qz"}), [*keys, "__need_z"], "left")
    # a frame that ends behind the key's last row ends there; in one partition that is the last prefix
    last = F.struct((F.sum(v).over(Window.partitionBy(*keys, "__part")) + F.col("__s0")).alias("s"), (F.count(v).over(Window.partitionBy(*keys, "__part")) + F.col("__c0")).alias("c"))
    to = F.coalesce(F.col("__z"), F.col("__qz"), last)
    start = F.coalesce(F.col("__a"), F.col("__qa"))
    ends = ends.withColumns({"__to": to, "__from": start})
    count = F.col("__to.c") - F.coalesce("__from.c", zero)
    total = F.col("__to.s") - F.coalesce("__from.s", zero)
    out = count if agg == "count" else F.when(count > 0, total if agg == "sum" else total / count)
    return ends.select(*df.columns, out.alias(name))


_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_FIRST = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def keyed_range_agg(df: DataFrame, keys: Sequence[str], at: str, preceding: int, aggs: dict[str, tuple[str, str]],
                    partitions: int | None = None) -> DataFrame:
    """``agg(column) OVER (PARTITION BY keys ORDER BY at RANGE BETWEEN preceding PRECEDING AND CURRENT ROW)`` for each
    ``aggs`` entry (name -> (column, sum | count | min | max)); ``at`` and ``preceding`` are integers.

    Block decomposition, which needs no inverse: the line is cut into blocks of ``preceding`` + 1, so that a frame is the end of
    one block and the beginning of the next. Rows of one place are one row first (a partial aggregate). Each place t and each frame start
    t - preceding are rows of one range shuffle by (keys, place); inside (key, block, partition) a running aggregate forward
    gives the beginnings, one backward the ends, and a table with one row for each such group carries both across the block's partitions. So neither
    a hot key nor a hot block of it is one task. Rows without a place are peers of one another, as in the plain window.
    """
    places = df.groupBy(*keys, at).agg(*[_FIRST[how](c).alias(n) for n, (c, how) in aggs.items()])
    names = list(aggs)
    none = {n: F.lit(None).cast(places.schema[n].dataType).alias(n) for n in names}
    here = places.select(*keys, F.col(at).alias("__t"), F.lit(1).alias("__side"), F.col(at).alias("__of"), *names)
    # a frame's start stands before the rows of its place
    starts = places.select(*keys, (F.col(at) - preceding).alias("__t"), F.lit(0).alias("__side"), F.col(at).alias("__of"), *none.values())
    rows = _ranged(here.unionByName(starts), keys, ["__t", "__side"], True, partitions)
    block = F.floor(F.col("__t") / (preceding + 1))
    rows = rows.withColumn("__block", block)
    group = Window.partitionBy(*keys, "__block", "__part")
    up = group.orderBy("__id").rowsBetween(Window.unboundedPreceding, 0)
    down = group.orderBy(F.desc("__id")).rowsBetween(Window.unboundedPreceding, 0)
    combine = {n: _COMBINE[how] for n, (_, how) in aggs.items()}
    total = rows.groupBy(*keys, "__block", "__part").agg(*[combine[n](n).alias(n) for n in names])
    parts = Window.partitionBy(*keys, "__block").orderBy("__part")
    carry = total.select(*keys, "__block", "__part",
                         *[combine[n](n).over(parts.rowsBetween(Window.unboundedPreceding, -1)).alias(f"__up_{n}") for n in names],
                         *[combine[n](n).over(parts.rowsBetween(1, Window.unboundedFollowing)).alias(f"__down_{n}") for n in names])
    run = rows.select("*", *[combine[n](n).over(up).alias(f"__in_{n}") for n in names], *[combine[n](n).over(down).alias(f"__out_{n}") for n in names])
    run = on_keys(run, carry, [*keys, "__block", "__part"])
    first = F.col("__side") == 1
    # the frame's start lies in the block before, or in the same one, whose beginning is the whole frame then
    same = F.floor(F.col("__of") / (preceding + 1)) == F.col("__block")
    parts_of = []
    for n in names:
        parts_of += [F.when(first, F.col(f"__in_{n}")).when(~same, F.col(f"__out_{n}")).alias(n), F.when(first, F.col(f"__up_{n}")).when(~same, F.col(f"__down_{n}")).alias(f"__c_{n}")]
    run = run.select(*keys, "__of", *parts_of)
    frames = run.groupBy(*keys, "__of").agg(*[x for n in names for x in (combine[n](n).alias(n), combine[n](f"__c_{n}").alias(f"__c_{n}"))])
    both = {n: _two(aggs[n][1], F.col(n), F.col(f"__c_{n}")) for n in names}
    frames = frames.select(*keys, F.col("__of").alias(at), *[both[n].alias(n) for n in names])
    return on_keys(df, frames, [*keys, at])


def _two(how: str, a: Column, b: Column) -> Column:
    """Two partial results, either null where there is none."""
    if how in ("sum", "count"):
        return F.coalesce(a + b, a, b)
    better = a <= b if how == "min" else a >= b
    return F.when(a.isNull(), b).when(b.isNull() | better, a).otherwise(b)


def keyed_range_sum(df: DataFrame, key: str, ts: str, tiebreak: str, value: str, preceding_seconds: int,
                    name: str = "range_sum", partitions: int | None = None) -> DataFrame:
    """``sum(value) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN
    <preceding> PRECEDING AND CURRENT ROW)`` in microseconds (see ``keyed_range_agg``). Rows of one time are peers, so
    ``tiebreak`` decides nothing."""
    at = df.withColumn("__us", F.unix_micros(F.col(ts).cast("timestamp")))
    return keyed_range_agg(at, [key], "__us", preceding_seconds * 1_000_000, {name: (value, "sum")}, partitions).drop("__us")
