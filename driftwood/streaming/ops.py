"""Per-batch sinks for ``foreachBatch``: fan-out, idempotent batch partitions,
upserts, late-row split. Each writes into ``batch_id=`` partitions with
dynamic overwrite, so a replayed micro-batch replaces its own output
(exactly-once effect on top of at-least-once delivery)."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def fan_out_batch(root: str, routes: Mapping[str, str]) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: one filtered write per route, the batch persisted
    once so the source is read a single time."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, cond in routes.items():
                write_batch(batch.filter(cond), f"{root}/{name}", batch_id)
        finally:
            batch.unpersist()

    return run


class RowCounter:
    """Minimal ``ForeachWriter``: opens per partition/epoch, sees each row."""

    def open(self, partition_id, epoch_id):
        self.n = 0
        return True

    def process(self, row):
        self.n += 1

    def close(self, error):
        if error:
            raise error


def late_router(root: str, ts: str, threshold: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch function: rows older than (max event time of earlier
    batches - threshold) go to ``root/corrections``, the rest to
    ``root/main``. The running max lives in ``root/_bound`` keyed by batch id,
    so a replayed batch sees the same bound and rewrites the same partitions."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prev = None
        if batch_id > 0:  # every earlier batch wrote its bound row
            prev = (spark.read.parquet(f"{root}/_bound").filter(F.col("batch_id") < batch_id)
                    .agg(F.max("max_ts")).first()[0])
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if prev is None:
                on_time, late = batch, batch.limit(0)
            else:
                bound = F.lit(prev) - F.expr(f"INTERVAL {threshold}")
                on_time, late = batch.filter(F.col(ts) >= bound), batch.filter(F.col(ts) < bound)
            write_batch(on_time, f"{root}/main", batch_id)
            write_batch(late, f"{root}/corrections", batch_id)
            write_batch(batch.agg(F.max(ts).alias("max_ts")), f"{root}/_bound", batch_id)
        finally:
            batch.unpersist()

    return run


# ------------------------------------------------------------------ bucketed upsert target
#
# root/_meta            how the target is kept (keys, order, buckets, schema), written by the first batch
# root/delta/upsert_v=N/upsert_bucket=B   latest event per key of batch N, only in the buckets it touches
# root/base/upsert_v=N/upsert_bucket=B    a bucket merged up to batch N
# root/_merged/upsert_v=N          buckets merged by batch N, written after their base

#: version and bucket of a row, and a bucket's last merge
V, B, MV = "upsert_v", "upsert_bucket", "upsert_merged"
META = "keys array<string>, seq string, tiebreak array<string>, buckets int, schema string"


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _versions(spark, root: str, kind: str, schema: T.StructType) -> DataFrame:
    """Rows of ``delta`` or ``base`` with their version and bucket; none if there is no such folder yet."""
    full = T.StructType([*schema.fields, T.StructField(V, T.IntegerType()), T.StructField(B, T.IntegerType())])
    return spark.read.schema(full).parquet(f"{root}/{kind}") if _exists(spark, f"{root}/{kind}") else spark.createDataFrame([], full)


def _merged(spark, root: str, before: int | None = None) -> DataFrame:
    """bucket, mv: the last merge of each bucket (at most one row a bucket)."""
    kind = f"{B} int, {V} int"
    rows = spark.read.schema(kind).parquet(f"{root}/_merged") if _exists(spark, f"{root}/_merged") else spark.createDataFrame([], kind)
    rows = rows if before is None else rows.filter(F.col(V) < before)
    return F.broadcast(rows.groupBy(B).agg(F.max(V).alias(MV)))


def _current(spark, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """Each bucket's last base and the deltas after it, with ``v`` and ``bucket``."""
    merged = _merged(spark, root, before)
    delta = _versions(spark, root, "delta", schema).join(merged, B, "left").filter(F.col(V) > F.coalesce(MV, F.lit(-1)))
    base = _versions(spark, root, "base", schema).join(merged, B).filter(F.col(V) == F.col(MV))
    return delta.unionByName(base).drop(MV)


def read_latest_snapshot(spark, root: str) -> DataFrame:
    """The target of ``upsert_batch`` as of its last batch (tombstones kept)."""
    from driftwood.operators.cdc import latest_events

    m = spark.read.schema(META).parquet(f"{root}/_meta").first()
    schema = T.StructType.fromJson(json.loads(m["schema"]))
    return latest_events(_current(spark, root, schema).drop(V, B), m["keys"], m["seq"], m["tiebreak"])


#: a base of at most this many rows is merged whenever enough deltas are there, a larger one once they hold half as many rows
SMALL_BASE_ROWS = 100_000


def upsert_batch(root: str, keys, seq: str, tiebreak=(), buckets: int = 16, merge_every: int = 4,
                 small_base: int = SMALL_BASE_ROWS) -> Callable[[DataFrame, int], None]:
    """foreachBatch MERGE into a target in hash buckets of the keys.

    A batch writes its latest event per key (tombstones kept) as delta files, only in the buckets that it
    touches. A bucket with ``merge_every`` deltas is merged into a new base once they hold half the rows of its last base (or that
    has at most ``small_base``), so that all merges together write a few times the target, however many batches come;
    what the merge before last replaced is removed, so that a reader that began with the last one still ends. Nothing else of the target is read or written. A replayed
    batch overwrites its own delta and its own merges, from the same predecessors. Give about a bucket for each 512 MB of target.
    """
    from driftwood.operators.cdc import latest_events
    from driftwood.operators.layout import hash_bucket

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, T.StructType([T.StructField(f.name, f.dataType) for f in batch.schema.fields])
        if not _exists(spark, f"{root}/_meta/_SUCCESS"):
            meta = [(list(keys), seq, list(tiebreak), buckets, schema.json())]
            spark.createDataFrame(meta, META).coalesce(1).write.mode("overwrite").parquet(f"{root}/_meta")
        events = hash_bucket(latest_events(batch, keys, seq, tiebreak), keys, buckets, B)
        events.write.mode("overwrite").partitionBy(B).parquet(f"{root}/delta/{V}={batch_id}")
        # a merge of this batch that a failed run left behind does not count
        now = _current(spark, root, schema, before=batch_id).filter(F.col(V) <= batch_id)
        last = _merged(spark, root, batch_id)
        held = now.join(last, B, "left").withColumn("__new", F.col(V) > F.coalesce(MV, F.lit(-1))).groupBy(B, V, "__new").agg(F.count(F.lit(1)).alias("rows"))
        held = held.groupBy(B).agg(F.count_if("__new").alias("n"), F.sum(F.when(F.col("__new"), F.col("rows")).otherwise(0)).alias("fresh"),
                                   F.sum(F.when(F.col("__new"), 0).otherwise(F.col("rows"))).alias("base"))
        worth = (F.col("base") <= small_base) | (2 * F.col("fresh") >= F.col("base"))
        due = [r[B] for r in held.filter((F.col("n") >= merge_every) & worth).select(B).collect()]
        if not due:  # at most ``buckets`` numbers
            return
        new = latest_events(now.filter(F.col(B).isin(due)).drop(V), [*keys, B], seq, tiebreak)
        new.write.mode("overwrite").partitionBy(B).parquet(f"{root}/base/{V}={batch_id}")
        spark.createDataFrame([(b,) for b in due], f"{B} int").coalesce(1).write.mode("overwrite").parquet(f"{root}/_merged/{V}={batch_id}")
        _expire(spark, root, {r[B]: r[MV] for r in last.filter(F.col(B).isin(due)).collect()})

    return run


def _expire(spark, root: str, replaced: dict[int, int]) -> None:
    """Remove, bucket by bucket, deltas up to the replaced merge and bases before it."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    for kind, last in (("delta", 0), ("base", -1)):
        if not _exists(spark, f"{root}/{kind}"):
            continue
        for status in fs.listStatus(path(f"{root}/{kind}")):
            name = status.getPath().getName()
            for bucket, v in replaced.items() if name.startswith(f"{V}=") else ():
                if int(name[len(V) + 1 :]) <= v + last:
                    fs.delete(path(f"{root}/{kind}/{name}/{B}={bucket}"), True)
