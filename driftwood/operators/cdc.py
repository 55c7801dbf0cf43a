"""Change data: envelope decode, type 1 and type 2 apply, snapshot diffs,
upserts and row-level deletes/updates on Parquet tables.

Ordering rule (ours, stated in the survey): events of a key are ordered by
``sequence`` then by the tie-break columns; at equal order a delete wins.
Type 1 keeps the last event per key *including tombstones*, so a late
update with a lower sequence never revives a deleted key.

Everything is a DataFrame rewrite: ``max_by`` over a struct for "latest
per key" (map-side partial aggregation, no per-key sort), joins for merges,
and, where history needs neighbours (type 2), lag/lead as equi-joins on
(key, position) with positions from the skew-safe ``keyed_row_number``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _order(seq: str, tiebreak: Sequence[str], op: str) -> Column:
    return F.struct(F.col(seq), *[F.col(c) for c in tiebreak], (F.lower(F.col(op)) == "d").alias("__del"))


def decode_envelope(raw: DataFrame, json_col: str, row_schema: T.StructType, key: str) -> DataFrame:
    """Change-capture envelope -> flat change rows.

    ``payload.op``, ``payload.before``, ``payload.after``, ``payload.source``
    (ts_ms, file, pos). The key comes from ``after`` or, for deletes, from
    ``before``; the row image is ``after`` or ``before`` for deletes.
    """
    src = T.StructType.fromDDL("ts_ms BIGINT, db STRING, `table` STRING, file STRING, pos BIGINT, snapshot STRING")
    env = T.StructType([T.StructField("payload", T.StructType([
        T.StructField("before", row_schema), T.StructField("after", row_schema),
        T.StructField("source", src), T.StructField("op", T.StringType()), T.StructField("ts_ms", T.LongType())]))])
    p = raw.select(F.from_json(F.col(json_col), env)["payload"].alias("p"))
    image = F.when(F.lower("p.op") == "d", F.col("p.before")).otherwise(F.col("p.after"))
    out = p.select(
        F.lower("p.op").alias("op"),
        F.coalesce(F.col(f"p.after.{key}"), F.col(f"p.before.{key}")).alias(key),
        F.col("p.source.ts_ms").alias("ts_ms"), F.col("p.source.file").alias("binlog_file"),
        F.col("p.source.pos").alias("binlog_pos"), image.alias("row"))
    return out.select("op", key, "ts_ms", "binlog_file", "binlog_pos",
                      *[F.col(f"row.{f.name}").alias(f.name) for f in row_schema.fields if f.name != key])


def quarantine_changes(decoded: DataFrame, key: str, op: str = "op") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) change rows: only a missing op or a missing key
    quarantines a row (deletes carry their key in the before image)."""
    from driftwood.operators.quality import quarantine_split

    rules = {"op_present": F.col(op).isNotNull() & F.lower(F.col(op)).isin("c", "u", "d", "r", "t"),
             "key_present": F.col(key).isNotNull() | (F.lower(F.col(op)) == "t")}
    return quarantine_split(decoded, rules)


def latest_events(events: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = (),
                  op: str = "op") -> DataFrame:
    """Last event per key (tombstones kept)."""
    row = F.struct(*[F.col(c) for c in events.columns])
    return events.groupBy(*keys).agg(F.max_by(row, _order(seq, tiebreak, op)).alias("__r")).select("__r.*")


def apply_scd1(events: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = (), op: str = "op",
               column_list: Sequence[str] | None = None, except_columns: Sequence[str] = (),
               ignore_null_updates: bool = False, truncate_op: str | None = None,
               keep_tombstones: bool = False) -> DataFrame:
    """Type 1 target from change events (``apply_changes`` semantics).

    ``truncate_op``: events at or before the last truncate sequence are dropped.
    ``ignore_null_updates``: a NULL in an update keeps the earlier value
    (last non-null per column in sequence order).
    """
    ev = events
    if truncate_op is not None:
        is_t = F.lower(F.col(op)) == truncate_op
        last_t = ev.filter(is_t).select(F.max(seq)).scalar()  # scalar subquery; NULL when none
        ev = ev.filter(~is_t & (last_t.isNull() | (F.col(seq) > last_t)))
    data_cols = [c for c in ev.columns if c not in set(keys) | {op, seq, *tiebreak}]
    if column_list is not None:
        data_cols = [c for c in data_cols if c in column_list]
    data_cols = [c for c in data_cols if c not in except_columns]
    order = _order(seq, tiebreak, op)
    if ignore_null_updates:
        aggs = [F.max_by(F.col(op), order).alias(op), F.max(order).alias("__o")]
        for c in data_cols:
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c))
        latest = ev.groupBy(*keys).agg(*aggs).withColumn(seq, F.col(f"__o.{seq}")).drop("__o")
    else:
        latest = latest_events(ev.select(*keys, op, seq, *tiebreak, *data_cols), keys, seq, tiebreak, op)
    if keep_tombstones:
        return latest.select(*keys, op, seq, *data_cols)
    return latest.filter(F.lower(F.col(op)) != "d").select(*keys, *data_cols)


def soft_delete_flags(events: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = (),
                      op: str = "op") -> DataFrame:
    """Latest row per key kept, with ``is_deleted`` / ``is_active`` flags."""
    last = latest_events(events, keys, seq, tiebreak, op)
    deleted = F.lower(F.col(op)) == "d"
    return last.withColumn("is_deleted", deleted).withColumn("is_active", ~deleted)


def apply_scd2(events: DataFrame, keys: Sequence[str], seq: str, tiebreak: Sequence[str] = (), op: str = "op",
               track_columns: Sequence[str] | None = None) -> DataFrame:
    """Type 2 history: one row per tracked change with ``valid_from`` (its
    sequence), ``valid_to`` (next change's sequence, NULL when open) and
    ``is_current``. A delete closes the open row and adds none. With
    ``track_columns`` only changes of those columns open a new row."""
    from driftwood.operators.windows import keyed_shift

    data_cols = [c for c in events.columns if c not in set(keys) | {op, seq, *tiebreak}]
    is_del = F.lower(F.col(op)) == "d"
    ev = events.withColumn("__isdel", is_del)
    order = [seq, *tiebreak, "__isdel"]  # at equal sequence the delete sorts last
    if track_columns is not None:
        ev = ev.withColumn("__trk", F.struct(*[F.col(c) for c in track_columns]))
        ev = keyed_shift(ev, keys, order, {"__trk": "__prev_trk", "__isdel": "__prev_del"}, offset=1)
        keep = (F.col("__prev_del").isNull() | F.col("__isdel") | F.col("__prev_del")
                | ~F.col("__prev_trk").eqNullSafe(F.col("__trk")))
        ev = ev.filter(keep).drop("__trk", "__prev_trk", "__prev_del")
    hist = keyed_shift(ev, keys, order, {seq: "valid_to"}, offset=-1).filter(~F.col("__isdel"))
    return hist.select(*keys, *data_cols, F.col(seq).alias("valid_from"), "valid_to",
                       F.col("valid_to").isNull().alias("is_current"))


def as_of(history: DataFrame, t) -> DataFrame:
    """Rows valid at ``t``: ``valid_from <= t < coalesce(valid_to, +inf)``."""
    v = F.lit(t)
    return history.filter((F.col("valid_from") <= v) & (F.col("valid_to").isNull() | (v < F.col("valid_to"))))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """Change feed between two snapshots: insert, delete, update_preimage,
    update_postimage (null-safe comparison of all non-key columns)."""
    cols = [c for c in new.columns if c not in keys]
    o = old.select(*keys, F.struct(*cols).alias("__o"))
    n = new.select(*keys, F.struct(*cols).alias("__n"))
    j = o.join(n, list(keys), "full_outer")
    kind = (F.when(F.col("__o").isNull(), F.array(F.lit("insert")))
            .when(F.col("__n").isNull(), F.array(F.lit("delete")))
            .when(~F.col("__o").eqNullSafe(F.col("__n")), F.array(F.lit("update_preimage"), F.lit("update_postimage"))))
    x = j.withColumn("_change_type", F.explode(kind))
    img = F.when(F.col("_change_type").isin("delete", "update_preimage"), F.col("__o")).otherwise(F.col("__n"))
    out = x.select(*keys, *[img[c].alias(c) for c in cols], "_change_type")
    if version is not None:
        out = out.withColumn("_commit_version", F.lit(version).cast("long"))
    return out


def apply_change_feed(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge a change feed (one version) into a copy: deletes and pre-images
    remove, inserts and post-images add."""
    cols = [c for c in target.columns]
    touched = feed.select(*keys).distinct()
    kept = target.join(touched, list(keys), "left_anti")
    adds = feed.filter(F.col("_change_type").isin("insert", "update_postimage")).select(*cols)
    return kept.unionByName(adds)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], seq: str | None = None) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE SET * WHEN NOT MATCHED INSERT *.

    The source is reduced to its latest row per key first (when ``seq`` is
    given); the new snapshot is target rows without a source match plus the
    source rows. Written by the caller as a new snapshot.
    """
    src = source
    if seq is not None:
        src = src.groupBy(*keys).agg(F.max_by(F.struct(*src.columns), F.col(seq)).alias("__r")).select("__r.*")
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """whenNotMatchedInsertAll: source rows whose key is not in the target (to append)."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def delete_where(df: DataFrame, predicate: str | Column) -> DataFrame:
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.filter(~F.coalesce(p, F.lit(False)))


def update_where(df: DataFrame, predicate: str | Column, sets: dict[str, Column]) -> DataFrame:
    p = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    return df.withColumns({c: F.when(p, v).otherwise(F.col(c)) for c, v in sets.items()})


def rewrite_touched_partitions(spark, path: str, partition_cols: Sequence[str], predicate: str,
                               rewrite) -> DataFrame:
    """Row-level change on a partitioned Parquet table: only partitions that
    hold matching rows are read, rewritten with ``rewrite(df)`` and replaced
    by dynamic overwrite; a partition left with no rows is dropped. Untouched
    partitions are not rewritten."""
    table = spark.read.parquet(path)
    schema = table.schema
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    touched = table.filter(F.expr(predicate)).select(*partition_cols, folder.alias("__folder")).distinct()
    keys = list(partition_cols)
    folders = f"{path.rstrip('/')}_folders-{uuid.uuid4().hex[:12]}"
    touched.write.parquet(folders)  # read before the files they name are replaced
    touched = spark.read.parquet(folders)
    new = rewrite(_on_keys(table, touched.select(*keys).distinct(), keys, "left_semi"))
    staged = f"{path.rstrip('/')}_staged-{uuid.uuid4().hex[:12]}"
    new.write.parquet(staged)  # cut lineage: we overwrite what we read
    rewritten = spark.read.schema(new.schema).parquet(staged)
    (rewritten.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))
    emptied = _on_keys(touched, rewritten.select(*keys).distinct(), keys, "left_anti").select("__folder").distinct()
    conf = spark._jsc.hadoopConfiguration()
    for r in emptied.toLocalIterator():  # one folder at a time
        p = spark._jvm.org.apache.hadoop.fs.Path(r["__folder"])
        p.getFileSystem(conf).delete(p, True)
    return spark.read.schema(schema).parquet(path)


def _on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on ``keys``, NULL equal to NULL."""
    named = right.select(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(keys)])
    cond = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r{i}"))
    return left.join(named, cond, how)
