"""Cases for change data, SCD and row-level changes, plus the
per-batch upsert sink (K13) and the change-feed scan (S35).

Change events are derived from ``orders`` by key arithmetic (fixture rule):
create at step 1 for every order, update at step 2 when ``key % 7 = 0``
(status F, price + 100, customer NULL as a partial update), delete at step 3
when ``key % 11 = 0``, and a late update at step 1.5 when ``key % 77 = 0``.
Sequence = ``ts_ms``; tie-break = (binlog_file, binlog_pos).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwood.operators import cdc as C
from driftwood.plans.registry import case
from driftwood.session import workdir
from driftwood.streaming import ops
from driftwood.streaming.runner import run_available_now
from driftwood.tables import load

BASE_MS = 1_700_000_000_000
KEY = ["o_orderkey"]
TB = ["binlog_file", "binlog_pos"]
COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _ev(o, op, step, custkey, status, price):
    return o.select("o_orderkey", F.lit(op).alias("op"),
                    F.lit(BASE_MS + int(step * 1000)).cast("long").alias("ts_ms"),
                    F.lit("binlog.000001").alias("binlog_file"),
                    (F.col("o_orderkey") * 10 + F.lit(int(step * 2))).cast("long").alias("binlog_pos"),
                    custkey.cast("long").alias("o_custkey"), status.alias("o_orderstatus"),
                    price.cast("double").alias("o_totalprice"))


def change_events(spark, d, snapshot=False):
    o = load(spark, d, "orders")
    k = F.col("o_orderkey")
    parts = [
        _ev(o, "r" if snapshot else "c", 0.5 if snapshot else 1, F.col("o_custkey"), F.col("o_orderstatus"),
            F.col("o_totalprice")),
        _ev(o.filter(k % 7 == 0), "u", 2, F.lit(None), F.lit("F"), F.col("o_totalprice") + 100),
        _ev(o.filter(k % 11 == 0), "d", 3, F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice")),
        _ev(o.filter(k % 77 == 0), "u", 1.5, F.col("o_custkey"), F.col("o_orderstatus"), F.col("o_totalprice") + 50),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


EV_SQL = f"""EV AS (
  SELECT o_orderkey, 'c' AS op, {BASE_MS + 1000}::BIGINT AS ts_ms, o_custkey, o_orderstatus, o_totalprice FROM orders
  UNION ALL SELECT o_orderkey, 'u', {BASE_MS + 2000}, NULL, 'F', o_totalprice + 100 FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, 'd', {BASE_MS + 3000}, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 11 = 0
  UNION ALL SELECT o_orderkey, 'u', {BASE_MS + 1500}, o_custkey, o_orderstatus, o_totalprice + 50 FROM orders
            WHERE o_orderkey % 77 = 0)"""
T1_SQL = f"""WITH {EV_SQL},
L AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC, op = 'd' DESC) AS rn FROM EV)
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM L WHERE rn = 1 AND op <> 'd'"""
H_SQL = f"""WITH {EV_SQL},
H AS (SELECT *, lead(ts_ms) OVER (PARTITION BY o_orderkey ORDER BY ts_ms, op = 'd') AS valid_to FROM EV)"""
HIST_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, ts_ms AS valid_from, valid_to, valid_to IS NULL AS is_current"


def scd1(spark, d, **kw):
    return C.apply_scd1(change_events(spark, d), KEY, "ts_ms", TB, **kw)


@case("cdc_decode", f"""WITH {EV_SQL}
SELECT op, o_orderkey, ts_ms, o_orderstatus, o_totalprice FROM EV""")
def cdc_decode(spark, d):
    ev = change_events(spark, d)
    row = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    none = F.lit(None).cast(ev.select(row).schema[0].dataType)
    is_d = F.col("op") == "d"
    env = ev.select(F.to_json(F.struct(F.struct(
        F.when(is_d | (F.col("op") == "u"), row).otherwise(none).alias("before"),
        F.when(is_d, none).otherwise(row).alias("after"),
        F.struct(F.col("ts_ms"), F.lit("shop").alias("db"), F.lit("orders").alias("table"),
                 F.col("binlog_file").alias("file"), F.col("binlog_pos").alias("pos")).alias("source"),
        F.col("op"), F.col("ts_ms")).alias("payload"))).alias("json"))
    schema = ev.select(row).schema[0].dataType
    dec = C.decode_envelope(env, "json", schema, "o_orderkey")
    return dec.select("op", "o_orderkey", "ts_ms", "o_orderstatus", "o_totalprice")


@case("scd1_apply", T1_SQL)
def scd1_apply(spark, d):
    return scd1(spark, d)


@case("scd2_apply", f"{H_SQL} SELECT {HIST_COLS} FROM H WHERE op <> 'd'")
def scd2_apply(spark, d):
    return C.apply_scd2(change_events(spark, d), KEY, "ts_ms", TB).drop(*TB)


@case("scd2_tracked", f"""WITH {EV_SQL},
T AS (SELECT *, lag(o_orderstatus) OVER w AS prev_status, lag(op) OVER w AS prev_op, row_number() OVER w AS rn
      FROM EV WINDOW w AS (PARTITION BY o_orderkey ORDER BY ts_ms, op = 'd')),
K AS (SELECT * FROM T WHERE rn = 1 OR op = 'd' OR prev_op = 'd' OR prev_status IS DISTINCT FROM o_orderstatus),
H AS (SELECT *, lead(ts_ms) OVER (PARTITION BY o_orderkey ORDER BY ts_ms, op = 'd') AS valid_to FROM K)
SELECT {HIST_COLS} FROM H WHERE op <> 'd'""")
def scd2_tracked(spark, d):
    return C.apply_scd2(change_events(spark, d), KEY, "ts_ms", TB, track_columns=["o_orderstatus"]).drop(*TB)


@case("scd1_ignore_null", f"""WITH {EV_SQL},
L AS (SELECT *, row_number() OVER w AS rn,
        last_value(o_custkey IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS cust
      FROM EV WINDOW w AS (PARTITION BY o_orderkey ORDER BY ts_ms DESC, op = 'd' DESC))
SELECT o_orderkey, cust AS o_custkey, o_orderstatus, o_totalprice FROM L WHERE rn = 1 AND op <> 'd'""")
def scd1_ignore_null(spark, d):
    return scd1(spark, d, ignore_null_updates=True)


@case("scd1_truncate", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 7 AS o_totalprice FROM orders WHERE o_orderkey % 5 = 0""")
def scd1_truncate(spark, d):
    ev = change_events(spark, d)
    o = load(spark, d, "orders")
    one = o.agg(F.max("o_orderkey").alias("o_orderkey"))  # the marker is one row, whatever the table holds
    trunc = _ev(one, "t", 2.5, F.lit(None), F.lit(None).cast("string"), F.lit(None)).withColumn(
        "o_orderkey", F.lit(None).cast("long"))
    recreate = _ev(o.filter(F.col("o_orderkey") % 5 == 0), "c", 4, F.col("o_custkey"), F.col("o_orderstatus"),
                   F.col("o_totalprice") + 7)
    return C.apply_scd1(ev.unionByName(trunc).unionByName(recreate), KEY, "ts_ms", TB, truncate_op="t")


@case("soft_delete", f"""WITH {EV_SQL},
L AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC, op = 'd' DESC) AS rn FROM EV)
SELECT o_orderkey, op, op = 'd' AS is_deleted, op <> 'd' AS is_active FROM L WHERE rn = 1""")
def soft_delete(spark, d):
    return C.soft_delete_flags(change_events(spark, d), KEY, "ts_ms", TB).select(
        "o_orderkey", "op", "is_deleted", "is_active")


@case("cdc_out_of_order", T1_SQL)
def cdc_out_of_order(spark, d):
    """Same events, arrival order scrambled by a hash: result unchanged."""
    ev = change_events(spark, d).repartition(7, F.xxhash64("o_orderkey", "ts_ms"))
    return C.apply_scd1(ev, KEY, "ts_ms", TB)


@case("cdc_snapshot_merge", T1_SQL)
def cdc_snapshot_merge(spark, d):
    """Initial snapshot rows (op r) plus the later change stream."""
    snap = change_events(spark, d, snapshot=True)
    return C.apply_scd1(snap.filter("op <> 'c'"), KEY, "ts_ms", TB)


AS_OF_MS = BASE_MS + 2500


@case("as_of_read", f"{H_SQL} SELECT {HIST_COLS} FROM H WHERE op <> 'd' AND ts_ms <= {AS_OF_MS} "
                    f"AND (valid_to IS NULL OR {AS_OF_MS} < valid_to)")
def as_of_read(spark, d):
    hist = C.apply_scd2(change_events(spark, d), KEY, "ts_ms", TB).drop(*TB)
    return C.as_of(hist, AS_OF_MS)


@case("restore_as_of", f"{H_SQL} SELECT {HIST_COLS} FROM H WHERE op <> 'd' AND ts_ms <= {AS_OF_MS} "
                       f"AND (valid_to IS NULL OR {AS_OF_MS} < valid_to)")
def restore_as_of(spark, d):
    from driftwood.operators.datasets import publish

    hist = C.apply_scd2(change_events(spark, d), KEY, "ts_ms", TB).drop(*TB)
    return spark.read.parquet(publish(C.as_of(hist, AS_OF_MS), workdir(spark, "restore"), "orders"))


def _diff_sql(extra=""):
    return f"""WITH {EV_SQL},
L AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY ts_ms DESC, op = 'd' DESC) AS rn FROM EV),
V2 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM L WHERE rn = 1 AND op <> 'd'),
V1 AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders),
J AS (SELECT V1.o_orderkey AS k1, V2.o_orderkey AS k2, V1.o_custkey AS c1, V2.o_custkey AS c2,
             V1.o_orderstatus AS s1, V2.o_orderstatus AS s2, V1.o_totalprice AS p1, V2.o_totalprice AS p2
      FROM V1 FULL OUTER JOIN V2 ON V1.o_orderkey = V2.o_orderkey)
SELECT k2 AS o_orderkey, c2 AS o_custkey, s2 AS o_orderstatus, p2 AS o_totalprice, 'insert' AS _change_type{extra}
  FROM J WHERE k1 IS NULL
UNION ALL SELECT k1, c1, s1, p1, 'delete'{extra} FROM J WHERE k2 IS NULL
UNION ALL SELECT k1, c1, s1, p1, 'update_preimage'{extra} FROM J WHERE k1 IS NOT NULL AND k2 IS NOT NULL
  AND (c1 IS DISTINCT FROM c2 OR s1 IS DISTINCT FROM s2 OR p1 IS DISTINCT FROM p2)
UNION ALL SELECT k2, c2, s2, p2, 'update_postimage'{extra} FROM J WHERE k1 IS NOT NULL AND k2 IS NOT NULL
  AND (c1 IS DISTINCT FROM c2 OR s1 IS DISTINCT FROM s2 OR p1 IS DISTINCT FROM p2)"""


@case("snapshot_diff", _diff_sql())
def snapshot_diff(spark, d):
    v1 = load(spark, d, "orders").select(*COLS)
    return C.snapshot_diff(v1, scd1(spark, d), KEY)


@case("change_feed", _diff_sql(", 2::BIGINT AS _commit_version"))
def change_feed(spark, d):
    root = workdir(spark, "change_feed")
    v1 = load(spark, d, "orders").select(*COLS)
    feed = C.snapshot_diff(v1, scd1(spark, d), KEY, version=2)
    feed.write.partitionBy("_commit_version").parquet(f"{root}/feed")
    return spark.read.parquet(f"{root}/feed").filter(F.col("_commit_version") >= 2)


@case("replica_sync", T1_SQL)
def replica_sync(spark, d):
    v1 = load(spark, d, "orders").select(*COLS)
    feed = C.snapshot_diff(v1, scd1(spark, d), KEY, version=2)
    return C.apply_change_feed(v1, feed, KEY)


SUBJECT = "(SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')"


@case("erase_subject", f"""
SELECT 'silver' AS part, o_orderkey AS id, o_custkey AS ref, NULL AS name, NULL::BIGINT AS table_rows, NULL::BIGINT AS rows_touched
FROM orders WHERE o_custkey <> {SUBJECT}
UNION ALL SELECT 'vault', c_custkey, NULL, CASE WHEN c_custkey = {SUBJECT} THEN NULL ELSE c_name END, NULL, NULL FROM customer
UNION ALL SELECT 'report', NULL, NULL, 'vault: nulled', count(*), count(*) FILTER (c_custkey = {SUBJECT}) FROM customer
UNION ALL SELECT 'report', NULL, NULL, 'silver: dropped', count(*), count(*) FILTER (o_custkey = {SUBJECT}) FROM orders""")
def erase_subject(spark, d):
    """Both tables after the erasure, written and read again, and the report of what it touched."""
    from driftwood.operators.govern import erase_subject as erase
    from driftwood.operators.govern import erasure_report

    root = workdir(spark, "erase")
    c, o = load(spark, d, "customer").select("c_custkey", "c_name"), load(spark, d, "orders").select("o_orderkey", "o_custkey")
    subject = load(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.min("c_custkey")).scalar()
    vault, silver = erase(c, o, subject, "c_custkey", "o_custkey", ["c_name"])
    report = erasure_report({"vault": (c, "c_custkey", "nulled"), "silver": (o, "o_custkey", "dropped")}, subject)
    for name, df in (("vault", vault), ("silver", silver), ("report", report)):
        df.write.parquet(f"{root}/{name}")
    none = F.lit(None)
    parts = (("silver", "o_orderkey", "o_custkey", none, none, none), ("vault", "c_custkey", none, "c_name", none, none),
             ("report", none, none, F.concat_ws(": ", "table_name", "action"), "table_rows", "rows_touched"))
    kinds = {"id": "long", "ref": "long", "name": "string", "table_rows": "long", "rows_touched": "long"}
    out = None
    for name, *values in parts:
        cols = [(F.col(v) if isinstance(v, str) else v).cast(kinds[k]).alias(k) for k, v in zip(kinds, values)]
        part = spark.read.parquet(f"{root}/{name}").select(F.lit(name).alias("part"), *cols)
        out = part if out is None else out.unionByName(part)
    return out


#: the case's own secret; a deployment takes its secret from the session
VAULT_SECRET = b"secret of the pii_vault case"


def _hmac_sql(value: str) -> str:
    inner, outer = ("".join(f"\\x{b ^ pad:02X}" for b in VAULT_SECRET.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    return f"sha256('{outer}'::BLOB || from_hex(sha256('{inner}'::BLOB || encode({value}))))"


@case("pii_vault", f"""
SELECT o.o_orderkey, {_hmac_sql("CAST(o.o_custkey AS VARCHAR)")} AS customer_ref, c.c_name
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def pii_vault(spark, d):
    from driftwood.operators.govern import vault_split

    c, o = load(spark, d, "customer"), load(spark, d, "orders")
    bronze, vault = vault_split(o.select("o_orderkey", "o_custkey"), c.select("c_custkey", "c_name"),
                                "o_custkey", "c_custkey", VAULT_SECRET)
    return bronze.join(vault, "customer_ref").select("o_orderkey", "customer_ref", "c_name")


UPSERT_SRC = """S AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 100 AS o_totalprice FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, 'O', o_totalprice FROM orders WHERE o_orderkey % 13 = 0)"""


def _upsert_source(o):
    k = F.col("o_orderkey")
    upd = o.filter(k % 7 == 0).withColumn("o_totalprice", F.col("o_totalprice") + 100)
    new = o.filter(k % 13 == 0).withColumn("o_orderkey", k + 1_000_000_000).withColumn("o_orderstatus", F.lit("O"))
    return upd.unionByName(new)


@case("upsert", f"""WITH {UPSERT_SRC}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM S)
UNION ALL SELECT * FROM S""")
def upsert(spark, d):
    root = workdir(spark, "upsert")
    o = load(spark, d, "orders").select(*COLS)
    new = C.upsert(o, _upsert_source(o), KEY)
    new.write.parquet(f"{root}/v2")  # publish as a new snapshot
    return spark.read.parquet(f"{root}/v2")


@case("insert_only", f"""WITH {UPSERT_SRC}
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
UNION ALL SELECT * FROM S WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def insert_only(spark, d):
    root = workdir(spark, "insert_only")
    o = load(spark, d, "orders").select(*COLS)
    o.write.parquet(root)
    C.insert_only(spark.read.parquet(root), _upsert_source(o), KEY).write.mode("append").parquet(root)
    return spark.read.parquet(root)


@case("delete_where", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE NOT (o_totalprice < 50000)")
def delete_where(spark, d):
    root = workdir(spark, "delete_where")
    load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy(
        "o_orderstatus").parquet(root)
    out = C.rewrite_touched_partitions(spark, root, ["o_orderstatus"], "o_totalprice < 50000",
                                       lambda df: C.delete_where(df, "o_totalprice < 50000"))
    return out.select("o_orderkey", "o_totalprice", "o_orderstatus")


@case("update_where", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 0.9 ELSE o_totalprice END AS o_totalprice,
       o_orderstatus FROM orders""")
def update_where(spark, d):
    root = workdir(spark, "update_where")
    (load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
     .write.partitionBy("o_orderstatus").parquet(root))
    pred = "o_orderpriority = '1-URGENT'"
    out = C.rewrite_touched_partitions(spark, root, ["o_orderstatus"], pred,
                                       lambda df: C.update_where(df, pred, {"o_totalprice": F.col("o_totalprice") * 0.9}))
    return out.select("o_orderkey", "o_totalprice", "o_orderstatus")


@case("archive_split", """
SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'archive' ELSE 'live' END AS tier FROM orders""")
def archive_split(spark, d):
    root = workdir(spark, "archive")
    o = load(spark, d, "orders")
    old = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    o.filter(old).write.parquet(f"{root}/archive")  # archive first
    o.filter(~F.coalesce(old, F.lit(False))).write.parquet(f"{root}/live")  # then the source without them
    a = spark.read.parquet(f"{root}/archive").select("o_orderkey", F.lit("archive").alias("tier"))
    live = spark.read.parquet(f"{root}/live").select("o_orderkey", F.lit("live").alias("tier"))
    return a.unionByName(live)


@case("sink_upsert", T1_SQL)
def sink_upsert(spark, d):
    """Change events streamed in files; each micro-batch adds deltas to the buckets it touches and
    merges those that have two (latest per key, tombstones kept)."""
    root = workdir(spark, "sink_upsert")
    ev = change_events(spark, d)
    for step in ("ts_ms < 1700000001600", "ts_ms BETWEEN 1700000001600 AND 1700000002500", "ts_ms > 1700000002500"):
        ev.filter(step).write.mode("append").parquet(f"{root}/in")
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    run_available_now(s, None, f"{root}/_ckpt", foreach_batch=ops.upsert_batch(f"{root}/target", KEY, "ts_ms", TB, buckets=8, merge_every=2))
    tgt = ops.read_latest_snapshot(spark, f"{root}/target")
    return tgt.filter("op <> 'd'").select(*COLS)
