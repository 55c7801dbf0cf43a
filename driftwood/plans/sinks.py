"""Cases for sinks and loads."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators import joins as J
from driftwood.plans.registry import case
from driftwood.plans.sources import EVENTS_SCHEMA, ORDERS_SCHEMA, _events_landing
from driftwood.session import workdir
from driftwood.sources import ingest
from driftwood.sources import sinks as K
from driftwood.streaming.runner import await_end, read_progress, run_available_now
from driftwood.tables import load

ORD = "SELECT * FROM orders"


@case("write_table", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def write_table(spark, d):
    root = workdir(spark, "write_table")
    o = load(spark, d, "orders")
    name = K.save_table(o, K.table_name("orders_copy"), f"{root}/orders")
    summary = K.table_name("status_summary")
    return K.ctas(spark, summary, f"{root}/summary",
                  f"SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {name} GROUP BY 1")


@case("write_partitioned", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders""")
def write_partitioned(spark, d):
    root = workdir(spark, "write_partitioned")
    o = K.with_date_partitions(load(spark, d, "orders"), "o_orderdate")
    o.write.partitionBy("year", "month").parquet(root)
    return spark.read.parquet(root).select("o_orderkey", "year", "month")


@case("overwrite_dynamic", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def overwrite_dynamic(spark, d):
    root = workdir(spark, "overwrite_dynamic")
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    o.write.partitionBy("o_orderstatus").parquet(root)
    fix = o.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    K.overwrite_partitions(fix, root, ["o_orderstatus"])
    return spark.read.parquet(root).select("o_orderkey", "o_orderstatus", "o_totalprice")


@case("overwrite_static", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE o_totalprice END AS o_totalprice
FROM orders""")
def overwrite_static(spark, d):
    root = workdir(spark, "overwrite_static")
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    name = K.save_table(o, K.table_name("orders_p"), root, partition_by=["o_orderstatus"])
    src = K.table_name("orders_src")
    o.createOrReplaceTempView(src)
    spark.sql(f"INSERT OVERWRITE {name} PARTITION (o_orderstatus = 'O') "
              f"SELECT o_orderkey, 0.0 AS o_totalprice FROM {src} WHERE o_orderstatus = 'O'")
    return spark.table(name).select("o_orderkey", "o_orderstatus", "o_totalprice")


@case("insert_select", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'""")
def insert_select(spark, d):
    root = workdir(spark, "insert_select")
    name = K.table_name("orders_ins")
    spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_totalprice DOUBLE) USING parquet LOCATION '{root}'")
    src = K.table_name("orders_src")
    load(spark, d, "orders").createOrReplaceTempView(src)
    spark.sql(f"INSERT INTO {name} SELECT o_orderkey, o_totalprice FROM {src} WHERE o_orderstatus = 'F'")
    spark.table(src).filter("o_orderstatus = 'O'").select("o_orderkey", "o_totalprice").write.insertInto(name)
    return spark.table(name)


@case("append_merge_schema", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def append_merge_schema(spark, d):
    root = workdir(spark, "append_merge")
    o = load(spark, d, "orders")
    K.append_merge_schema(o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), root)
    K.append_merge_schema(o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderpriority"),
                          root)
    return K.read_merged(spark, root).select("o_orderkey", "o_totalprice", "o_orderpriority")


@case("enforce_schema", """SELECT *, true AS wrong_type_refused FROM orders""")
def enforce_schema(spark, d):
    o = load(spark, d, "orders")
    good = K.enforce_schema(o, ORDERS_SCHEMA)
    try:
        K.enforce_schema(o.withColumn("o_totalprice", F.col("o_totalprice").cast("string")), ORDERS_SCHEMA)
        refused = False
    except K.SchemaMismatch:
        refused = True
    return good.withColumn("wrong_type_refused", F.lit(refused))


@case("widen_type", """
SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, n_name, n_regionkey FROM nation""")
def widen_type(spark, d):
    root = workdir(spark, "widen")
    n = load(spark, d, "nation")
    n.write.parquet(f"{root}/v1")
    wide = K.widen_column(spark.read.parquet(f"{root}/v1"), "n_nationkey", T.LongType())
    wide.write.parquet(f"{root}/v2")
    return spark.read.parquet(f"{root}/v2")


@case("write_bucketed", """SELECT * FROM lineitem""")
def write_bucketed(spark, d):
    root = workdir(spark, "bucketed")
    li = load(spark, d, "lineitem")
    name = J.write_bucketed(li, "l_orderkey", J.bucket_count(8, li), root, "lineitem")
    return spark.table(name)


@case("sink_files", "SELECT event_id, ts, event_type FROM events")
def sink_files(spark, d):
    root = _events_landing(spark, d)
    s = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{root}/in").select("event_id", "ts", "event_type")
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    run_available_now(s, f"{root}/out_json", f"{root}/_ckpt", fmt="json", timestampNTZFormat=fmt)
    return (spark.read.schema("event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING")
            .option("timestampNTZFormat", fmt).json(f"{root}/out_json"))


@case("sink_debug", """SELECT event_type, count(*) AS count FROM events GROUP BY 1""")
def sink_debug(spark, d):
    root = _events_landing(spark, d)
    s = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{root}/in")
    name = K.table_name("mem_events")
    run_available_now(s.groupBy("event_type").count(), None, f"{root}/_ckpt", fmt="memory",
                      output_mode="complete", query_name=name)
    run_available_now(s, None, f"{root}/_ckpt_noop", fmt="noop")
    return spark.table(name)


@case("sink_table", "SELECT event_id, event_type, CAST(ts AS DATE) AS dt FROM events")
def sink_table(spark, d):
    root = _events_landing(spark, d)
    s = (spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{root}/in")
         .select("event_id", "event_type", F.to_date("ts").alias("dt")))
    name = K.table_name("events_tbl")
    spark.sql(f"CREATE TABLE {name} (event_id BIGINT, event_type STRING, dt DATE) USING parquet "
              f"PARTITIONED BY (dt) LOCATION '{root}/table'")
    q = (s.writeStream.option("checkpointLocation", f"{root}/_ckpt").partitionBy("dt")
         .trigger(availableNow=True).toTable(name))
    q.awaitTermination()
    return spark.table(name)


@case("sink_fanout", """
SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'fulfilled' WHEN 'O' THEN 'open' ELSE 'pending' END AS target
FROM orders""")
def sink_fanout(spark, d):
    from driftwood.streaming.ops import fan_out_batch

    root = workdir(spark, "fanout")
    load(spark, d, "orders").write.parquet(f"{root}/in")
    s = spark.readStream.schema(ORDERS_SCHEMA).parquet(f"{root}/in").select("o_orderkey", "o_orderstatus")
    routes = {"fulfilled": "o_orderstatus = 'F'", "open": "o_orderstatus = 'O'",
              "pending": "o_orderstatus NOT IN ('F', 'O')"}
    run_available_now(s, None, f"{root}/_ckpt", foreach_batch=fan_out_batch(f"{root}/out", routes))
    out = None
    for t in routes:
        df = spark.read.parquet(f"{root}/out/{t}").select("o_orderkey", "o_orderstatus", F.lit(t).alias("target"))
        out = df if out is None else out.unionByName(df)
    return out


@case("sink_foreach", """SELECT count(*) AS rows_seen FROM events""")
def sink_foreach(spark, d):
    """Row-level sink: each row handed to a writer object (prefer batch sinks)."""
    from driftwood.streaming.ops import RowCounter

    root = _events_landing(spark, d)
    s = spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{root}/in")
    q = (s.writeStream.foreach(RowCounter()).option("checkpointLocation", f"{root}/_ckpt")
         .trigger(availableNow=True).start())
    await_end(q, spark, progress=f"{root}/progress")
    return read_progress(spark, f"{root}/progress").agg(F.coalesce(F.sum("num_rows"), F.lit(0)).alias("rows_seen"))


@case("idempotent_write", """
SELECT o_orderkey, o_totalprice, 'loader' AS app, 7 AS batch FROM orders""")
def idempotent_write(spark, d):
    root = workdir(spark, "idempotent")
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    K.idempotent_write(o, root, "loader", 7)
    K.idempotent_write(o, root, "loader", 7)  # replay: replaces itself
    return spark.read.parquet(root).select("o_orderkey", "o_totalprice", "app", F.col("batch").cast("int"))


def _orders_landing(spark, d, fmt="json"):
    root = workdir(spark, "copy")
    o = load(spark, d, "orders")
    o.filter("o_orderstatus = 'F'").write.format(fmt).save(f"{root}/in")
    o.filter("o_orderstatus <> 'F'").write.mode("append").format(fmt).save(f"{root}/in")
    return root


@case("copy_into", ORD)
def copy_into(spark, d):
    root = _orders_landing(spark, d)
    args = (f"{root}/in", "json", f"{root}/t", f"{root}/_ledger", ORDERS_SCHEMA)
    ingest.copy_into(spark, *args)
    again = ingest.copy_into(spark, *args)  # nothing new: 0 rows, success
    assert again.first().num_inserted_rows == 0
    return spark.read.parquet(f"{root}/t").select(*ORDERS_SCHEMA.fieldNames())


@case("copy_force", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def copy_force(spark, d):
    root = _orders_landing(spark, d)
    args = (f"{root}/in", "json", f"{root}/t", f"{root}/_ledger", ORDERS_SCHEMA)
    ingest.copy_into(spark, *args)
    ingest.copy_into(spark, *args, force=True)
    return spark.read.parquet(f"{root}/t").select(*ORDERS_SCHEMA.fieldNames())


@case("copy_mapped", "SELECT o_orderkey AS order_id, o_totalprice AS amount FROM orders")
def copy_mapped(spark, d):
    root = _orders_landing(spark, d)
    ingest.copy_into(spark, f"{root}/in", "json", f"{root}/t", f"{root}/_ledger", ORDERS_SCHEMA,
                     transform=lambda df: df.select(F.col("o_orderkey").alias("order_id"),
                                                    F.col("o_totalprice").alias("amount")))
    return spark.read.parquet(f"{root}/t").select("order_id", "amount")


@case("copy_multi", "SELECT o_orderkey, o_orderstatus FROM orders")
def copy_multi(spark, d):
    root = workdir(spark, "copy_multi")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    o.filter("o_orderstatus = 'F'").write.parquet(f"{root}/a")
    o.filter("o_orderstatus <> 'F'").write.parquet(f"{root}/b")
    ingest.copy_into(spark, [f"{root}/a", f"{root}/b"], "parquet", f"{root}/t", f"{root}/_ledger",
                     "o_orderkey BIGINT, o_orderstatus STRING")
    return spark.read.parquet(f"{root}/t").select("o_orderkey", "o_orderstatus")


@case("copy_report", check="A")
def copy_report(spark, d):
    root = _orders_landing(spark, d)
    args = (f"{root}/in", "json", f"{root}/t", f"{root}/_ledger", ORDERS_SCHEMA)
    first = ingest.copy_into(spark, *args)
    second = ingest.copy_into(spark, *args)
    return first.unionByName(second)


@case("convert_format", """
SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""")
def convert_format(spark, d):
    root = workdir(spark, "convert")
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    o.write.option("header", "true").csv(f"{root}/csv")
    out = K.convert_format(spark, f"{root}/csv", "csv", f"{root}/parquet", ["o_orderstatus"],
                           schema="o_orderkey BIGINT, o_totalprice DOUBLE, o_orderstatus STRING", header="true")
    return out.select("o_orderkey", "o_totalprice", "o_orderstatus")


@case("derived_partitions", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, o_totalprice
FROM orders WHERE year(o_orderdate) = 1998""")
def derived_partitions(spark, d):
    root = workdir(spark, "derived")
    o = K.with_date_partitions(load(spark, d, "orders"), "o_orderdate")
    o.write.partitionBy("year", "month").parquet(root)
    return spark.read.parquet(root).filter("year = 1998").select("o_orderkey", "year", "month", "o_totalprice")


@case("partition_admin", """
SELECT DISTINCT 'year=' || CAST(year(o_orderdate) AS VARCHAR) || '/month=' || CAST(month(o_orderdate) AS VARCHAR)
       AS partition FROM orders""")
def partition_admin(spark, d):
    root = workdir(spark, "part_admin")
    o = K.with_date_partitions(load(spark, d, "orders"), "o_orderdate").select("o_orderkey", "year", "month")
    name = K.save_table(o, K.table_name("orders_pa"), root, partition_by=["year", "month"])
    first = spark.sql(f"SHOW PARTITIONS {name}").orderBy("partition").first()[0]
    spec = ", ".join(f"{k} = {v}" for k, v in (p.split("=") for p in first.split("/")))
    spark.sql(f"ALTER TABLE {name} DROP PARTITION ({spec})")  # metadata only: the table is external
    spark.sql(f"MSCK REPAIR TABLE {name}")  # finds the directory again and re-registers it
    return spark.sql(f"SHOW PARTITIONS {name}")


@case("table_copy", ORD)
def table_copy(spark, d):
    root = workdir(spark, "table_copy")
    src = K.save_table(load(spark, d, "orders"), K.table_name("orders_src"), f"{root}/src")
    return K.ctas(spark, K.table_name("orders_clone"), f"{root}/clone", f"SELECT * FROM {src}")


@case("table_cutover", ORD)
def table_cutover(spark, d):
    root = workdir(spark, "cutover")
    old = K.save_table(load(spark, d, "orders"), K.table_name("orders_live"), f"{root}/old")
    K.table_cutover(spark, old, K.table_name("orders_next"), f"{root}/new", "o_orderdate", "1999-01-01 00:00:00",
                    partition_by=["o_orderstatus"])
    return spark.table(old).select(*ORDERS_SCHEMA.fieldNames())
