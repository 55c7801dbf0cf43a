"""Cases for scans and sources. Each case writes the needed
landing files from the test tables into a fresh shared work directory, then
reads them with the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.operators.joins import small_enough
from driftwood.plans.registry import case
from driftwood.session import workdir
from driftwood.sources import bus
from driftwood.sources import files as FS
from driftwood.sources import ingest
from driftwood.sources.lineage import with_lineage
from driftwood.streaming.runner import read_progress, read_sink, run_available_now
from driftwood.tables import load, path



def _schema(*fields):
    return T.StructType([T.StructField(n, t) for n, t in fields])


L_, S_, D_, N_ = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampNTZType()
ORDERS_SCHEMA = _schema(("o_orderkey", L_), ("o_custkey", L_), ("o_orderstatus", S_), ("o_totalprice", D_),
                        ("o_orderdate", N_), ("o_orderpriority", S_))
EVENTS_SCHEMA = _schema(("event_id", L_), ("ts", N_), ("user_id", L_), ("event_type", S_), ("value", D_),
                        ("props", S_))


@case("inline_relation", """
SELECT n.n_name AS nation, r.r_name AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""")
def inline_relation(spark, d):
    """Local rows -> DataFrame with an explicit StructType (bounded dimension rows)."""
    n, r = load(spark, d, "nation"), load(spark, d, "region")
    src = n.join(r, n.n_regionkey == r.r_regionkey).select("n_name", "r_name")
    if not small_enough(src, 100_000):
        return src.toDF("nation", "region")  # beyond the bound nothing passes the driver
    rows = [(a, b) for a, b in src.collect()]
    schema = T.StructType([T.StructField("nation", T.StringType()), T.StructField("region", T.StringType())])
    return spark.createDataFrame(rows, schema)


@case("scan_parquet", """
SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01'""")
def scan_parquet(spark, d):
    out = workdir(spark, "scan_parquet")
    load(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate").write.parquet(out)
    df = spark.read.parquet(out)
    return df.filter(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "l_orderkey", "l_partkey", "l_quantity")


ORDERS_ALL = "SELECT * FROM orders"


@case("scan_csv", ORDERS_ALL)
def scan_csv(spark, d):
    out = workdir(spark, "scan_csv")
    opts = {"header": "true", "sep": "|", "quote": '"', "escape": "\\", "nullValue": "NA",
            "timestampFormat": "yyyy-MM-dd HH:mm:ss"}
    load(spark, d, "orders").write.options(**opts).csv(out)
    return FS.read_csv(spark, out, ORDERS_SCHEMA, **opts, ignoreLeadingWhiteSpace="true",
                       ignoreTrailingWhiteSpace="true", encoding="UTF-8")


@case("scan_json", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def scan_json(spark, d):
    root = workdir(spark, "scan_json")
    o = load(spark, d, "orders")
    o.write.json(f"{root}/lines")
    FS.write_json_documents(o, f"{root}/docs", rows_per_doc=2_000)
    lines = spark.read.schema(ORDERS_SCHEMA).option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSS]").json(
        f"{root}/lines")
    docs = spark.read.schema(ORDERS_SCHEMA).option("multiLine", "true").json(f"{root}/docs")
    return lines.unionByName(docs.select(*ORDERS_SCHEMA.fieldNames()))


@case("scan_orc", """
SELECT o_orderkey, o_totalprice, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def scan_orc(spark, d):
    root = workdir(spark, "scan_orc")
    o = load(spark, d, "orders")
    o.filter("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice").write.orc(f"{root}/part=1")
    (o.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", F.col("o_orderpriority").alias("note"))
     .write.orc(f"{root}/part=2"))
    return spark.read.option("mergeSchema", "true").orc(root).select("o_orderkey", "o_totalprice", "note")


@case("scan_text", """
SELECT doc_id % 16 AS bucket, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
       CAST(count(*) AS BIGINT) AS n_docs FROM documents GROUP BY 1""")
def scan_text(spark, d):
    root = workdir(spark, "scan_text")
    docs = load(spark, d, "documents")
    (docs.select((F.col("doc_id") % 16).alias("bucket"), "text").write.partitionBy("bucket")
     .option("lineSep", "\n").text(f"{root}/docs"))
    lines = spark.read.option("lineSep", "\n").text(f"{root}/docs").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_lines"))
    # wholetext: one row per file; docs per bucket counted from the doc separator
    (docs.select((F.col("doc_id") % 16).alias("bucket"), F.concat("text", F.lit("\u0001")).alias("t"))
     .write.partitionBy("bucket").option("lineSep", "\n").text(f"{root}/whole"))
    whole = spark.read.option("wholetext", "true").text(f"{root}/whole").groupBy("bucket").agg(
        F.sum(F.size(F.split("value", "\u0001")) - 1).alias("n_docs"))
    return lines.join(whole, "bucket").select(F.col("bucket").cast("bigint").alias("bucket"),
                                              "n_lines", F.col("n_docs").cast("bigint").alias("n_docs"))


@case("scan_binary", check="A")
def scan_binary(spark, d):
    return FS.scan_binary(spark, d, "*.parquet")


@case("scan_xml", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_xml(spark, d):
    out = workdir(spark, "scan_xml")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    o.write.format("xml").option("rowTag", "order").option("rootTag", "orders").save(out)
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
    return spark.read.format("xml").option("rowTag", "order").schema(schema).load(out)


@case("scan_sql_path", "SELECT count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem")
def scan_sql_path(spark, d):
    df = FS.read_sql_path(spark, "parquet", path(d, "lineitem"))
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


def _events_landing(spark, d, slices=4, fmt="parquet"):
    root = workdir(spark, "landing")
    FS.write_slices(load(spark, d, "events"), f"{root}/in", fmt, "ts", slices=slices)
    return root


@case("stream_files", "SELECT * FROM events")
def stream_files(spark, d):
    root = _events_landing(spark, d)
    s = spark.readStream.schema(EVENTS_SCHEMA).format("parquet").option("maxFilesPerTrigger", 8).load(f"{root}/in")
    run_available_now(s, f"{root}/out", f"{root}/_ckpt")
    return read_sink(spark, f"{root}/out")


@case("streaming_table", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def streaming_table(spark, d):
    from driftwood.operators.datasets import streaming_table as st

    root = _events_landing(spark, d)
    return st(spark, "events_clean", f"{root}/in", "parquet", EVENTS_SCHEMA,
              lambda df: df.filter("event_type <> 'error'").select("event_id", "user_id", "event_type"),
              f"{root}/tables")


@case("file_lineage", """
SELECT o_orderkey, 'orders.parquet' AS _source_file_name, true AS has_size FROM orders""")
def file_lineage(spark, d):
    o = with_lineage(load(spark, d, "orders"))
    return o.select("o_orderkey", F.element_at(F.split("_source_file", "/"), -1).alias("_source_file_name"),
                    (F.col("_source_file_size") > 0).alias("has_size"))


@case("mixed_landing", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def mixed_landing(spark, d):
    root = workdir(spark, "mixed")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    o.filter("o_orderstatus = 'F'").write.json(f"{root}/zone")
    o.filter("o_orderstatus = 'O'").write.mode("append").option("header", "true").csv(f"{root}/zone")
    o.filter("o_orderstatus NOT IN ('F', 'O')").write.mode("append").parquet(f"{root}/zone")
    schema = T.StructType.fromDDL("o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
    parts = [FS.read(spark, "json", f"{root}/zone", schema, pathGlobFilter="*.json"),
             FS.read(spark, "csv", f"{root}/zone", schema, pathGlobFilter="*.csv", header="true"),
             FS.read(spark, "parquet", f"{root}/zone", schema, pathGlobFilter="*.parquet")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@case("backfill_window", check="A")
def backfill_window(spark, d):
    """Files modified after a point in time: the batch reader's
    ``_metadata.file_modification_time`` filter (file-level pruning, ms precision;
    the ``modifiedAfter`` option does the same at second precision)."""
    root = _events_landing(spark, d)
    files = ingest.list_files(spark, f"{root}/in")
    mid = files.agg(F.percentile_approx("mtime", 0.5)).first()[0]
    df = FS.read(spark, "parquet", f"{root}/in", EVENTS_SCHEMA)
    return df.filter(F.col("_metadata.file_modification_time") > F.lit(mid)).select(*EVENTS_SCHEMA.fieldNames())


@case("rate_limit", check="A")
def rate_limit(spark, d):
    root = _events_landing(spark, d)
    s = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    run_available_now(s, f"{root}/out", f"{root}/_ckpt", progress=f"{root}/progress")
    batches = read_progress(spark, f"{root}/progress").filter("num_rows > 0").count()
    return read_sink(spark, f"{root}/out").withColumn("n_batches", F.lit(batches))


@case("infer_schema", check="A")
def infer_schema(spark, d):
    root = workdir(spark, "infer")
    load(spark, d, "orders").write.json(root)
    strings = FS.infer_schema(spark, "json", root)
    typed = FS.infer_schema(spark, "json", root, typed=True)
    rows = [(f.name, f.dataType.simpleString(), typed[f.name].dataType.simpleString()) for f in strings.fields]
    return spark.createDataFrame(rows, "column string, as_string string, typed string")


@case("schema_hints", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(10, 2)) AS VARCHAR) AS o_totalprice, CAST(o_custkey AS VARCHAR) AS o_custkey
FROM orders""")
def schema_hints(spark, d):
    root = workdir(spark, "hints")
    load(spark, d, "orders").write.json(root)
    schema = FS.apply_hints(FS.infer_schema(spark, "json", root), "o_orderkey BIGINT, o_totalprice DECIMAL(10,2)")
    df = spark.read.schema(schema).json(root)
    return df.select("o_orderkey", F.col("o_totalprice").cast("string").alias("o_totalprice"), "o_custkey")


@case("evolve_add", """
SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN o_orderpriority END AS o_orderpriority FROM orders""")
def evolve_add(spark, d):
    root = workdir(spark, "evolve_add")
    o = load(spark, d, "orders")
    old = o.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey")
    new = o.filter(F.col("o_orderdate") >= F.lit("1999-01-01").cast("timestamp_ntz")).select("o_orderkey",
                                                                                             "o_orderpriority")
    old.write.parquet(f"{root}/batch=1")
    stored = spark.read.parquet(f"{root}/batch=1").schema
    new.write.parquet(f"{root}/batch=2")
    seen = spark.read.parquet(f"{root}/batch=2").schema
    schema = FS.check_new_columns(stored, seen, "addNewColumns")
    return spark.read.schema(schema).parquet(f"{root}/batch=1", f"{root}/batch=2")


def _messy_json_lines(spark, d):
    """orders as JSON lines, with an extra field every 10th key, a missing
    field, a mistyped value and a cut-off line (fixture generation)."""
    o = load(spark, d, "orders")
    k = F.col("o_orderkey")
    base = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))
    line = (F.when(k % 10 == 0, F.concat(F.expr("substr(to_json(struct(o_orderkey, o_custkey, o_orderstatus, "
                                                "o_totalprice)), 1, length(to_json(struct(o_orderkey, o_custkey, "
                                                "o_orderstatus, o_totalprice))) - 1)"),
                                         F.lit(', "channel": "web"}')))
            .when(k % 10 == 1, F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus")))
            .when(k % 10 == 2, F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus",
                                                  F.lit("n/a").alias("o_totalprice"))))
            .when(k % 10 == 3, F.expr("substr(to_json(struct(o_orderkey, o_custkey)), 1, 12)"))
            .otherwise(base))
    root = workdir(spark, "messy")
    o.select(line.alias("value")).write.text(root)
    return root


KNOWN = _schema(("o_orderkey", L_), ("o_custkey", L_), ("o_orderstatus", S_), ("o_totalprice", D_))


@case("evolve_rescue", """
SELECT CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 10 IN (1, 2, 3) THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 10 = 0 THEN 'web' END AS channel,
       CASE WHEN o_orderkey % 10 = 2 THEN 'n/a' END AS bad_price,
       o_orderkey % 10 = 3 AS corrupt
FROM orders""")
def evolve_rescue(spark, d):
    root = _messy_json_lines(spark, d)
    raw = spark.read.text(root)
    p = FS.parse_with_rescue(raw, "value", KNOWN)
    r = F.col("_rescued_data")
    return p.select("o_orderkey", "o_totalprice", F.get_json_object(r, "$.channel").alias("channel"),
                    F.get_json_object(r, "$.o_totalprice").alias("bad_price"),
                    F.coalesce(F.get_json_object(r, "$._corrupt").isNotNull(), F.lit(False)).alias("corrupt"))


@case("evolve_fail", check="A")
def evolve_fail(spark, d):
    root = _messy_json_lines(spark, d)
    seen = spark.read.json(root).schema
    try:
        FS.check_new_columns(KNOWN, seen, "failOnNewColumns")
        status = "accepted"
    except FS.NewColumnsFound as e:
        status = f"refused: {e}"
    lines = F.count(F.lit(1))
    unknown = F.count_if(F.get_json_object("value", "$.channel").isNotNull())
    return spark.read.text(root).agg(lines.alias("lines"), unknown.alias("with_new_column")).withColumn("status", F.lit(status))


@case("evolve_none", """
SELECT CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderkey END AS o_orderkey,
       CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def evolve_none(spark, d):
    root = _messy_json_lines(spark, d)
    df = spark.read.schema(KNOWN).json(root)
    return FS.conform(df, KNOWN).select("o_orderkey", "o_orderstatus")


@case("corrupt_files", """SELECT * FROM orders""")
def corrupt_files(spark, d):
    root = workdir(spark, "corrupt")
    load(spark, d, "orders").write.parquet(f"{root}/t")
    spark.createDataFrame([("not parquet",)], "v string").write.text(f"{root}/t/junk")
    return (spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
            .option("recursiveFileLookup", "true").schema(ORDERS_SCHEMA).parquet(f"{root}/t"))


@case("permissive_parse", """
SELECT CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderkey END AS o_orderkey,
       o_orderkey % 10 = 3 AS is_corrupt FROM orders""")
def permissive_parse(spark, d):
    root = _messy_json_lines(spark, d)
    schema = T.StructType(KNOWN.fields[:1] + [T.StructField("_corrupt_record", T.StringType())])
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", "_corrupt_record").json(root))
    return df.select("o_orderkey", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


@case("partition_discovery", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month FROM orders""")
def partition_discovery(spark, d):
    root = workdir(spark, "partitions")
    o = load(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"),
                                        F.month("o_orderdate").alias("month"))
    o.write.partitionBy("year", "month").parquet(root)
    return spark.read.parquet(root).select("o_orderkey", F.col("year").cast("int").alias("year"),
                                           F.col("month").cast("int").alias("month"))


@case("file_inventory", check="A")
def file_inventory(spark, d):
    root = _events_landing(spark, d)
    ingest.copy_into(spark, f"{root}/in", "parquet", f"{root}/target", f"{root}/_ledger", EVENTS_SCHEMA)
    return ingest.file_inventory(spark, f"{root}/in", f"{root}/_ledger")


@case("file_policy", check="A")
def file_policy(spark, d):
    """includeExistingFiles=false, maxFileAge and allowOverwrites over a ledger."""
    root = _events_landing(spark, d, slices=2)
    ingest.seed_ledger(spark, f"{root}/in", f"{root}/_ledger")  # existing files: skipped
    load(spark, d, "events").filter("event_type = 'click'").write.mode("append").parquet(f"{root}/in")
    fresh = ingest.pending_files(spark, f"{root}/in", f"{root}/_ledger", max_file_age_hours=24)
    by_version = ingest.pending_files(spark, f"{root}/in", f"{root}/_ledger", allow_overwrites=True)
    paths = [r.path for r in fresh.collect()]
    return (FS.read(spark, "parquet", paths, EVENTS_SCHEMA)
            .withColumn("pending_files", F.lit(len(paths)))
            .withColumn("pending_by_version", F.lit(by_version.count())))


@case("kafka_shape", """
SELECT CAST(o_orderkey AS VARCHAR) AS key, 'orders' AS topic, o_orderstatus, o_totalprice FROM orders""")
def kafka_shape(spark, d):
    recs = bus.to_bus_records(load(spark, d, "orders"), "orders", "o_orderkey", partitions=8)
    dec = bus.decode_value(recs, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
    return dec.select(F.col("key").cast("string").alias("key"), "topic", "o_orderstatus", "o_totalprice")


@case("kafka_decode", """
SELECT o_orderkey, o_custkey, o_totalprice, true AS has_offset FROM orders""")
def kafka_decode(spark, d):
    recs = bus.to_bus_records(load(spark, d, "orders"), "orders", "o_orderkey", partitions=8)
    dec = bus.decode_value(recs, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE")
    return dec.select("o_orderkey", "o_custkey", "o_totalprice",
                      (F.col("offset").isNotNull() & F.col("partition").between(0, 7)).alias("has_offset"))


@case("table_stream", """
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'""")
def table_stream(spark, d):
    root = workdir(spark, "table_stream")
    o = load(spark, d, "orders").withColumn(
        "version", F.when(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"), 1).otherwise(2))
    o.write.partitionBy("version").parquet(f"{root}/t")
    schema = spark.read.parquet(f"{root}/t").schema
    s = spark.readStream.schema(schema).parquet(f"{root}/t").filter(F.col("version") >= 2)
    run_available_now(s.select("o_orderkey", "o_orderstatus"), f"{root}/out", f"{root}/_ckpt")
    return read_sink(spark, f"{root}/out")
