"""File sources: readers with dialect options, landing zones, schema
inference / hints / evolution policies, rescue of unknown data.

Schemas travel through the driver (they are small); data never does.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_DEFAULTS = {"header": "true", "sep": ",", "quote": '"', "escape": "\\", "encoding": "UTF-8",
                "nullValue": "", "timestampFormat": "yyyy-MM-dd HH:mm:ss", "dateFormat": "yyyy-MM-dd",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read(spark: SparkSession, fmt: str, path: str | Sequence[str], schema: T.StructType | str | None = None,
         **options) -> DataFrame:
    """Batch read of any built-in format with explicit options."""
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def read_csv(spark: SparkSession, path: str, schema=None, **options) -> DataFrame:
    return read(spark, "csv", path, schema, **{**CSV_DEFAULTS, **options})


def read_sql_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """A file path used as a SQL table: ``SELECT * FROM fmt.`path` ``."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def in_slice(col: str, lo, hi):
    """``lo < col <= hi``, an absent bound being open; a null counts to the slice without a lower bound."""
    low = F.lit(True) if lo is None else F.col(col) > F.lit(lo)
    high = F.lit(True) if hi is None else F.col(col) <= F.lit(hi)
    return F.coalesce(low & high, F.lit(lo is None))


def write_slices(df: DataFrame, path: str, fmt: str, order_col: str, slices: int = 4,
                 **options) -> list:
    """Write ``df`` into ``path`` as ``slices`` successive appends cut on
    ``order_col`` quantiles, so file modification times rise with the data
    (a landing zone that received the data over time). Returns the cut points
    (a bounded list of ``slices - 1`` values)."""
    cuts = df.agg(F.percentile_approx(order_col, [i / slices for i in range(1, slices)], 10000).alias("c")) \
        .first()["c"] if slices > 1 else []
    bounds = [None, *cuts, None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        df.filter(in_slice(order_col, lo, hi)).write.format(fmt).options(**options).mode("append").save(path)
    return cuts


#: files up to this size are read as one binary value each, larger ones in ranges
WHOLE_FILE_BYTES = 64 << 20


def scan_binary(spark: SparkSession, path: str, glob: str, whole_bytes: int = WHOLE_FILE_BYTES) -> DataFrame:
    """path, modificationTime, length and content_len (bytes read) of the files of a folder, whatever their bytes.

    A binary row holds a whole file, so one task reads it (and one above 2 GB can't be read at all). Files above ``whole_bytes`` are
    read by the splittable text source instead: the same bytes, cut at a byte that the format ends no file with (a Parquet file ends with
    ``PAR1``), so each task reads a range of at most ``spark.sql.files.maxPartitionBytes``, and the cuts are counted back in.
    """
    def files():
        return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)

    whole = files().filter(F.col("length") <= whole_bytes).select("path", "modificationTime", "length", F.length("content").alias("content_len"))
    large = files().filter(F.col("length") > whole_bytes).select("path", "modificationTime", "length", F.col("_metadata.file_path").alias("__file"))
    pieces = spark.read.option("pathGlobFilter", glob).option("lineSep", "\n").text(path).filter(F.col("_metadata.file_size") > whole_bytes)
    read = pieces.groupBy(F.col("_metadata.file_path").alias("__file")).agg((F.sum(F.octet_length("value").cast("long") + 1) - 1).alias("content_len"))
    return whole.withColumn("content_len", F.col("content_len").cast("long")).unionByName(large.join(read, "__file", "left").drop("__file"))


def write_json_documents(df: DataFrame, path: str, rows_per_doc: int = 10_000) -> None:
    """Write ``df`` as multi-line JSON: each file holds one JSON array of about
    ``rows_per_doc`` records (``multiLine`` readers parse a whole file per
    split, so documents are kept small; the document count grows with the data)."""
    buckets = max(1, -(-df.count() // rows_per_doc))
    doc = (df.withColumn("__bucket", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(buckets)))
           .groupBy("__bucket").agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")))
    doc.write.partitionBy("__bucket").text(path)


# --------------------------------------------------------------- schema policies

def infer_schema(spark: SparkSession, fmt: str, path: str, typed: bool = False,
                 sample_ratio: float = 1.0, **options) -> T.StructType:
    """Infer a schema: all STRING by default (``inferColumnTypes=false``), typed on request."""
    opts = dict(options)
    if fmt == "json":
        opts["primitivesAsString"] = "false" if typed else "true"
        opts["samplingRatio"] = str(sample_ratio)
    elif fmt == "csv":
        opts.setdefault("header", "true")
        opts["inferSchema"] = "true" if typed else "false"
        opts["samplingRatio"] = str(sample_ratio)
    return spark.read.format(fmt).options(**opts).load(path).schema


def apply_hints(schema: T.StructType, hints: str) -> T.StructType:
    """Override types of named columns with a DDL hint string
    (``"id LONG, amount DECIMAL(10,2)"``); hinted columns not in the schema are added."""
    h = T.StructType.fromDDL(hints)
    by_name = {f.name: f for f in h.fields}
    fields = [by_name.pop(f.name, f) for f in schema.fields]
    return T.StructType(fields + list(by_name.values()))


def save_schema(schema: T.StructType) -> str:
    return schema.json()


def load_schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Additive merge: old columns first, new columns appended (addNewColumns)."""
    names = {f.name for f in old.fields}
    return T.StructType(list(old.fields) + [f for f in new.fields if f.name not in names])


class NewColumnsFound(Exception):
    """failOnNewColumns: the data carries columns the stored schema lacks."""


def check_new_columns(stored: T.StructType, seen: T.StructType, mode: str = "addNewColumns") -> T.StructType:
    """Apply an evolution mode to a freshly observed schema; returns the schema to use."""
    extra = [f for f in seen.fields if f.name not in {x.name for x in stored.fields}]
    if mode == "failOnNewColumns" and extra:
        raise NewColumnsFound(", ".join(f.name for f in extra))
    if mode == "addNewColumns":
        return merge_schemas(stored, seen)
    return stored  # "none" and "rescue" keep the stored schema


def parse_with_rescue(raw: DataFrame, text_col: str, schema: T.StructType,
                      rescue_col: str = "_rescued_data") -> DataFrame:
    """Parse JSON text against ``schema``; fields that are unknown or whose
    value does not cast to the declared type go to ``rescue_col`` as JSON.
    Lines that are not JSON objects keep all-NULL fields and are rescued whole
    under ``_corrupt``."""
    kv = F.from_json(F.col(text_col), T.MapType(T.StringType(), T.StringType()))
    known = {f.name: f.dataType for f in schema.fields}
    cols: list[Column] = []
    bad_known = []
    for name, dt in known.items():
        v = F.col("__kv")[name]  # the parsed map: a line is parsed once, not once for each use
        cast = v.try_cast(dt)
        cols.append(cast.alias(name))
        bad_known.append(F.when(v.isNotNull() & cast.isNull(), F.lit(name)))
    bad = F.filter(F.array(*bad_known), lambda x: x.isNotNull())
    df = raw.withColumn("__kv", kv).withColumn("__bad", bad)
    df = df.withColumn("__rescued", F.map_filter(F.col("__kv"), lambda k, v: ~F.array_contains(F.array(*[F.lit(n) for n in known]), k)
                                                 | F.array_contains(F.col("__bad"), k)))
    rescued = F.col("__rescued")
    rescue = (F.when(F.col("__kv").isNull(), F.to_json(F.create_map(F.lit("_corrupt"), F.col(text_col))))
              .when(F.size(rescued) > 0, F.to_json(rescued)))
    return df.select(*[c for c in raw.columns if c != text_col], *cols, rescue.alias(rescue_col))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Evolution mode ``none``: keep exactly the schema's columns (extras
    dropped, missing ones NULL), cast to the declared types."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        cols.append((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def rate_stream(spark: SparkSession, rows_per_second: int | None = None, rows_per_batch: int | None = None):
    """Generated test stream: ``rate`` (rows per second) or the deterministic
    ``rate-micro-batch`` (rows per batch) source."""
    if rows_per_batch is not None:
        return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load()
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second or 1).load()


# --------------------------------------------------------------- connectors that need jars

def read_avro(spark: SparkSession, path: str, schema_json: str | None = None) -> DataFrame:
    """Avro files (needs the spark-avro module on the classpath)."""
    r = spark.read.format("avro")
    if schema_json:
        r = r.option("avroSchema", schema_json)
    return r.load(path)


def decode_avro(df: DataFrame, col: str, schema_json: str) -> DataFrame:
    """Avro-encoded binary payload (e.g. a bus value) to a struct column."""
    from pyspark.sql.avro.functions import from_avro

    return df.withColumn(col, from_avro(F.col(col), schema_json))


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None, num_partitions: int = 8,
              **properties) -> DataFrame:
    """JDBC table scan split into ``num_partitions`` range reads on
    ``partition_column`` (needs the database driver jar)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if partition_column is not None:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    for k, v in properties.items():
        r = r.option(k, v)
    return r.load()


def format_available(spark: SparkSession, fmt: str) -> bool:
    """True when a data source short name resolves on this cluster."""
    try:
        spark.read.format(fmt).load("/nonexistent-path-for-probe")
    except Exception as e:  # missing path is fine; a missing source is not
        return "DATA_SOURCE_NOT_FOUND" not in str(e) and "Failed to find data source" not in str(e)
    return True
