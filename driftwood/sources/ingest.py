"""Idempotent bulk loads of new files (ledger keyed by file path) and file
inventories.

A load lists the source directory with the ``binaryFile`` reader (only
path, size and modification time are read), removes paths already in the
ledger with a left-anti join, writes the load's id and files to the intents
beside the ledger, reads the files on the executors, publishes them into the
``load_id=`` partition of the target, and only then appends the paths to the
ledger. After a crash the next run first repeats the loads that have an intent
and no ledger entry, with the same id and files, so they overwrite what the
crash left; files that arrived since are a load of their own.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood import constants as C
from driftwood.sources import files as FS
from driftwood.sources.lineage import with_lineage

LEDGER_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("size", T.LongType()),
    T.StructField("mtime", T.TimestampType()), T.StructField("load_id", T.StringType()),
    T.StructField("loaded_at", T.TimestampType()),
])
INTENT_SCHEMA = T.StructType(LEDGER_SCHEMA.fields[:3])


def list_files(spark: SparkSession, source: str | Sequence[str], glob: str | None = None,
               modified_after: str | None = None, modified_before: str | None = None,
               recursive: bool = True) -> DataFrame:
    """(path, size, mtime) of the files under ``source`` without reading them."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        r = r.option("pathGlobFilter", glob)
    if modified_after:
        r = r.option("modifiedAfter", modified_after)
    if modified_before:
        r = r.option("modifiedBefore", modified_before)
    df = r.load(source if isinstance(source, str) else list(source))
    return df.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def _read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, empty if there is none yet; any other failure is raised."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    return _read_if_there(spark, ledger, LEDGER_SCHEMA)


_REPORT = "load_id string, num_files long, num_affected_rows long, num_inserted_rows long"


def copy_into(spark: SparkSession, source: str | Sequence[str], fmt: str, target: str, ledger: str | None = None,
              schema: T.StructType | str | None = None, force: bool = False, glob: str | None = None,
              transform: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """Load files not yet loaded into ``target``; returns a one-row report
    (load_id, num_files, num_affected_rows, num_inserted_rows). A rerun with
    nothing new returns zeros, which is success. ``force`` reloads everything
    under a fresh id (duplicates by design, each time). The ledger defaults to
    ``target/_ledger`` (hidden from readers of the target), so dropping the
    target drops its ledger; loads in progress stand in ``<ledger>_intents``."""
    ledger = ledger or f"{target.rstrip('/')}/_ledger"
    intents = f"{ledger.rstrip('/')}_intents"

    def load(load_id: str) -> tuple[str, int, int]:
        files = spark.read.schema(INTENT_SCHEMA).parquet(f"{intents}/id={load_id}")
        paths = [r.path for r in files.select("path").toLocalIterator()]  # the reader takes a list of names
        data = with_lineage(FS.read(spark, fmt, paths, schema, **options))
        if transform is not None:
            data = transform(data)
        obs = Observation(f"copy_{load_id}")
        data = data.observe(obs, F.count(F.lit(1)).alias("rows"))
        data.write.mode("overwrite").parquet(f"{target.rstrip('/')}/load_id={load_id}")
        files.withColumns({"load_id": F.lit(load_id), "loaded_at": F.current_timestamp()}).write.mode("append").parquet(ledger)
        return load_id, len(paths), obs.get["rows"]

    ids = T.StructType([*INTENT_SCHEMA.fields, T.StructField("id", T.StringType())])
    begun = _read_if_there(spark, intents, ids).select("id").distinct()
    open_ = begun.join(read_ledger(spark, ledger).select(F.col("load_id").alias("id")).distinct(), "id", "left_anti")
    done = [load(r.id) for r in open_.orderBy("id").collect()]  # interrupted loads
    listing = list_files(spark, source, glob)
    new = listing if force else listing.join(read_ledger(spark, ledger).select("path"), "path", "left_anti")
    load_id = uuid.uuid4().hex[:16]
    if not new.isEmpty():
        new.select("path", "size", "mtime").write.parquet(f"{intents}/id={load_id}")
        done.append(load(load_id))
    rows = sum(n for _, _, n in done)
    return spark.createDataFrame([(done[-1][0] if done else "", sum(n for _, n, _ in done), rows, rows)], _REPORT)


def load_history(spark: SparkSession, ledger: str) -> DataFrame:
    """One row per load: files, bytes, first and last load time."""
    return read_ledger(spark, ledger).groupBy("load_id").agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("size").alias("bytes"),
        F.min("loaded_at").alias("loaded_at"))


def file_inventory(spark: SparkSession, source: str, ledger: str) -> DataFrame:
    """Files under ``source`` with their ledger state (path, size, mtime, discovered, load_id)."""
    led = read_ledger(spark, ledger).select("path", "load_id", "loaded_at")
    return list_files(spark, source).join(led, "path", "left").withColumn(
        "discovered", F.col("load_id").isNotNull())


def orphan_files(spark: SparkSession, table_dir: str, live_paths: DataFrame, retain_hours: int = C.VACUUM_RETAIN_HOURS,
                 now_col=None, allow_short_retention: bool = False) -> DataFrame:
    """Files under a table directory that no live path references and that are
    older than the retention: a purge plan, nothing is deleted."""
    if retain_hours < C.VACUUM_RETAIN_HOURS and not allow_short_retention:
        raise ValueError(f"retention under {C.VACUUM_RETAIN_HOURS} hours needs allow_short_retention=True")
    now = now_col if now_col is not None else F.current_timestamp()
    listing = list_files(spark, table_dir).filter(~F.regexp_extract("path", "([^/]*)$", 1).startswith("_"))
    stale = listing.join(live_paths.select("path"), "path", "left_anti")
    return stale.filter(F.col("mtime") < now - F.make_dt_interval(hours=F.lit(retain_hours)))


def seed_ledger(spark: SparkSession, source: str, ledger: str, glob: str | None = None) -> int:
    """``includeExistingFiles = false``: record the files present now as already
    seen, so only files arriving later are loaded. Returns the count seeded."""
    files = list_files(spark, source, glob).withColumn("load_id", F.lit("seed")).withColumn(
        "loaded_at", F.current_timestamp())
    files.write.mode("append").parquet(ledger)
    return read_ledger(spark, ledger).filter(F.col("load_id") == "seed").count()


def pending_files(spark: SparkSession, source: str, ledger: str, max_file_age_hours: float | None = None,
                  allow_overwrites: bool = False, glob: str | None = None) -> DataFrame:
    """Files a load would pick up under the file policy: not in the ledger
    (by path, or by (path, mtime) when ``allow_overwrites`` lets a rewritten
    file load again) and not older than ``max_file_age_hours``."""
    listing = list_files(spark, source, glob)
    keys = ["path", "mtime"] if allow_overwrites else ["path"]
    new = listing.join(read_ledger(spark, ledger).select(*keys), keys, "left_anti")
    if max_file_age_hours is not None:
        new = new.filter(F.col("mtime") >= F.current_timestamp() - F.make_dt_interval(
            secs=F.lit(float(max_file_age_hours) * 3600)))
    return new
