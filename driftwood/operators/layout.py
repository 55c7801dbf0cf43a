"""Layout and maintenance jobs on Parquet tables: compaction, sized writes,
Z-order and Hilbert clustering, per-file statistics and file skipping,
bloom filters, table statistics, obsolete-file reports and advice queries.

Jobs read and write whole tables as Spark jobs; the driver only sees file
listings (paths, sizes) and bounded lists (rank edges, per-column stats).
Rewrites go to a new directory; publishing is the caller's choice.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from driftwood import constants as C
from driftwood.operators.windows import global_running_sums
from driftwood.sources.ingest import list_files

TARGET_FILE_BYTES = C.COMPACT_TARGET_BYTES


def data_files(spark: SparkSession, path: str) -> DataFrame:
    """Parquet data files under a table directory (path, size, mtime)."""
    return list_files(spark, path, glob="*.parquet")


def file_count_and_bytes(spark: SparkSession, path: str) -> tuple[int, int]:
    r = data_files(spark, path).agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    return int(r.n), int(r.b or 0)


def compact(spark: SparkSession, src: str, dst: str, target_bytes: int = TARGET_FILE_BYTES,
            partition_by: Sequence[str] | None = None, where: str | None = None) -> DataFrame:
    """Small-file compaction: total bytes / target -> file count -> one
    shuffle -> rewrite to ``dst``. ``where`` compacts only a slice (its
    partitions are rewritten with dynamic overwrite). Returns a report row."""
    n_before, size = file_count_and_bytes(spark, src)
    df = spark.read.parquet(src)
    if where:
        df = df.filter(where)
    n_out = max(1, math.ceil(size / target_bytes))
    if partition_by:
        out = df.repartition(n_out, *partition_by)
        (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(dst))
    else:
        df.repartition(n_out).write.mode("overwrite").parquet(dst)
    n_after, size_after = file_count_and_bytes(spark, dst)
    return spark.createDataFrame([(n_before, n_after, size, size_after)],
                                 "files_before long, files_after long, bytes_before long, bytes_after long")


def compact_slice(spark: SparkSession, path: str, partition_by: Sequence[str], where: str,
                  target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Compaction of the partitions of a table that match ``where`` (over its partition columns), in place.

    A REBALANCE on the partition columns aims at ``target_bytes``, merging small pieces and splitting large ones, so one partition value may
    fill several tasks and files; the job's commit replaces the slice's partitions by dynamic overwrite, all others stay as
    they are. Returns files and bytes of the slice before and after."""
    from driftwood.operators.joins import session_with

    target = session_with(spark, {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
                                  "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"})
    table = target.read.parquet(path)
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
    slice_ = table.filter(where)
    folders = f"{path.rstrip('/')}_slice-{uuid.uuid4().hex[:12]}"
    slice_.select(folder.alias("folder")).distinct().write.parquet(folders)  # read before and after its files are replaced
    chosen = spark.read.schema("folder string").parquet(folders)

    def size(state: str) -> DataFrame:
        files = data_files(spark, path).withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")).join(chosen, "folder", "left_semi")
        return files.agg(F.count(F.lit(1)).alias(f"files_{state}"), F.coalesce(F.sum("size"), F.lit(0)).alias(f"bytes_{state}"))

    before = [tuple(r) for r in size("before").collect()]
    (slice_.hint("rebalance", *[F.col(c) for c in partition_by]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    report = spark.createDataFrame(before, "files_before long, bytes_before long")
    return report.join(size("after"))


def sized_write(df: DataFrame, path: str, max_records_per_file: int | None = None,
                partitions: int | None = None) -> None:
    """Right-sized files: a REBALANCE (AQE splits/merges to the advisory size)
    and an optional row cap per file."""
    out = df.hint("rebalance", partitions) if partitions else df.hint("rebalance")
    w = out.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def auto_compact(spark: SparkSession, path: str, small_bytes: int = C.AUTO_COMPACT_TARGET_BYTES,
                 min_num_files: int = 50, since=None) -> DataFrame:
    """Post-write compaction trigger: when at least ``min_num_files`` small
    files (newer than ``since``) exist, they are merged into new files and
    the report says which files were replaced (their removal is the caller's
    publish step)."""
    files = data_files(spark, path).filter(F.col("size") < small_bytes)
    if since is not None:
        files = files.filter(F.col("mtime") > F.lit(since))
    picked = [r.path for r in files.select("path").collect()]  # listing only
    if len(picked) < min_num_files:
        return spark.createDataFrame([(len(picked), 0)], "small_files long, files_written long")
    size = sum(r.size for r in files.select("size").collect())
    n_out = max(1, math.ceil(size / small_bytes))
    spark.read.parquet(*picked).repartition(n_out).write.mode("append").parquet(f"{path.rstrip('/')}_compacted")
    return spark.createDataFrame([(len(picked), n_out)], "small_files long, files_written long")


# -------------------------------------------------------------- space-filling curves

#: largest number of bits of a rank: 2^bits edges a key are sent to the tasks (8 MB of numbers at most)
MAX_RANK_BITS = 20


def _sort_key(df: DataFrame, name: str) -> Column:
    """A bigint, double or string in the order of the column (decimals by their nearest double, so close ones may tie)."""
    kind, c = df.schema[name].dataType.simpleString(), F.col(name)
    if kind in ("boolean", "tinyint", "smallint", "int", "bigint"):
        return c.cast("long")
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(c.cast("timestamp"))
    if kind in ("float", "double") or kind.startswith("decimal"):
        return c.cast("double")
    if kind == "binary":
        return F.hex(c)
    if kind == "string":
        return c
    raise ValueError(f"no curve order for {name} of type {kind}")


def rank_edges(df: DataFrame, name: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort keys at which the rank changes, ascending, and the ranks from there on (at most 2^bits of each).

    The rank of a value is floor(2^bits * share of the non-null rows below it), exact: rows are counted per value (a hot value
    is one row from the map side on), values are summed up inside range partitions and shifted by the totals of
    earlier ones.
    """
    counts = df.select(_sort_key(df, name).alias("__v")).filter("__v IS NOT NULL").groupBy("__v").agg(F.count(F.lit(1)).alias("__n"))
    below = global_running_sums(counts, ["__v"], {"__n": ("__below", "__total")})
    rank = F.least(F.lit((1 << bits) - 1), F.floor(F.col("__below") / F.col("__total") * F.lit(1 << bits)))
    edges = below.groupBy(rank.alias("__rank")).agg(F.min("__v").alias("__v")).orderBy("__rank").toArrow()
    return edges["__v"].to_numpy(), edges["__rank"].to_numpy()


def _rank_lookup(given):
    @F.pandas_udf("long")
    def rank(keys: pd.Series) -> pd.Series:
        edges, of = given.value
        at = np.searchsorted(edges, keys.to_numpy(dtype=edges.dtype), side="right") - 1
        return pd.Series(of[np.maximum(at, 0)])

    return rank


def rank_bits(df: DataFrame, cols: Sequence[str], bits: int = 16) -> DataFrame:
    """``df`` with ``__r_<column>``, the column's equi-depth rank in [0, 2^bits) (see ``rank_edges``); null has rank 0 and
    equal values have equal ranks. Rows are not shuffled: tasks look values up in the sorted edges, a batch at a time."""
    if not 1 <= bits <= MAX_RANK_BITS:
        raise ValueError(f"1 to {MAX_RANK_BITS} bits")
    sc = df.sparkSession.sparkContext
    out = df
    for c in cols:
        values, ranks = rank_edges(df, c, bits)
        if not len(values):
            out = out.withColumn(f"__r_{c}", F.lit(0).cast("long"))
            continue
        rank, key = _rank_lookup(sc.broadcast((values, ranks))), _sort_key(df, c)
        any_value = F.lit("" if values.dtype == object else 0).cast(df.select(key).schema[0].dataType)
        out = out.withColumn(f"__r_{c}", F.when(key.isNull(), F.lit(0).cast("long")).otherwise(rank(F.coalesce(key, any_value))))
    return out


def _spread_table(bits: int, n: int) -> Column:
    """Literal array: entry v (1-based v + 1) is v with its bits moved to
    positions 0, n, 2n, ... (generated by rule, 2^bits entries)."""
    def spread(v: int) -> int:
        return sum(((v >> b) & 1) << (b * n) for b in range(bits))

    return F.array(*[F.lit(spread(v)).cast("long") for v in range(1 << bits)])


def zorder_value(cols: Sequence[Column], bits: int) -> Column:
    """Interleave the bits of the ranks: bit ``b`` of column ``j`` goes to
    position ``b * n + j`` (the first column takes the lowest bit of each group).
    Bits are spread by lookups in a generated table, eight at a time."""
    n, step = len(cols), min(bits, 8)
    table = _spread_table(step, n)
    z = F.lit(0).cast("long")
    for j, c in enumerate(cols):
        for low in range(0, bits, step):
            part = F.shiftright(c, low).bitwiseAND(F.lit((1 << step) - 1).cast("long"))
            z = z.bitwiseOR(F.shiftleft(F.element_at(table, (part + F.lit(1)).cast("int")), low * n + j))
    return z


def _lit(v: int) -> Column:
    return F.lit(v).cast("long")


def hilbert_value(df: DataFrame, cols: Sequence[str], bits: int, out: str = "__h") -> DataFrame:
    """Hilbert index of n columns of ``bits``-bit integers (n <= 4), as column
    expressions: Skilling's axes-to-transpose, then bit interleave. Each step
    is one projection so expressions never nest deeper than one step."""
    n = len(cols)
    if not 1 <= n <= 4 or n * bits > 62:
        raise ValueError("up to 4 keys and n * bits <= 62")
    X = [f"__x{i}" for i in range(n)]
    df = df.withColumns({X[i]: F.col(c).cast("long") for i, c in enumerate(cols)})
    M = 1 << (bits - 1)
    q = M
    while q > 1:
        p = q - 1
        for i in range(n):
            x0, xi = F.col(X[0]), F.col(X[i])
            hit = xi.bitwiseAND(_lit(q)) != 0
            t = x0.bitwiseXOR(xi).bitwiseAND(_lit(p))
            if i == 0:
                df = df.withColumn(X[0], F.when(hit, x0.bitwiseXOR(_lit(p))).otherwise(x0))
            else:
                df = df.withColumns({X[0]: F.when(hit, x0.bitwiseXOR(_lit(p))).otherwise(x0.bitwiseXOR(t)),
                                     X[i]: F.when(hit, xi).otherwise(xi.bitwiseXOR(t))})
        q >>= 1
    for i in range(1, n):
        df = df.withColumn(X[i], F.col(X[i]).bitwiseXOR(F.col(X[i - 1])))
    df = df.withColumn("__t", _lit(0))
    q = M
    while q > 1:  # one projection per step: the running value is never duplicated
        df = df.withColumn("__t", F.when(F.col(X[n - 1]).bitwiseAND(_lit(q)) != 0,
                                         F.col("__t").bitwiseXOR(_lit(q - 1))).otherwise(F.col("__t")))
        q >>= 1
    df = df.withColumns({x: F.col(x).bitwiseXOR(F.col("__t")) for x in X})
    h = _lit(0)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            h = F.shiftleft(h, 1).bitwiseOR(F.shiftright(F.col(X[i]), b).bitwiseAND(_lit(1)))
    return df.withColumn(out, h).drop(*X, "__t")


def curve_bits(n_keys: int, files: int) -> int:
    """Bits of a rank for a curve over ``n_keys`` keys cut into ``files`` files: 16, or so many that a file spans 16 ranks of a
    key alone, as far as the curve's 62 bits and ``MAX_RANK_BITS`` go (15 for four keys)."""
    return min(62 // n_keys, MAX_RANK_BITS, max(16, (files - 1).bit_length() + 4))


def cluster_by_curve(df: DataFrame, cols: Sequence[str], curve: str = "zorder", bits: int | None = None,
                     files: int | None = None) -> DataFrame:
    """Rows ordered along a Z-order or Hilbert curve of the ranked keys, range-partitioned so each output file covers one
    stretch of the curve. A hash of the row ends the order, so rows that share all keys fill several files if they are many.
    ``files``: as many as shuffle partitions unless given (``cluster_table`` takes them from bytes)."""
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = bits or curve_bits(len(cols), n)
    hashed = [f.name for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    r = rank_bits(df, cols, bits)
    rc = [f"__r_{c}" for c in cols]
    if curve == "zorder":
        r = r.withColumn("__curve", zorder_value([F.col(c) for c in rc], bits))
    elif curve == "hilbert":
        # the numpy form is ~8x faster than the column-expression form at the
        # same result (tests assert they agree)
        r = hilbert_value_vectorised(r, rc, bits, "__curve")
    else:
        raise ValueError(curve)
    return r.repartitionByRange(n, F.col("__curve"), F.xxhash64(*hashed)).sortWithinPartitions("__curve").drop(*rc)


def cluster_table(spark: SparkSession, src: str, dst: str, cols: Sequence[str], curve: str = "zorder",
                  file_bytes: int = C.AUTO_COMPACT_TARGET_BYTES, columns: Sequence[str] | None = None) -> int:
    """Parquet table ``src`` (or some of its columns) written to ``dst`` along a curve, in files of about ``file_bytes`` by the size
    of ``src``; returns their number."""
    _, size = file_count_and_bytes(spark, src)
    files = max(1, math.ceil(size / file_bytes))
    df = spark.read.parquet(src)
    df = df.select(*columns) if columns else df
    cluster_by_curve(df, cols, curve, files=files).drop("__curve").write.parquet(dst)
    return files


# -------------------------------------------------------------- file statistics

def file_stats(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per data file: row count and per-column min, max, null count (of all
    columns, or those named), from the ``_metadata.file_path`` of each row."""
    cs = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("num_records")]
    for c in cs:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"),
                 F.count_if(F.col(c).isNull()).alias(f"nulls_{c}")]
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(*aggs)


def files_for_range(stats: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Kept/skipped flag per file for ``lo <= col <= hi`` from its min/max."""
    keep = F.lit(True)
    if lo is not None:
        keep = keep & (F.col(f"max_{col}") >= F.lit(lo))
    if hi is not None:
        keep = keep & (F.col(f"min_{col}") <= F.lit(hi))
    return stats.select("file_path", keep.alias("kept"))


def read_kept(spark: SparkSession, kept: DataFrame, predicate: str) -> DataFrame:
    """Read only the kept files (paths list is bounded by the file count)."""
    paths = [r.file_path for r in kept.filter("kept").select("file_path").collect()]
    return spark.read.parquet(*paths).filter(predicate)


def clustering_score(stats: DataFrame, col: str) -> DataFrame:
    """Clustering health in [0, 1] on ``col`` (definition ours): 1 minus the
    share of the files' summed [min, max] lengths that is covered more than
    once. Disjoint files score 1.0. Computed with a sweep over the per-file
    table ordered by ``min`` (running max of ``max``), so no file pairs are
    formed, and by range partitions, so no task sees all files."""
    from driftwood.operators.windows import running_max

    s = stats.select(F.col(f"min_{col}").cast("double").alias("lo"), F.col(f"max_{col}").cast("double").alias("hi"),
                     "file_path")
    s = running_max(s, ["lo", "hi", "file_path"], "hi", "prev_hi")
    new_cover = F.greatest(F.lit(0.0), F.col("hi") - F.greatest(F.col("lo"), F.coalesce("prev_hi", F.col("lo"))))
    agg = s.agg(F.sum(F.col("hi") - F.col("lo")).alias("total"), F.sum(new_cover).alias("union"))
    return agg.select(F.round(F.coalesce(F.col("union") / F.nullif(F.col("total"), F.lit(0.0)), F.lit(1.0)), 4)
                      .alias("score"), "total", "union")


# -------------------------------------------------------------- catalog statistics

def analyze_table(spark: SparkSession, table: str, columns: Sequence[str] | None = None,
                  noscan: bool = False, all_columns: bool = False, partition: str | None = None) -> DataFrame:
    """``ANALYZE TABLE [PARTITION (..)] COMPUTE STATISTICS [NOSCAN | FOR COLUMNS ..
    | FOR ALL COLUMNS]``, then the table statistics as rows (DESCRIBE EXTENDED).
    Column statistics feed the cost-based optimizer (``spark.sql.cbo.enabled``)."""
    part = f" PARTITION ({partition})" if partition else ""
    base = f"ANALYZE TABLE {table}{part} COMPUTE STATISTICS"
    if noscan:
        spark.sql(f"{base} NOSCAN")
    else:
        spark.sql(base)
        if all_columns and not partition:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        elif columns and not partition:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    return spark.sql(f"DESCRIBE EXTENDED {table}").filter(F.col("col_name") == "Statistics")


def column_stats(spark: SparkSession, table: str, column: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table} {column}")


def stats_rows(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The catalog's column statistics (after ANALYZE ... FOR COLUMNS), one row for each column: type, min, max, num_nulls,
    distinct_count (an estimate), avg_col_len, max_col_len and the histogram's height and bins, null where the catalog has none."""
    names = ("data_type", "min", "max", "num_nulls", "distinct_count", "avg_col_len", "max_col_len", "histogram")
    rows = []
    for c in columns or spark.table(table).columns:  # catalog entries, a few for each column
        told = column_stats(spark, table, f"`{c}`").collect()
        got = {r["info_name"]: None if r["info_value"] == "NULL" else r["info_value"] for r in told}
        bins = [r["info_name"] + ": " + (r["info_value"] or "") for r in told if r["info_name"].startswith("bin_")]
        got["histogram"] = "; ".join([x for x in (got.get("histogram"), *bins) if x]) or None
        rows.append((c, *[got.get(n) for n in names]))
    raw = spark.createDataFrame(rows, "column_name string, " + ", ".join(f"{n} string" for n in names))
    return raw.withColumns({n: F.col(n).cast("long") for n in ("num_nulls", "distinct_count", "avg_col_len", "max_col_len")})


def table_stats_rollup(spark: SparkSession, path: str) -> DataFrame:
    """numFiles, bytes and average file size from the file listing."""
    return data_files(spark, path).agg(F.count(F.lit(1)).alias("num_files"), F.sum("size").alias("size_bytes"),
                                       F.round(F.avg("size"), 1).alias("avg_file_bytes"))


def stale_stats(spark: SparkSession, table: str, threshold_pct: float = 20.0) -> DataFrame:
    """Rows now vs rows recorded by the last ANALYZE; stale above the threshold,
    or when the statistics are gone (a write without auto-update drops them)."""
    stat = spark.sql(f"DESCRIBE EXTENDED {table}").filter(F.col("col_name") == "Statistics").select(
        F.max(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("long")).alias("analyzed_rows"))
    now = spark.table(table).select(F.count(F.lit(1))).scalar()
    return stat.select("analyzed_rows", now.alias("current_rows")).withColumn(
        "stale", F.coalesce(F.abs(F.col("current_rows") - F.col("analyzed_rows")) * 100.0
                            / F.nullif(F.col("analyzed_rows"), F.lit(0)) > threshold_pct, F.lit(True)))


def retention_advice(rollup: DataFrame, rules=C.RETENTION_RULES) -> DataFrame:
    """Retention days and purge schedule by file count (``constants.RETENTION_RULES``)."""
    n = F.col("num_files")
    days = sched = None
    for limit, d, when in rules:
        if limit is None:
            days, sched = days.otherwise(d), sched.otherwise(when)
        elif days is None:
            days, sched = F.when(n < limit, d), F.when(n < limit, when)
        else:
            days, sched = days.when(n < limit, d), sched.when(n < limit, when)
    return rollup.select("*", days.alias("retain_days"), sched.alias("vacuum_schedule"))


def partition_health(spark: SparkSession, path: str, min_bytes: int = C.PARTITION_MIN_BYTES,
                     max_files: int = C.PARTITION_MAX_FILES) -> DataFrame:
    """Bytes and files per partition directory with sizing alerts."""
    f = data_files(spark, path).withColumn("partition", F.regexp_extract("path", r"^(.*)/[^/]+$", 1))
    g = f.groupBy("partition").agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    return g.withColumn("too_small", F.col("bytes") < min_bytes).withColumn("too_many_files", F.col("files") > max_files)


def hash_bucket(df: DataFrame, keys: Sequence[str], buckets: int, name: str = "bucket") -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int"))


def purge_marked(df: DataFrame, marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows without a delete mark (rewrite of the table without them)."""
    return df.join(marks.select(*keys).distinct(), list(keys), "left_anti")


def _hilbert_numpy(cols, bits: int):
    """Skilling's axes-to-transpose on numpy int64 arrays, then bit interleave
    (vectorised over an Arrow batch)."""
    import numpy as np

    X = [np.asarray(c, dtype=np.int64).copy() for c in cols]
    n = len(X)
    M = 1 << (bits - 1)
    q = M
    while q > 1:
        p = q - 1
        for i in range(n):
            hit = (X[i] & q) != 0
            t = (X[0] ^ X[i]) & p
            if i == 0:
                X[0] = np.where(hit, X[0] ^ p, X[0])
            else:
                x0 = np.where(hit, X[0] ^ p, X[0] ^ t)
                X[i] = np.where(hit, X[i], X[i] ^ t)
                X[0] = x0
        q >>= 1
    for i in range(1, n):
        X[i] = X[i] ^ X[i - 1]
    t = np.zeros_like(X[0])
    q = M
    while q > 1:
        t = np.where((X[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    X = [x ^ t for x in X]
    h = np.zeros_like(X[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            h = (h << 1) | ((X[i] >> b) & 1)
    return h


def hilbert_value_vectorised(df: DataFrame, cols: Sequence[str], bits: int, out: str = "__h") -> DataFrame:
    """Same index as ``hilbert_value``, computed by a pandas UDF over Arrow
    batches with numpy bit operations (a small per-batch helper; Spark still
    partitions and shuffles the work)."""
    from pyspark.sql import types as T

    n = len(cols)
    if not 1 <= n <= 4 or n * bits > 62:
        raise ValueError("up to 4 keys and n * bits <= 62")

    @F.pandas_udf(T.LongType())
    def hilbert(keys: pd.DataFrame) -> pd.Series:
        return pd.Series(_hilbert_numpy([keys[c].to_numpy() for c in keys.columns], bits))

    return df.withColumn(out, hilbert(F.struct(*[F.col(c).cast("long").alias(f"k{i}") for i, c in enumerate(cols)])))
