"""Sinks and loads: table writes, partition overwrite modes, schema merge /
enforcement / widening, idempotent writes, format conversion, table copy and
cutover.

Tables are Parquet directories registered in the session catalog with an
explicit location, so data never lands in a machine-local warehouse folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def save_table(df: DataFrame, name: str, location: str, mode: str = "overwrite",
               partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode(mode).format("parquet").option("path", location)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return name


def ctas(spark: SparkSession, name: str, location: str, select_sql: str,
         partition_by: Sequence[str] | None = None) -> DataFrame:
    """``CREATE TABLE name USING parquet LOCATION .. AS SELECT ..``."""
    part = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} USING parquet {part} LOCATION '{location}' AS {select_sql}")
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are replaced."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def append_merge_schema(df: DataFrame, path: str) -> None:
    """Append a batch whose columns may be a superset; readers use mergeSchema."""
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)


class SchemaMismatch(Exception):
    pass


def enforce_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Schema enforcement on write: same names and types, else raise.
    (``DataFrame.to`` reorders and up-casts; we refuse any type change.)"""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"{f.name}: {have.get(f.name)} != {f.dataType}" for f in target.fields
                if f.name not in have or have[f.name] != f.dataType]
    extra = [n for n in have if n not in target.fieldNames()]
    if problems or extra:
        raise SchemaMismatch("; ".join(problems + [f"unexpected column {n}" for n in extra]))
    return df.select(*target.fieldNames())


WIDENING = {
    (T.ByteType, T.ShortType), (T.ByteType, T.IntegerType), (T.ByteType, T.LongType),
    (T.ShortType, T.IntegerType), (T.ShortType, T.LongType), (T.IntegerType, T.LongType),
    (T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType), (T.DateType, T.TimestampNTZType),
}


def widen_column(df: DataFrame, column: str, new_type: T.DataType) -> DataFrame:
    """Type widening (e.g. INT -> BIGINT); narrowing is refused."""
    old = df.schema[column].dataType
    if type(old) is not type(new_type) and (type(old), type(new_type)) not in WIDENING:
        raise SchemaMismatch(f"{column}: {old} -> {new_type} is not a widening")
    target = T.StructType([T.StructField(f.name, new_type if f.name == column else f.dataType, f.nullable)
                           for f in df.schema.fields])
    return df.to(target)


def idempotent_write(df: DataFrame, path: str, app_id: str, version: int) -> None:
    """Write a batch under ``app=<id>/batch=<version>`` with dynamic overwrite:
    replaying the same (app, version) replaces itself instead of duplicating."""
    out = df.withColumn("app", F.lit(app_id)).withColumn("batch", F.lit(int(version)))
    overwrite_partitions(out, path, ["app", "batch"])


def with_date_partitions(df: DataFrame, date_col: str) -> DataFrame:
    """Derived partition columns (year, month) from a date column."""
    return df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))


def convert_format(spark: SparkSession, src: str, src_fmt: str, dst: str, partition_by: Sequence[str],
                   schema=None, **options) -> DataFrame:
    r = spark.read.format(src_fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(src)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(dst)
    return spark.read.parquet(dst)


def table_cutover(spark: SparkSession, old: str, new_name: str, new_location: str, ts_col: str,
                  last_copy_time: str, partition_by: Sequence[str] | None = None) -> DataFrame:
    """Migration: CTAS the new layout from the old table up to ``last_copy_time``,
    copy rows that arrived after it, compare counts, then swap names. The old
    table stays as ``<old>_backup`` for rollback. Returns a report row."""
    cut = f"TIMESTAMP '{last_copy_time}'"
    ctas(spark, new_name, new_location, f"SELECT * FROM {old} WHERE {ts_col} <= {cut}", partition_by)
    spark.sql(f"INSERT INTO {new_name} BY NAME SELECT * FROM {old} WHERE {ts_col} > {cut}")
    n_old = spark.table(old).select(F.count(F.lit(1))).scalar()
    n_new = spark.table(new_name).select(F.count(F.lit(1))).scalar()
    report = spark.range(1).select(n_old.alias("rows_old"), n_new.alias("rows_new")).collect()[0]
    if report.rows_old != report.rows_new:
        raise RuntimeError(f"count mismatch {report.rows_old} != {report.rows_new}; cutover aborted")
    spark.sql(f"ALTER TABLE {old} RENAME TO {old}_backup")
    spark.sql(f"ALTER TABLE {new_name} RENAME TO {old}")
    return spark.createDataFrame([(report.rows_old, report.rows_new, True)],
                                 "rows_old long, rows_new long, swapped boolean")
