"""File lineage columns from the hidden ``_metadata`` struct (batch and stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ``_source_file``, ``_source_file_ts``, ``_source_file_size``, ``_ingested_at``.

    ``df`` must come straight from a file scan so ``_metadata`` resolves.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_ts"),
        F.col("_metadata.file_size").alias("_source_file_size"),
        F.current_timestamp().alias("_ingested_at"),
    )
