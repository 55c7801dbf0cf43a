"""Intermediate tables in the shared folder, and input sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftwood.session import configure, workdir

#: bytes of an Arrow batch between Spark and Python; each side holds a batch more than once, so Spark's own 64 MB is much of a small executor
ARROW_BYTES = "4m"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's confs and small Arrow batches."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage, survives lost executors."""
    path = workdir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """Bytes of text in the whole table (one narrow aggregate)."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def power_of_two(n: float) -> int:
    """The smallest power of two that is at least ``n``."""
    return 1 << max(0, int(-(-n // 1)) - 1).bit_length()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def packed(docs: DataFrame, keys: dict, text: str = "text") -> DataFrame:
    """``keys`` (name -> column) and ``z``, the text compressed for a shuffle (null text stays null)."""
    import pyarrow as pa
    import zstandard

    from driftwood.llm.text import lean, slices

    df = docs.select(*[c.alias(k) for k, c in keys.items()], F.col(text).cast("string").alias("z"))
    fields = T.StructType([*df.schema.fields[:-1], T.StructField("z", T.BinaryType())])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in slices(batches, "z"):
            z = pa.array([None if x is None else squeeze(x.encode()) for x in b.column("z").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], z], names=b.schema.names)

    return df.mapInArrow(lean(run), fields)


def unpacked(column) -> list[bytes]:
    """Texts of a packed column, null as empty."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    return [b"" if x is None else expand(x) for x in column.to_pylist()]
