"""Message-bus shapes: records with (key, value, topic, partition, offset,
timestamp) and their decoding.

The Kafka connector jar is not on this machine, so the shape is produced from
tables and the decode path is the same one a ``format("kafka")`` stream feeds.
``read_kafka`` is the real reader for clusters that ship the connector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KAFKA_OPTIONS = ("subscribe", "subscribePattern", "assign", "startingOffsets", "endingOffsets",
                 "maxOffsetsPerTrigger", "minPartitions", "failOnDataLoss")


def read_kafka(spark: SparkSession, servers: str, stream: bool = True, **options) -> DataFrame:
    """``format("kafka")`` reader (needs the connector jar)."""
    r = (spark.readStream if stream else spark.read).format("kafka").option("kafka.bootstrap.servers", servers)
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()


def to_bus_records(df: DataFrame, topic: str, key_col: str, partitions: int = 8,
                   ts_col: str | None = None, partitioner: str = "hash") -> DataFrame:
    """Rows as bus records: JSON value, key bytes, partition (``hash`` of the
    key, or ``modulo`` of an integer key) and a per-partition offset in key
    order (the order a producer would write)."""
    if partitioner == "modulo":
        part = F.pmod(F.col(key_col), F.lit(partitions)).cast("int")
    else:
        part = F.pmod(F.xxhash64(F.col(key_col)), F.lit(partitions)).cast("int")
    rec = df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"), part.alias("partition"),
        (F.col(ts_col).cast("timestamp") if ts_col else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("timestampType"), F.col(key_col).alias("__k"))
    # offsets per bus partition: skew-safe numbering (a partition is never sorted in one task)
    from driftwood.operators.windows import keyed_row_number

    numbered = keyed_row_number(rec, ["partition"], ["__k"], "__rn")
    return numbered.withColumn("offset", (F.col("__rn") - 1).cast("long")).drop("__k", "__rn")


def decode_value(records: DataFrame, schema: str | T.StructType, keep_meta: bool = True) -> DataFrame:
    """``from_json(value as string)`` expanded to columns, plus bus metadata."""
    parsed = records.withColumn("data", F.from_json(F.col("value").cast("string"), schema))
    meta = ["key", "topic", "partition", "offset", "timestamp"] if keep_meta else []
    return parsed.select(*meta, "data.*")


def to_kafka_value(df: DataFrame, key_col: str | None, topic: str) -> DataFrame:
    """Frame a DataFrame for a bus sink: value = JSON of the row, optional key."""
    cols = [F.to_json(F.struct(*df.columns)).alias("value"), F.lit(topic).alias("topic")]
    if key_col:
        cols.insert(0, F.col(key_col).cast("string").alias("key"))
    return df.select(*cols)


BUS_FORMATS = {"kafka": "kafka", "eventhubs": "kafka", "kinesis": "kinesis", "pulsar": "pulsar"}


def read_bus(spark: SparkSession, kind: str, stream: bool = True, **options) -> DataFrame:
    """Other buses behind one reader: Event Hubs through its Kafka endpoint,
    Kinesis and Pulsar through their own formats (vendor jars needed). The
    decode path (``decode_value``) is the same for all."""
    r = (spark.readStream if stream else spark.read).format(BUS_FORMATS[kind])
    for k, v in options.items():
        r = r.option(k, str(v))
    return r.load()


def write_kafka(df: DataFrame, servers: str, topic: str, key_col: str | None = None, checkpoint: str | None = None):
    """Bus sink: value = JSON of the row, optional key (connector jar needed).
    Streaming frames need a checkpoint; batch frames are written once."""
    out = to_kafka_value(df, key_col, topic)
    if df.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    return None
