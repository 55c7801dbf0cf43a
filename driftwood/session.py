"""Session helpers: one place for the confs every job in the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Confs the operators assume. They are all safe to set on a shared session:
# none changes results of queries that do not rely on them.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sizing_conf(shuffle_bytes: int, total_cores: int, target_partition_bytes: int = 512 << 20,
                max_split_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a large cluster.

    ``spark.sql.shuffle.partitions`` starts at max(3 x cores, shuffle bytes /
    target) so each reducer's input fits in memory without spilling heavily;
    AQE then coalesces small partitions toward the advisory size and splits
    skewed ones. Scan splits stay at ``max_split_bytes`` so one task reads a
    bounded slice of a file.
    """
    parts = max(3 * total_cores, -(-shuffle_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(max_split_bytes),
        "spark.sql.files.openCostInBytes": str(8 << 20),
    }


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "driftwood", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench. On a cluster the caller passes its own."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (as
    ``--py-files`` would): pandas UDFs and state functions defined here are
    pickled by reference and must be importable on every worker. Done once
    per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile

    import driftwood

    pkg_dir = os.path.dirname(os.path.abspath(driftwood.__file__))
    base = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="driftwood-pyfiles-"), "driftwood.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs on an existing session (idempotent) and make
    the package importable on the executors."""
    ship_package(spark)
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.streaming.stateStore"):
            continue  # static once a stream ran; set at build time
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root of the shared scratch area: the cluster's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach. Only a local run (tests) without it gets one of its own.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="driftwood-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def workdir(spark: SparkSession, name: str) -> str:
    """Fresh, unique directory under the shared root for one job run."""
    return os.path.join(shared_root(spark), "driftwood", f"{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: computed once, whatever reads it, and safe from lost executors."""
    path = workdir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
