"""Session settings and the shared scratch folder.

Jobs read their scratch root from ``spark.checkpoint.dir`` (the shared folder a
cluster names there). Where it is unset a local session gets a folder of its own;
on a cluster that is an error, as each machine would write to its own disk.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings every job relies on; safe to set on a running session.
RUNTIME_CONF = {
    # date_trunc / to_date / timestamp casts are zone dependent: pin UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Starting points for a large cluster (opt-in: ``build_session(scale=True)``).
SCALE_CONF = {
    # start high and let AQE coalesce toward ~256 MB per shuffle partition:
    # a hot group still splits, small stages shrink
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # scan splits of ~256 MB (parquet splits at row-group boundaries)
    "spark.sql.files.maxPartitionBytes": "256m",
    # smaller bronze/silver files: less I/O for every full pass
    "spark.sql.parquet.compression.codec": "zstd",
    # large streaming state (redelivery within a long delay): commit RocksDB changes
    # as a log instead of a full snapshot every micro-batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "lossline",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  scale: bool = False) -> SparkSession:
    """A session with the runtime settings (and ``SCALE_CONF`` if asked)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    if scale:
        conf.update(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; set one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="lossline-ckpt-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/lossline/{purpose}-{uuid.uuid4().hex[:12]}"
