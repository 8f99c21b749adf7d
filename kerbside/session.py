"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Adaptive execution sizes the shuffles and splits skewed join partitions at run time, so no
# partition count is written into any operator.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str, master: str | None = None, conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings above. ``master`` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch folder that this code has made itself, in whatever store it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the folder the session names in ``spark.checkpoint.dir``.

    A cluster must name a folder all executors share. Only a local session without the setting,
    as in tests, gets a temporary one.
    """
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="kerbside-")
        spark.conf.set(CHECKPOINT_CONF, base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
