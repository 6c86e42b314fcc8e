"""Session settings the semantics depend on, and the shared scratch folder."""

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

from escrutinio.folders import remove_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SCRATCH: dict[str, list[str]] = {}
_STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def configure(spark: SparkSession) -> SparkSession:
    """Vote timestamps are UTC text without a zone, so the session zone must be UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def configure_state(spark: SparkSession) -> SparkSession:
    """Keep streaming state in RocksDB (off heap, incremental uploads) unless a provider was chosen."""
    configure(spark)
    if not spark.conf.get(_STATE_PROVIDER, ""):
        spark.conf.set(_STATE_PROVIDER, ROCKSDB)
        spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one that all executors see.

    That is the one named in ``spark.checkpoint.dir``, else the checkpoint folder of the
    context. A local master without either (a test) gets a temporary folder; on a cluster
    that is an error. ``remove_scratch`` deletes what a session has made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="escrutinio-")
    path = f"{base.rstrip('/')}/escrutinio-{purpose}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders of this application; results that still read them are lost."""
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        remove_folder(spark, path)
