"""Session factory (G1-G3) and session-level helpers.

The jobs build their session here; library functions never create one,
they take the caller's session and only read from it, except for
``pin_utc`` which the pipelines call because every date derivation in the
engine is defined in UTC.
"""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Fixed value: target data file size of the original deployment.
TARGET_FILE_BYTES = 128 * 1024 * 1024


def build(
    app_name: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    catalog: Mapping[str, str] | None = None,
    extra_conf: Mapping[str, str] | None = None,
) -> SparkSession:
    """Build (or get) a session with the engine's defaults.

    ``catalog`` is an optional overlay of ``spark.sql.catalog.*`` (and any
    other) keys for a table-format catalog; nothing is set when it is not
    given, so the engine runs on plain Parquet without extra jars.

    ``shuffle_partitions`` is left to the cluster unless given. The original
    deployment pinned 20, which caps every shuffle at 20 reducers: AQE can
    merge small partitions but never create more, so at 100 TB the setting
    must be sized to the data (about shuffle bytes / 128 MiB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(TARGET_FILE_BYTES),
        "spark.ui.enabled": "false",
        # checkpoint files (distributed ntile, RFM base) are removed once
        # their DataFrame is garbage-collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(int(shuffle_partitions))
    conf.update(catalog or {})
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """All date parts (to_date, year, month) are defined in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staging writes.

    Taken from the session (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``). Only a local-mode session without one gets a
    private temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="finlake-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; it must name a folder shared by all executors"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/finlake-scratch/{name}-{uuid.uuid4().hex}"
