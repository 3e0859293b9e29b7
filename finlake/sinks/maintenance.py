"""Table maintenance (K4, K5).

On a table-format catalog both are the format's own procedures (``CALL``).
On a path both work on a table that ``upsert`` wrote (``log_table``):
compaction packs the small files of its batches first-fit decreasing, and
expiry deletes the folders that a newer base has replaced.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from finlake.session import TARGET_FILE_BYTES
from finlake.sinks import log_table
from finlake.sinks.upsert import is_path

# Compaction and retention settings.
MIN_INPUT_FILES = 5
SNAPSHOT_RETENTION_DAYS = 3
SNAPSHOT_RETAIN_LAST = 5


def _catalog_of(name: str) -> str:
    parts = name.split(".")
    return parts[0] if len(parts) >= 3 else "spark_catalog"


def _in_catalog(name: str) -> str:
    """Table identifier relative to its catalog (what the procedures take)."""
    parts = name.split(".")
    return ".".join(parts[1:]) if len(parts) >= 3 else name


def compact(
    spark: SparkSession,
    target: str,
    keys: Sequence[str] = (),
    schema: StructType | None = None,
    target_file_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
) -> dict:
    """Bin-pack small files; reports the files and rows packed."""
    if not is_path(target):
        spark.sql(
            f"CALL {_catalog_of(target)}.system.rewrite_data_files("
            f"table => '{_in_catalog(target)}', strategy => 'binpack', options => map("
            f"'target-file-size-bytes', '{int(target_file_bytes)}', "
            f"'min-input-files', '{int(min_input_files)}'))"
        )
        return {"procedure": "rewrite_data_files"}
    return log_table.compact(spark, target, keys, target_file_bytes, min_input_files, schema)


def expire_snapshots(
    spark: SparkSession,
    target: str,
    retention_days: int = SNAPSHOT_RETENTION_DAYS,
    retain_last: int = SNAPSHOT_RETAIN_LAST,
    now: dt.datetime | None = None,
) -> dict:
    """Expire old snapshots of a table-format table; on a path, delete what
    a newer base has replaced."""
    if is_path(target):
        return {"procedure": None, "folders_deleted": log_table.vacuum(spark, target)}
    stamp = (now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)) - dt.timedelta(
        days=retention_days
    )
    spark.sql(
        f"CALL {_catalog_of(target)}.system.expire_snapshots(table => '{_in_catalog(target)}', "
        f"older_than => TIMESTAMP '{stamp:%Y-%m-%d %H:%M:%S}', retain_last => {int(retain_last)})"
    )
    return {"procedure": "expire_snapshots"}


def compact_and_expire(spark: SparkSession, target: str, keys: Sequence[str] = (), **kw) -> dict:
    out = compact(spark, target, keys, **kw)
    out.update(expire=expire_snapshots(spark, target))
    return out


def read_table(spark: SparkSession, target: str, keys: Sequence[str] = (), schema: StructType | None = None) -> DataFrame:
    """A catalog table, a table that ``upsert`` wrote to a path, or a plain
    folder of Parquet files."""
    if not is_path(target):
        return spark.read.table(target)
    if keys and log_table.exists(spark, target):
        return log_table.read(spark, target, keys, schema)
    return spark.read.schema(schema).parquet(target) if schema else spark.read.parquet(target)
