"""Keyed upsert.

Three targets:

* a catalog table of a format with row-level operations: created with
  ``writeTo(..).create()`` when absent (``tableExists``, never replace), else
  a SQL ``MERGE INTO``;
* any other catalog table whose partition columns are merge keys: only the
  partitions of the source's rows are read, merged and written again by
  Spark's dynamic partition overwrite;
* a path: a table that is appended to and merged on read (``log_table``).

All check that source keys are unique first (a MERGE with two source rows
for one target row is ambiguous) and return real counts.
"""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.operators.merge import duplicate_keys, merge_counts, merge_rows
from finlake.sinks import log_table


class DuplicateKeyError(ValueError):
    """The upsert source holds a merge key more than once."""


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def check_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    dup = duplicate_keys(source, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate merge key in source: {dup[0].asDict()}")


def upsert(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    merge_keys: Sequence[str],
    partition_cols: Sequence[str] | None = None,
    check_unique: bool = True,
    counts: bool = True,
    token: str | None = None,
    provider: str | None = None,
) -> dict:
    """Upsert ``source`` into ``target`` on ``merge_keys``; returns
    ``{"rows_inserted", "rows_updated", "created"}``.

    For a path, ``counts=False`` leaves out the look-up of the source's keys
    in the table (then ``rows_written`` is returned), and ``token`` names the
    batch, so that a replay replaces it. For a catalog table ``provider`` is
    the format it is created in (the catalog's default if None) and its
    namespace is created too.
    """
    keys, parts = list(merge_keys), list(partition_cols or [])
    # read more than once (unique check, counts, write): computed once
    owned = not source.is_cached and (check_unique or counts or not is_path(target))
    src = source.persist(StorageLevel.MEMORY_AND_DISK) if owned else source
    try:
        if check_unique:
            check_unique_keys(src, keys)
        if is_path(target):
            return _upsert_path(spark, src, target, keys, counts, token)
        return _upsert_table(src, target, keys, parts, provider)
    finally:
        if owned:
            src.unpersist()


def _upsert_path(spark: SparkSession, src: DataFrame, path: str, keys: list[str], counts: bool, token: str | None) -> dict:
    updated = log_table.existing_keys(spark, path, src, keys, src.schema).count() if counts else 0
    out = log_table.append(spark, src, path, keys, token)
    if not counts:
        return {"rows_written": out["rows_written"], "created": out["created"]}
    return {"rows_inserted": out["rows_written"] - updated, "rows_updated": updated, "created": out["created"]}


def _row_level(spark: SparkSession, name: str) -> bool:
    """Whether the table's catalog is a table format's own: the session
    catalog's file tables have no row-level operations."""
    parts = name.split(".")
    catalog = parts[0] if len(parts) >= 3 else spark.catalog.currentCatalog()
    if catalog != "spark_catalog":
        return True
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").first()
    return bool(found) and found["data_type"].lower() not in ("parquet", "orc", "csv", "json", "text", "avro", "hive")


def _upsert_table(src: DataFrame, name: str, keys: list[str], parts: list[str], provider: str | None) -> dict:
    spark = src.sparkSession
    if not spark.catalog.tableExists(name):
        namespace = name.rpartition(".")[0]
        if namespace:
            ensure_namespace(spark, namespace)
        writer = src.writeTo(name)
        if provider:
            writer = writer.using(provider)
        if parts:
            writer = writer.partitionedBy(*[F.col(c) for c in parts])
        writer.create()
        return {"rows_inserted": src.count(), "rows_updated": 0, "created": True}
    if not _row_level(spark, name):
        return overwrite_partitions(src, name, keys)
    row = merge_counts(spark.table(name), src, keys).first()
    view = f"_finlake_merge_source_{uuid.uuid4().hex}"
    src.createOrReplaceTempView(view)
    try:
        on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in keys)
        matched = "WHEN MATCHED THEN UPDATE SET * " if any(c not in keys for c in src.columns) else ""
        spark.sql(f"MERGE INTO {name} AS t USING {view} AS s ON {on} {matched}WHEN NOT MATCHED THEN INSERT *")
    finally:
        spark.catalog.dropTempView(view)
    return {"rows_inserted": int(row["rows_inserted"]), "rows_updated": int(row["rows_updated"]), "created": False}


def overwrite_partitions(src: DataFrame, name: str, keys: list[str]) -> dict:
    """Upsert into a partitioned file table whose partition columns are merge
    keys (K7, K8): a key cannot leave its partition, so the partitions of the
    source are all that is read and written. Their values are literals of
    the plan; a load of one snapshot or month has one."""
    spark = src.sparkSession
    table = spark.table(name)
    parts = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if not parts or not set(parts) <= set(keys):
        raise ValueError(f"{name} has no row-level operations and is not partitioned by merge keys")
    touched = [r.asDict() for r in src.select(*parts).distinct().collect()]
    own = F.lit(False)
    for values in touched:
        same = F.lit(True)
        for c, v in values.items():
            same = same & (F.col(c).isNull() if v is None else F.col(c) == F.lit(v))
        own = own | same
    before = table.filter(own)
    row = merge_counts(before, src, keys).first()
    merged = merge_rows(before, src, keys).select(*table.columns)
    mode = "spark.sql.sources.partitionOverwriteMode"  # an insert takes it from the session alone
    old = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        merged.hint("rebalance", *parts).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, old)
    return {"rows_inserted": int(row["rows_inserted"]), "rows_updated": int(row["rows_updated"]), "created": False}
