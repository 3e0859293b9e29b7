"""File and table sources."""
from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from finlake.functions.dates import check_month, parse_date
from finlake.schemas import RAW_TRANSACTION

INVENTORY_SCHEMA = StructType(
    [
        StructField("path", StringType()),
        StructField("length", LongType()),
        StructField("modificationTime", TimestampType()),
        StructField("rows", LongType()),
    ]
)


class SourceMissing(FileNotFoundError):
    """The requested input path does not exist."""


def _is_path_not_found(exc: AnalysisException) -> bool:
    cond = getattr(exc, "getCondition", None) or getattr(exc, "getErrorClass", None)
    return (cond() if cond else None) == "PATH_NOT_FOUND"


def raw_transactions(
    spark: SparkSession, base_path: str, date: str | dt.date | None = None
) -> DataFrame:
    """Raw transaction files (S1/S2) with the fixed raw schema.

    The files live under Hive-style ``date=YYYY-MM-DD`` folders. With a
    ``date`` that one folder is named, so nothing else is listed; without
    one the whole root is read. There is no ``date`` column either way.
    """
    if date is not None:
        path, schema = f"{base_path.rstrip('/')}/date={parse_date(date).isoformat()}/", RAW_TRANSACTION
    else:
        path, schema = base_path, StructType(RAW_TRANSACTION.fields + [StructField("date", StringType())])
    try:
        return spark.read.schema(schema).parquet(path).drop("date")
    except AnalysisException as exc:
        if _is_path_not_found(exc):
            raise SourceMissing(path) from exc
        raise


def source_of_truth(spark: SparkSession, base_path: str, year: int, month: int) -> DataFrame:
    """Monthly source-of-truth files under ``year=YYYY/month=MM/`` (S3).

    Raises ``SourceMissing`` only when the month folder does not exist; any
    other failure (a missing column, a corrupt file) propagates.
    """
    check_month(year, month)
    path = f"{base_path.rstrip('/')}/year={int(year)}/month={int(month):02d}/"
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if _is_path_not_found(exc):
            raise SourceMissing(path) from exc
        raise


def table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.read.table(name)


def file_inventory(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files under the paths (recursively): path, length,
    modificationTime and rows.

    A scan without data columns: the row counts come from the footers, the
    rest from the file metadata column, and many small files share a task.
    Files without rows do not appear. A missing path gives an empty
    inventory (S6).
    """
    try:
        files = spark.read.schema(StructType([])).option("recursiveFileLookup", "true").parquet(*paths)
    except AnalysisException as exc:
        if _is_path_not_found(exc):
            return spark.createDataFrame([], INVENTORY_SCHEMA)
        raise
    return files.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def file_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` names a file, or a folder with files in it (S7):
    one listing of that path, no job."""
    try:
        return bool(spark.read.format("binaryFile").load(path).inputFiles())
    except AnalysisException as exc:
        if _is_path_not_found(exc):
            return False
        raise
