"""Monthly reconciliation job."""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from finlake.functions.dates import check_month
from finlake.operators import reconcile as rec
from finlake.session import pin_utc
from finlake.sinks.upsert import upsert
from finlake.sources.files import SourceMissing, source_of_truth

MERGE_KEYS = ("account_id", "reconcile_month")
# The month is the partition, so a rerun reads and writes one month only.
PARTITION_COLS = ("reconcile_month",)


def compare_month(
    spark: SparkSession, silver: DataFrame, sot_base_path: str, year: int, month: int
) -> DataFrame:
    """Reconcile rows of one month; raises ``SourceMissing`` when the
    source-of-truth folder of that month does not exist."""
    check_month(year, month)
    sot = source_of_truth(spark, sot_base_path, year, month)
    return rec.compare(rec.silver_month(silver, year, month), rec.sot_month(sot), year, month)


def run(
    spark: SparkSession,
    silver: DataFrame,
    sot_base_path: str,
    target: str,
    year: int,
    month: int,
    provider: str | None = None,
) -> dict:
    """Store the month's rows (keyed by account and month) and return the
    summary: ``passed`` / ``failed`` / ``skipped`` (source missing)."""
    pin_utc(spark)
    try:
        rows = compare_month(spark, silver, sot_base_path, year, month)
    except SourceMissing:
        return rec.skipped_summary(spark, year, month, "source_of_truth_not_found").first().asDict()
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        summary = rec.summary(rows, year, month).first().asDict()
        upsert(spark, rows, target, list(MERGE_KEYS), list(PARTITION_COLS), provider=provider)
    finally:
        rows.unpersist()
    return summary
