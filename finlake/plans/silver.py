"""Daily silver ETL.

raw versions -> latest per transaction -> COMPLETED only -> USD amount ->
currency flag -> date parts and load stamp -> required fields present.

The order is part of the semantics: the status filter runs *after* the
collapse, so a transaction whose newest version is not COMPLETED is dropped
even if an older version was (the filter is not pushed below the window).

The job runs the transform once: see ``run``.
"""
from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from finlake.functions.currency import flag_currency_issues, normalize_to_usd
from finlake.operators import quality
from finlake.operators.dedup import latest
from finlake.session import pin_utc, scratch_path
from finlake.sinks import fs
from finlake.sinks.upsert import upsert
from finlake.sources.files import raw_transactions

log = logging.getLogger(__name__)

COMPLETED = "COMPLETED"
REQUIRED_COLUMNS = ("transaction_id", "account_id", "created_at")
# Versions of one id with the same ``updated_at`` are ordered by the other
# raw columns, so the kept version is a function of the data alone: a task
# recomputed after an executor loss picks the same row again.
DEFAULT_TIE_BREAKERS = (
    "status",
    "amount",
    "currency",
    "transaction_type",
    "account_id",
    "created_at",
    "metadata",
)
MERGE_KEYS = ("transaction_id",)
PARTITION_COLS = ("transaction_date",)


def transform(
    raw: DataFrame,
    loaded_at: dt.datetime | None = None,
    tie_breakers: Sequence[str | Column] = (),
    exchange_rates: Mapping[str, float] | None = None,
) -> DataFrame:
    """Raw transaction versions -> silver rows."""
    stamp = (
        F.lit(loaded_at).cast("timestamp") if loaded_at is not None else F.current_timestamp()
    )
    newest = latest(raw, ["transaction_id"], "updated_at", tie_breakers)
    done = newest.filter(F.col("status") == COMPLETED)
    usd = normalize_to_usd(done, "amount", "currency", "amount_usd", exchange_rates)
    flagged = flag_currency_issues(usd, "currency")
    dated = flagged.withColumns(
        {
            "transaction_date": F.to_date("created_at"),
            "transaction_year": F.year("created_at"),
            "transaction_month": F.month("created_at"),
            "_etl_loaded_at": stamp,
        }
    )
    return dated.dropna(subset=list(REQUIRED_COLUMNS))


def run(
    spark: SparkSession,
    raw_path: str,
    target: str,
    date: str | None = None,
    loaded_at: dt.datetime | None = None,
    provider: str | None = None,
) -> dict:
    """Extract -> transform -> staged write -> quality gate -> upsert.

    The transform runs once, in the job that writes the staged rows to the
    shared scratch folder: that write gathers the gate's counts (and the
    number of raw rows) as it goes. Only if the gate passes is the target
    touched, from the staged rows; a failing gate raises and leaves it as it
    was. The staged rows are deleted either way.
    """
    pin_utc(spark)
    stamp = loaded_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    extracted, seen = Observation(), Observation()
    raw = raw_transactions(spark, raw_path, date).observe(extracted, F.count(F.lit(1)).alias("raw_rows"))
    silver = transform(raw, stamp, DEFAULT_TIE_BREAKERS)
    staged = scratch_path(spark, "silver-staged")
    try:
        silver.observe(seen, *quality.metrics(silver.columns)).write.parquet(staged)
        report = quality.report_of(spark, seen.get).collect()
        raw_rows = extracted.get["raw_rows"]
        log.info("extracted %s raw rows", raw_rows)
        warnings = quality.enforce(report)
        rows = {r["rule"]: r["total_rows"] for r in report}["row_count"]
        result = upsert(spark, spark.read.schema(silver.schema).parquet(staged), target,
                        list(MERGE_KEYS), list(PARTITION_COLS), provider=provider)
    finally:
        fs.delete(spark, staged)
    return {**result, "raw_rows": raw_rows, "rows": rows, "warnings": warnings}
