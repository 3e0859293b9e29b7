"""Customer segmentation job."""
from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from finlake.functions.dates import parse_date
from finlake.operators import rfm
from finlake.session import pin_utc
from finlake.sinks.upsert import upsert

MERGE_KEYS = ("account_id", "snapshot_date")
PARTITION_COLS = ("snapshot_date",)


def run(
    spark: SparkSession,
    silver: DataFrame,
    target: str,
    snapshot_date: str,
    lookback_days: int = rfm.DEFAULT_LOOKBACK_DAYS,
    scoring: str = "literal",
    loaded_at: dt.datetime | None = None,
    provider: str | None = None,
) -> dict:
    """Compute segments for one snapshot and upsert them. Fails when no
    customer had a transaction in the window."""
    pin_utc(spark)
    snap = parse_date(snapshot_date)
    seg = rfm.compute(silver, snap, lookback_days, scoring, loaded_at=loaded_at).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        if seg.isEmpty():
            raise ValueError(f"snapshot {snap}: no account has a transaction in its window")
        counts = {r["segment"]: r["customer_count"] for r in rfm.segment_counts(seg).collect()}
        result = upsert(spark, seg, target, list(MERGE_KEYS), list(PARTITION_COLS), provider=provider)
    finally:
        seg.unpersist()
    return {**result, "customers": sum(counts.values()), "segments": counts}
