"""Deduplication.

``latest`` is a top-1-per-key window. Catalyst plans it with a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most
one row per key: a key holding a third of all versions costs one row per
map task on the reduce side, not a third of the data.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_finlake_rn"


def _desc(c: str | Column) -> Column:
    """A name sorts descending (NULLs last); a Column keeps its own order."""
    return F.col(c).desc_nulls_last() if isinstance(c, str) else c


def latest(
    df: DataFrame,
    id_cols: Sequence[str],
    timestamp_col: str,
    tie_breakers: Sequence[str | Column] = (),
) -> DataFrame:
    """Keep the newest row per id (CDC collapse, D1).

    Newest = largest ``timestamp_col``; NULL timestamps rank last, so an id
    whose only versions have a NULL timestamp still keeps one row. NULL ids
    form one group. Ties pick an arbitrary row unless ``tie_breakers`` are
    given (names sort descending; pass Columns for any other order).
    """
    order = [F.col(timestamp_col).desc_nulls_last()] + [_desc(t) for t in tie_breakers]
    w = Window.partitionBy(*[F.col(c) for c in id_cols]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def exact(df: DataFrame, subset_cols: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicates (D2): the whole row, or a column subset
    (``None`` and ``[]`` both mean the whole row; for a subset the kept row
    is arbitrary). A hash aggregate with map-side combine."""
    return df.dropDuplicates(list(subset_cols)) if subset_cols else df.dropDuplicates()


def count_duplicates(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Surplus rows over distinct ids (D3) as a one-row DataFrame
    ``duplicate_count`` (long). NULL ids count as one value. One job:
    partial counts per id, then one global sum."""
    per_id = df.groupBy(*id_cols).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_count")
    )


def duplicate_count(df: DataFrame, id_cols: Sequence[str]) -> int:
    """``count_duplicates`` collected to an int (job edge only)."""
    return int(count_duplicates(df, id_cols).first()["duplicate_count"])
