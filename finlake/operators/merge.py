"""Keyed MERGE semantics as relational operators (K1b, K1c, K1e).

``merge_rows`` is what ``MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED
INSERT *`` leaves in the target. Keys compare with ``=``, so a NULL key
never matches.

Rows whose key has a NULL are split off before the joins: they can never
match, and sending them through a join would put all of them on one
reducer (NULL hashes to one partition).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _all_keys_set(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def check_columns(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> None:
    missing_keys = [k for k in keys if k not in source.columns or k not in target.columns]
    if not keys or missing_keys:
        raise ValueError(f"merge keys missing: {missing_keys or 'none given'}")
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns not in target: {extra}")


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target content after a keyed upsert of ``source`` (target columns).

    Every target row with a source match takes the source's values, so two
    target rows of one key both change and both stay. Target columns the
    source lacks keep their value on update and are NULL on insert. Both
    joins have the source, or keys of it, as their small side: the target
    itself is not shuffled while AQE can broadcast that.
    """
    keys = list(keys)
    check_columns(target, source, keys)
    keyed = _all_keys_set(keys)
    new = source.filter(keyed).select(
        *[F.col(k).alias(f"_finlake_{k}") for k in keys], F.struct(*source.columns).alias("_finlake_new"))
    old = target.filter(keyed)
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_finlake_{k}") for k in keys])
    given = {c.lower() for c in source.columns}
    after = old.join(new, same, "left").select(*[
        F.when(F.col("_finlake_new").isNotNull(), F.col(f"_finlake_new.`{c}`")).otherwise(F.col(c)).alias(c)
        if c.lower() in given and c not in keys else F.col(c)
        for c in target.columns
    ])
    matched = old.select(*keys).join(source.filter(keyed).select(*keys), keys, "left_semi").dropDuplicates()
    inserted = source.filter(keyed).join(matched, keys, "left_anti").unionByName(source.filter(~keyed))
    return after.unionByName(target.filter(~keyed)).unionByName(inserted, allowMissingColumns=True).select(*target.columns)


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: target_rows, source_rows, rows_updated (target rows
    matched), rows_inserted (source rows without a match), result_rows.

    The target is scanned once and only semi-joined against the distinct
    source keys; everything else is source-sized. With a daily source and a
    large target, AQE turns that semi join into a broadcast of the source
    keys at run time (it sees their real size), so the target is never
    shuffled.
    """
    keys = list(keys)
    keyed = _all_keys_set(keys)
    src_keys = source.filter(keyed).select(*keys).dropDuplicates()
    hit = (
        target.filter(keyed)
        .join(src_keys, keys, "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_tn"))
    )
    per_key = source.filter(keyed).groupBy(*keys).agg(F.count(F.lit(1)).alias("_sn")).join(hit, keys, "left").select("_sn", "_tn")
    unkeyed = source.filter(~keyed).agg(F.count(F.lit(1)).alias("_sn"), F.lit(None).cast("long").alias("_tn"))
    per_key = per_key.unionByName(unkeyed)
    zero = F.lit(0).cast("long")
    source_side = per_key.agg(
        zero.alias("target_rows"),
        F.sum("_sn").cast("long").alias("source_rows"),
        F.sum("_tn").cast("long").alias("rows_updated"),
        F.sum(F.when(F.col("_tn").isNull(), F.col("_sn"))).cast("long").alias("rows_inserted"),
    )
    target_side = target.agg(
        F.count(F.lit(1)).cast("long").alias("target_rows"),
        zero.alias("source_rows"),
        zero.alias("rows_updated"),
        zero.alias("rows_inserted"),
    )
    names = ("target_rows", "source_rows", "rows_updated", "rows_inserted")
    sums = source_side.unionByName(target_side).agg(
        *[F.coalesce(F.sum(c), zero).cast("long").alias(c) for c in names]
    )
    return sums.withColumn(
        "result_rows", (F.col("target_rows") + F.col("rows_inserted")).cast("long")
    )


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once (empty when unique)."""
    keys = list(keys)
    return (
        source.filter(_all_keys_set(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )
