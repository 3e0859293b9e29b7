"""Global ``ntile`` without a single-partition window (W2-W4 at scale).

``ntile(k) OVER (ORDER BY ...)`` with no PARTITION BY makes Spark move every
row into one task. ``distributed_ntile`` computes the same buckets in
parallel:

1. range-partition on the (total) sort order into P partitions and sort
   inside each partition;
2. tag rows with ``monotonically_increasing_id`` - partition index in the
   upper bits, position inside the partition in the lower 33 bits - and
   cut the lineage with a reliable checkpoint, so every later read sees the
   same partitioning even if executors are lost;
3. count rows per partition (P rows), prefix-sum the counts, broadcast the
   P offsets (bounded by the partition count, not by the data);
4. global position = offset + position in partition + 1, and the bucket
   follows from N and k exactly as Spark's ``ntile`` assigns it: the first
   ``N mod k`` buckets hold one row more.

Range partitioning on (key, unique tie-breaker) also splits a value shared
by a third of all rows over several partitions, so hot values do not skew.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.session import checkpoint_dir

_RID = "_finlake_rid"
_PID = "_finlake_pid"
_OFF = "_finlake_off"
_TOTAL = "_finlake_total"
_POS = "_finlake_pos"
_ROW_BITS = 33  # lower bits of monotonically_increasing_id: row inside the partition


def global_position(
    df: DataFrame,
    order: Sequence[Column],
    out_col: str = "position",
    total_col: str | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in ``order``.

    ``order`` must be a total order (end it with a unique column), otherwise
    the position of tied rows is arbitrary. ``total_col`` optionally adds
    the row count N to every row.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    p = int(partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (
        df.repartitionByRange(p, *order)
        .sortWithinPartitions(*order)
        .withColumn(_RID, F.monotonically_increasing_id())
        .checkpoint(eager=True)
        .withColumn(_PID, F.shiftright(F.col(_RID), _ROW_BITS))
    )
    sizes = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        _PID,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(_OFF),
        F.sum("_n").over(everything).alias(_TOTAL),
    )
    in_part = F.col(_RID).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    out = tagged.join(F.broadcast(offsets), _PID).withColumn(
        out_col, F.col(_OFF) + in_part + F.lit(1)
    )
    if total_col and total_col != _TOTAL:
        out = out.withColumnRenamed(_TOTAL, total_col)
    drop = [_RID, _PID, _OFF] + ([] if total_col == _TOTAL else [_TOTAL])
    return out.drop(*drop)


def _bucket(position: str, total: str, k: int) -> Column:
    # q rows per bucket, the first r buckets hold q + 1.
    q = f"({total} div {k})"
    r = f"({total} % {k})"
    big = f"({r} * ({q} + 1))"
    return F.expr(
        f"CASE WHEN {position} <= {big} THEN ({position} - 1) div ({q} + 1) + 1 "
        f"ELSE {r} + ({position} - 1 - {big}) div greatest({q}, 1) + 1 END"
    ).cast("int")


def distributed_ntile(
    df: DataFrame,
    k: int,
    order: Sequence[Column],
    out_col: str,
    partitions: int | None = None,
) -> DataFrame:
    """``ntile(k)`` over ``order`` computed in parallel (see module doc)."""
    if k < 1:
        raise ValueError("ntile needs k >= 1")
    ranked = global_position(df, order, _POS, _TOTAL, partitions)
    return ranked.withColumn(out_col, _bucket(_POS, _TOTAL, k)).drop(_POS, _TOTAL)

