"""Mixing sources to target weights by hash-threshold histograms.

Every document has a 60-bit hash of its id and text. A source's budget is
met by the documents whose hash lies under a threshold, found without
sorting: sizes are summed by source and hash bucket (12 bits), the bucket
in which the running sum crosses the budget is the boundary, and only its
documents are summed again by the next 12 bits, five levels down to one
hash value. Thresholds are nested: a larger budget keeps all a smaller one
takes. A budget above the source's size takes the whole source once and the
documents under the threshold of the rest twice.

Only (source, bucket) sums are shuffled, pre-aggregated on the map side, at
most 4096 rows per source and level, so a source with a third of all rows
is as cheap as any. Targets come from one row per source by repeated
aggregates; no list of sources reaches the driver.

Defined results: a null or empty text has size 0, and is taken if its hash
lies under the threshold; a null source is a source of its own, last in
order; rows equal in id and text share a hash and are taken or left
together; an empty table gives an empty result; further columns are carried
along, those named like a result column are replaced.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finlake.llm.common import cut, fresh_names, stored, words

BITS, LEVELS = 12, 5  # 60 bits: 15 hex digits of an MD5


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code point order, null last, get the weights in turn and
    share ``share`` times the total by weight. A target stops at ``most``
    times its source's size; what is above is shared anew by weight among
    the others until none is above. The order is taken by a range
    partitioning and an offset per partition, so no task has all sources.
    """
    parts = sizes.withColumn("_null", F.col("source").isNull())
    parts = cut(parts.repartitionByRange("_null", "source").sortWithinPartitions("_null", "source")
                .withColumn("_part", F.spark_partition_id()))
    local = Window.partitionBy("_part").orderBy("_null", "source")
    # one row per partition
    before = parts.groupBy("_part").count().withColumn(
        "_before", F.sum("count").over(Window.orderBy("_part")) - F.col("count"))
    rank = F.col("_before") + F.row_number().over(local) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int"))
    ranked = parts.join(F.broadcast(before.select("_part", "_before")), "_part").select(
        "source", "source_size", weight.alias("_w"),
        (F.col("source_size") * float(most)).alias("_cap"))
    state = cut(ranked.withColumn("_full", F.lit(False)))
    pool = (state.agg(F.sum("source_size")).first()[0] or 0) * float(share)
    while True:
        full, open_w, n_full = state.agg(
            F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(F.col("_full"), 0.0).otherwise(F.col("_w"))),
            F.sum(F.col("_full").cast("long")),
        ).first()
        share_out = F.col("_w") * F.lit(pool - (full or 0.0)) / F.lit(open_w or 1.0)
        state = cut(state.withColumn("_full", F.col("_full") | (share_out > F.col("_cap"))))
        if (state.agg(F.sum(F.col("_full").cast("long"))).first()[0] or 0) == (n_full or 0):
            return state.select("source", "source_size", F.when(
                F.col("_full"), F.col("_cap")).otherwise(share_out).alias("target"))


def _thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, cutoff): the documents with hash < cutoff come nearest to the
    source's ``budget``; the hash value on the boundary is included if that
    comes nearer than leaving it out (half-way: left out)."""
    at = budgets.select("source", "budget", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("below"))
    rows = sized.filter("size > 0")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        a = rows.alias("a").join(at.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))
                                 & (F.shiftright("a.hash", shift + BITS) == F.col("b.prefix")))
        sums = a.groupBy(F.col("b.source").alias("source"), "budget", "below",
                         F.shiftright("a.hash", shift).alias("bucket")).agg(F.sum("a.size").alias("size"))
        run = Window.partitionBy("source").orderBy("bucket")  # at most 4096 rows a source
        sums = sums.withColumn("upto", F.col("below") + F.sum("size").over(run))
        # the first bucket that crosses the budget; if none does, all is taken
        at = stored(sums.filter("upto >= budget").groupBy("source", "budget").agg(
            F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("below"), "size")).alias("x")
        ).select("source", "budget", F.col("x.bucket").alias("prefix"), F.col("x.below").alias("below"),
                 F.col("x.size").alias("last")), "mix-level")
    nearer = (F.col("below") + F.col("last") - F.col("budget")) < (F.col("budget") - F.col("below"))
    return at.select("source", (F.col("prefix") + nearer.cast("long")).alias("cutoff"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """The documents with size, source_size, target, copies (0, 1 or 2) and
    taken (words the mix takes from this document)."""
    own = ("size", "source_size", "target", "copies", "taken")
    docs = docs.drop(*own)
    hash_col, cut_col, src, times = fresh_names(docs, "_hash", "_cutoff", "_source", "_rounds")
    key = F.concat_ws(" ", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")), F.coalesce(F.md5(text), F.lit("null")))
    sized = docs.withColumns({
        "size": F.size(words(F.col(text))).cast("long"),
        hash_col: F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"),
    })
    small = stored(sized.select(F.col(source).alias("source"), "size", F.col(hash_col).alias("hash")), "mix-sizes")
    goal = targets(small.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    goal = stored(goal, "mix-targets")  # read back, Spark knows its size and picks the join by it
    # the part of the budget beyond whole takes of the source
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goal = goal.withColumn("rounds", rounds.cast("int"))
    rest = goal.withColumn("budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    cutoffs = _thresholds(small, rest.filter("budget > 0").select("source", "budget"))
    plan = goal.alias("g").join(cutoffs.alias("c"), F.col("g.source").eqNullSafe(F.col("c.source")), "left").select(
        F.col("g.source").alias(src), "source_size", "target", F.col("rounds").alias(times),
        F.coalesce("cutoff", F.lit(0)).alias(cut_col))
    plan = stored(plan, "mix-plan")
    out = sized.join(plan, sized[source].eqNullSafe(plan[src]))
    copies = (F.col(times) + (F.col(hash_col) < F.col(cut_col)).cast("int")).cast("int")
    out = out.withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *own)


def repeat(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: every document as often as the mix takes it, with its
    own columns."""
    mixed = mix(docs, **kw)
    (times,) = fresh_names(mixed, "_time")
    many = mixed.filter("copies > 0").withColumn(times, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return many.select(*[F.col(f"`{c}`") for c in docs.columns])
