"""Query catalogue: one Spark query per operator, over the test tables.

Every query derives its input from the test tables with Spark (see
``sources.fixtures``) and runs over the whole tables. Queries that exercise
a writer (upsert, stream, compaction, file sources) write under a fresh
folder in the session's checkpoint directory and read the result back.

Presentation conventions shared with ``oracle.py``: order-dependent double
sums are rounded to cents; the load stamps are left out.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.currency import DEFAULT_RATES, flag_currency_issues, normalize_to_usd
from finlake.functions.currency import normalize_with_rate_table
from finlake.operators import dedup, quality, reconcile, rfm
from finlake.operators.merge import merge_counts, merge_rows
from finlake.plans import reconcile as reconcile_plan
from finlake.plans import segments as segments_plan
from finlake.plans import silver as silver_plan
from finlake.schemas import RAW_COLUMNS, SILVER
from finlake.session import pin_utc, scratch_path
from finlake.sinks import log_table, maintenance
from finlake.sinks.upsert import upsert
from finlake.sources import fixtures as fx
from finlake.sources.files import file_inventory, raw_transactions as read_raw, table as read_catalog_table
from finlake.streaming import events as stream

LOADED_AT = dt.datetime(2024, 1, 1)
RAW_DAY = dt.date(1998, 3, 2)
CUSTOM_RATES = {"EUR": 0.9, "GBP": 0.8, "USD": 2.0}
SILVER_OUT = [c for c in SILVER.fieldNames() if c != "_etl_loaded_at"]
MERGE_KEYS = ["transaction_id"]

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    pin_utc(spark)
    return fx.raw_transactions(spark, sf)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return silver_plan.transform(raw, LOADED_AT, fx.TIE_BREAKERS).select(*SILVER_OUT)


def _cents(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in cols})


# ------------------------------------------------------------------ step 1
def q_raw_transactions(spark, sf):
    return fx.raw_only(_raw(spark, sf))


def _landed(spark, sf):
    """The raw versions as ``date=`` folders, one per day of ``updated_at``."""
    base = scratch_path(spark, "raw")
    landed = fx.raw_only(_raw(spark, sf)).withColumn("date", F.date_format("updated_at", "yyyy-MM-dd"))
    landed.hint("rebalance", "date").write.partitionBy("date").parquet(base)
    return base


def q_raw_extract(spark, sf):
    """Land the raw versions as ``date=`` folders, read them back."""
    return read_raw(spark, _landed(spark, sf))


def q_raw_day(spark, sf):
    """One day of the landed folders (S2): the day is the feature."""
    return read_raw(spark, _landed(spark, sf), RAW_DAY)


# ------------------------------------------------------------------ step 2
def q_dedup_latest(spark, sf):
    return dedup.latest(_raw(spark, sf), ["transaction_id"], "updated_at", fx.TIE_BREAKERS).select(
        *RAW_COLUMNS
    )


def q_dedup_exact(spark, sf):
    return dedup.exact(fx.raw_only(_raw(spark, sf)))


def q_dedup_exact_subset(spark, sf):
    keys = ["transaction_id", "updated_at"]
    return dedup.exact(fx.raw_only(_raw(spark, sf)), keys).select(*keys)


def q_count_duplicates(spark, sf):
    return dedup.count_duplicates(_raw(spark, sf), ["transaction_id"])


# ------------------------------------------------------------------ step 3
def q_normalize_usd(spark, sf):
    return normalize_to_usd(fx.raw_only(_raw(spark, sf)), "amount", "currency")


def q_normalize_usd_custom_rates(spark, sf):
    return normalize_to_usd(
        fx.raw_only(_raw(spark, sf)), "amount", "currency", exchange_rates=CUSTOM_RATES
    )


def q_normalize_rate_table(spark, sf):
    """Dated rates: one rate per day and currency seen in the data, the
    default one raised by up to 6 % with the day of the month."""
    raw = fx.raw_only(_raw(spark, sf)).withColumn("_day", F.to_date("created_at"))
    rate = F.try_element_at(
        F.create_map(*[F.lit(x) for kv in DEFAULT_RATES.items() for x in kv]), F.col("currency")
    )
    rates = (
        raw.select(F.col("_day").alias("rate_date"), "currency")
        .filter(F.col("currency").isNotNull())
        .dropDuplicates()
        .withColumn("units_per_usd", rate * (F.lit(1.0) + (F.dayofmonth("rate_date") % 7).cast("double") / F.lit(100.0)))
        .filter(F.col("units_per_usd").isNotNull())
    )
    out = normalize_with_rate_table(raw, rates, "amount", "currency", "_day")
    return out.drop("_day")


def q_flag_currency_issues(spark, sf):
    return flag_currency_issues(fx.raw_only(_raw(spark, sf)), "currency")


# ------------------------------------------------------------------ step 4/5
def q_silver_transactions(spark, sf):
    return _silver(spark, sf)


def q_silver_stamped(spark, sf):
    """With the load stamp."""
    return silver_plan.transform(_raw(spark, sf), LOADED_AT, fx.TIE_BREAKERS).select(*SILVER.fieldNames())


def q_quality_report(spark, sf):
    return quality.report(_silver(spark, sf))


def q_quality_report_fewer_columns(spark, sf):
    """A rule whose column is absent is skipped."""
    return quality.report(_silver(spark, sf).drop("transaction_type", "has_currency_issue"))


def q_silver_load(spark, sf):
    """The daily job on all raw files, twice (K6, B4): staged write with the
    gate's counts, gate, upsert; the second load updates every row."""
    raw, target = scratch_path(spark, "raw-files"), scratch_path(spark, "silver")
    fx.raw_only(_raw(spark, sf)).write.parquet(raw)
    for day in (1, 2):
        silver_plan.run(spark, raw, target, loaded_at=dt.datetime(2024, 1, day))
    return maintenance.read_table(spark, target, silver_plan.MERGE_KEYS, SILVER)


def _stored_table(spark, df, parts):
    """An empty external file table with the columns of ``df``, its name
    and its folder."""
    name, path = f"finlake_{uuid.uuid4().hex}", scratch_path(spark, "table")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    by = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    spark.sql(f"CREATE TABLE default.{name} ({ddl}) USING parquet {by} LOCATION '{path}'")
    return f"default.{name}", path


def q_table_scan(spark, sf):
    """Silver through a catalog table."""
    silver = _silver(spark, sf)
    name, _ = _stored_table(spark, silver, ["transaction_year"])
    columns = spark.table(name).columns
    silver.select(*columns).write.insertInto(name)
    return read_catalog_table(spark, name).select(*SILVER_OUT)


# ------------------------------------------------------------------ step 6/7
def _rfm_scored(spark, sf, scoring="literal"):
    base = rfm.base(_silver(spark, sf), fx.SNAPSHOT_DATE)
    return rfm.scores(base, scoring)


def q_rfm_base(spark, sf):
    return _cents(rfm.base(_silver(spark, sf), fx.SNAPSHOT_DATE), "monetary_usd")


def q_rfm_scores(spark, sf):
    return _cents(_rfm_scored(spark, sf), "monetary_usd")


def q_rfm_scores_distributed(spark, sf):
    """The same scores by a global sort instead of counting."""
    return _cents(rfm.scores_by_range(rfm.base(_silver(spark, sf), fx.SNAPSHOT_DATE)), "monetary_usd")


def _segments(spark, sf, scoring):
    seg = rfm.compute(_silver(spark, sf), fx.SNAPSHOT_DATE, scoring=scoring, loaded_at=LOADED_AT)
    return _cents(seg.drop("_etl_loaded_at"), "monetary_usd")


def q_rfm_segments(spark, sf):
    return _segments(spark, sf, "literal")


def q_rfm_segments_high_is_best(spark, sf):
    return _segments(spark, sf, "high_is_best")


def q_rfm_segment_counts(spark, sf):
    seg = rfm.compute(_silver(spark, sf), fx.SNAPSHOT_DATE, loaded_at=LOADED_AT)
    return rfm.segment_counts(seg)


def q_segments_load(spark, sf):
    """Two snapshots into a file table, the second one twice (K7): a load
    reads and writes the partition of its snapshot."""
    silver = _silver(spark, sf).checkpoint()
    seg = rfm.compute(silver, fx.SNAPSHOT_DATE, loaded_at=LOADED_AT)
    name, path = _stored_table(spark, seg, ["snapshot_date"])
    for day in (fx.SNAPSHOT_DATE - dt.timedelta(days=30), fx.SNAPSHOT_DATE, fx.SNAPSHOT_DATE):
        segments_plan.run(spark, silver, name, day, loaded_at=LOADED_AT)
    return _cents(spark.read.schema(seg.schema).parquet(path).drop("_etl_loaded_at"), "monetary_usd")


# ------------------------------------------------------------------ step 8
def _reconciled(spark, sf):
    silver = _silver(spark, sf)
    base = scratch_path(spark, "sot")
    month_dir = f"{base}/year={fx.SOT_YEAR}/month={fx.SOT_MONTH:02d}"
    fx.source_of_truth(silver).write.parquet(month_dir)
    return reconcile_plan.compare_month(spark, silver, base, fx.SOT_YEAR, fx.SOT_MONTH)


def q_reconcile_silver_month(spark, sf):
    agg = reconcile.silver_month(_silver(spark, sf), fx.SOT_YEAR, fx.SOT_MONTH)
    return _cents(agg, "total_amount_usd")


def q_reconcile_compare(spark, sf):
    return _cents(_reconciled(spark, sf), "total_amount_usd", "sot_total_usd", "diff_usd")


def q_reconcile_summary(spark, sf):
    return reconcile.summary(_reconciled(spark, sf), fx.SOT_YEAR, fx.SOT_MONTH)


def q_reconcile_load(spark, sf):
    """One month's rows into a file table, twice (K8)."""
    silver = _silver(spark, sf).checkpoint()
    base = scratch_path(spark, "sot")
    fx.source_of_truth(silver).write.parquet(f"{base}/year={fx.SOT_YEAR}/month={fx.SOT_MONTH:02d}")
    rows = reconcile_plan.compare_month(spark, silver, base, fx.SOT_YEAR, fx.SOT_MONTH)
    name, path = _stored_table(spark, rows, ["reconcile_month"])
    for _ in range(2):
        reconcile_plan.run(spark, silver, base, name, fx.SOT_YEAR, fx.SOT_MONTH)
    return _cents(spark.read.schema(rows.schema).parquet(path), "total_amount_usd", "sot_total_usd", "diff_usd")


# ------------------------------------------------------------------ step 9
def _merge_sides(spark, sf):
    raw = _raw(spark, sf)
    return fx.merge_side(raw, True), fx.merge_side(raw, False)


def q_merge_rows(spark, sf):
    target, source = _merge_sides(spark, sf)
    return merge_rows(target, source, MERGE_KEYS)


def q_merge_counts(spark, sf):
    target, source = _merge_sides(spark, sf)
    return merge_counts(target, source, MERGE_KEYS)


def q_merge_rows_two_keys(spark, sf):
    """Multi-column key, NULLs in it included."""
    target, source = _merge_sides(spark, sf)
    return merge_rows(target, source, ["transaction_id", "currency"])


def q_merge_rows_repeated_target(spark, sf):
    """Every target row twice: both are updated, both stay."""
    target, source = _merge_sides(spark, sf)
    return merge_rows(target.unionByName(target), source, MERGE_KEYS)


def q_upsert_parquet(spark, sf):
    """Append the target side, then the source side, as batches of one
    table; read the table back, merged."""
    target, source = _merge_sides(spark, sf)
    path = scratch_path(spark, "upsert")
    upsert(spark, target, path, MERGE_KEYS)
    upsert(spark, source, path, MERGE_KEYS)
    return log_table.read(spark, path, MERGE_KEYS, source.schema)


def q_upsert_parquet_files(spark, sf):
    """As ``upsert_parquet``, in small files that are packed and collapsed
    into a base partitioned by ``currency`` before the source arrives: a
    newer version often carries another currency, so its row leaves its
    partition of the base."""
    target, source = _merge_sides(spark, sf)
    path = scratch_path(spark, "upsert-files")
    log_table.append(spark, target, path, MERGE_KEYS, files=8)
    maintenance.compact(spark, path, MERGE_KEYS, source.schema)
    log_table.collapse(spark, path, MERGE_KEYS, ["currency"], source.schema)
    upsert(spark, source, path, MERGE_KEYS)
    return log_table.read(spark, path, MERGE_KEYS, source.schema)


def _landed_batch(spark, side):
    """The rows in files, as they are delivered from: each delivery reads
    them, the collapse of their versions runs once."""
    path = scratch_path(spark, "delivery")
    side.hint("rebalance").write.parquet(path)
    return spark.read.schema(side.schema).parquet(path)


def q_upsert_redelivered(spark, sf):
    """Three batches, each delivered twice, the first once more at the end:
    a batch under a known token replaces itself, in its old place (R6)."""
    target, source = (_landed_batch(spark, side) for side in _merge_sides(spark, sf))
    path = scratch_path(spark, "upsert-redelivered")
    half = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    batches = {"target": target, "one": source.filter(half), "two": source.filter(~half)}
    for name in ("target", "target", "one", "one", "two", "two", "target"):
        upsert(spark, batches[name], path, MERGE_KEYS, counts=False, token=name)
    return log_table.read(spark, path, MERGE_KEYS, source.schema)


# ------------------------------------------------------------------ step 10
def q_parse_events(spark, sf):
    pin_utc(spark)
    payloads = fx.event_payloads(fx.event_rows(spark, sf))
    delivered = payloads.unionByName(fx.redelivered(payloads))
    return stream.parse_events(delivered, LOADED_AT).drop("ingested_at")


def _drops(spark, sf):
    """The messages, then those delivered again."""
    payloads = fx.event_payloads(fx.event_rows(spark, sf))
    return payloads.select("value"), fx.redelivered(payloads).select("value")


def _ingest(spark, root):
    q = stream.run(stream.read_events(spark, path=f"{root}/in"), f"{root}/table", f"{root}/checkpoint", available_now=True)
    q.awaitTermination()


def q_stream_upsert(spark, sf):
    """File stream -> foreachBatch upsert, in two runs on one checkpoint:
    the first drop of messages, then the redelivered ones."""
    pin_utc(spark)
    root = scratch_path(spark, "stream")
    for drop in _drops(spark, sf):
        drop.write.mode("append").parquet(f"{root}/in")
        _ingest(spark, root)
    return stream.read_target(spark, f"{root}/table").drop("ingested_at")


class _Killed(Exception):
    pass


def q_stream_replay(spark, sf):
    """As ``stream_upsert``, but the first run dies after its batch is
    written and before the checkpoint knows (K9, R3): the restart replays
    the batch, which replaces what it wrote."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-replay")
    first, again = _drops(spark, sf)
    first.write.parquet(f"{root}/in")
    write = stream.batch_writer(f"{root}/table")

    def dying(batch, batch_id):
        write(batch, batch_id)
        raise _Killed

    q = stream.read_events(spark, path=f"{root}/in").writeStream.foreachBatch(dying).option(
        "checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    except StreamingQueryException:
        pass
    _ingest(spark, root)
    again.write.mode("append").parquet(f"{root}/in")
    _ingest(spark, root)
    return stream.read_target(spark, f"{root}/table").drop("ingested_at")


# ------------------------------------------------------------------ step 11
def q_compact_roundtrip(spark, sf):
    """Write silver as many small files, pack them, read back."""
    silver = _silver(spark, sf)
    path = scratch_path(spark, "compact")
    log_table.append(spark, silver, path, MERGE_KEYS, files=16)
    maintenance.compact(spark, path, MERGE_KEYS, silver.schema)
    return log_table.read(spark, path, MERGE_KEYS, silver.schema)


def q_file_inventory(spark, sf):
    """Files and rows per folder of silver written by year, a file each."""
    path = scratch_path(spark, "inventory")
    _silver(spark, sf).repartition("transaction_year").write.partitionBy("transaction_year").parquet(path)
    year = F.regexp_extract("path", r"transaction_year=([0-9]+)", 1).cast("int")
    return file_inventory(spark, path).groupBy(year.alias("transaction_year")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min(F.col("length") > 0).alias("not_empty"))


QUERIES: dict[str, Query] = {
    "raw_transactions": q_raw_transactions,
    "raw_extract": q_raw_extract,
    "raw_day": q_raw_day,
    "dedup_latest": q_dedup_latest,
    "dedup_exact": q_dedup_exact,
    "dedup_exact_subset": q_dedup_exact_subset,
    "count_duplicates": q_count_duplicates,
    "normalize_usd": q_normalize_usd,
    "normalize_usd_custom_rates": q_normalize_usd_custom_rates,
    "normalize_rate_table": q_normalize_rate_table,
    "flag_currency_issues": q_flag_currency_issues,
    "silver_transactions": q_silver_transactions,
    "silver_stamped": q_silver_stamped,
    "quality_report": q_quality_report,
    "quality_report_fewer_columns": q_quality_report_fewer_columns,
    "silver_load": q_silver_load,
    "table_scan": q_table_scan,
    "rfm_base": q_rfm_base,
    "rfm_scores": q_rfm_scores,
    "rfm_scores_distributed": q_rfm_scores_distributed,
    "rfm_segments": q_rfm_segments,
    "rfm_segments_high_is_best": q_rfm_segments_high_is_best,
    "rfm_segment_counts": q_rfm_segment_counts,
    "segments_load": q_segments_load,
    "reconcile_silver_month": q_reconcile_silver_month,
    "reconcile_compare": q_reconcile_compare,
    "reconcile_summary": q_reconcile_summary,
    "reconcile_load": q_reconcile_load,
    "merge_rows": q_merge_rows,
    "merge_counts": q_merge_counts,
    "merge_rows_two_keys": q_merge_rows_two_keys,
    "merge_rows_repeated_target": q_merge_rows_repeated_target,
    "upsert_parquet": q_upsert_parquet,
    "upsert_parquet_files": q_upsert_parquet_files,
    "upsert_redelivered": q_upsert_redelivered,
    "parse_events": q_parse_events,
    "stream_upsert": q_stream_upsert,
    "stream_replay": q_stream_replay,
    "compact_roundtrip": q_compact_roundtrip,
    "file_inventory": q_file_inventory,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
