"""Fixture views over the test tables.

The engine's inputs (raw transaction versions, a source of truth, merge
sides, a stream of JSON events) are derived from the TPC-H-like test tables
with Spark operators, so every query's work grows with those tables.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.schemas import EVENT_COLUMNS, RAW_COLUMNS

# Tie-breaker columns that make the CDC collapse deterministic on the
# fixture (several versions of an id share one timestamp).
TIE_BREAKERS = ["_t1", "_t2", "_t3", "_t4"]

# The month and the perturbation of the source-of-truth fixture.
SOT_YEAR, SOT_MONTH = 1998, 3
MERGE_SPLIT = dt.date(1999, 1, 1)
GHOST_ACCOUNTS = ("ghost0", "ghost1", "ghost2")
SNAPSHOT_DATE = dt.date(2001, 7, 31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str, with_tie_breakers: bool = True) -> DataFrame:
    """Line items as transaction versions: one order is one transaction id,
    each of its lines a version stamped with the ship date."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    # Currency assignment of the fixture.
    currency = (
        F.when(part % 100 == 3, "XXX")
        .when(part % 100 == 4, F.lit(None))
        .when(supp % 6 == 0, "USD")
        .when(supp % 6 == 1, "EUR")
        .when(supp % 6 == 2, "GBP")
        .when(supp % 6 == 3, "VND")
        .when(supp % 6 == 4, "JPY")
        .otherwise("SGD")
    )
    status = (
        F.when(F.col("o_orderstatus") == "F", "COMPLETED")
        .when(
            F.col("o_orderstatus") == "O",
            F.when(F.col("l_linestatus") == "F", "COMPLETED").otherwise("PENDING"),
        )
        .otherwise("FAILED")
    )
    cols: list[Column] = [
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("account_id"),
        F.when(part % 50 == 7, F.lit(None)).otherwise(F.col("l_extendedprice")).alias("amount"),
        currency.alias("currency"),
        F.when(F.col("l_returnflag") == "R", "REFUND")
        .when(F.col("l_returnflag") == "A", "TRANSFER")
        .otherwise("PAYMENT")
        .alias("transaction_type"),
        status.alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.col("l_shipdate").cast("timestamp").alias("updated_at"),
        F.lit(None).cast("string").alias("metadata"),
    ]
    if with_tie_breakers:
        cols += [
            F.col("l_linenumber").alias("_t1"),
            F.col("l_partkey").alias("_t2"),
            F.col("l_suppkey").alias("_t3"),
            F.col("l_extendedprice").alias("_t4"),
        ]
    return j.select(*cols)


def raw_only(df: DataFrame) -> DataFrame:
    return df.select(*RAW_COLUMNS)


def source_of_truth(silver: DataFrame) -> DataFrame:
    """One month of silver, perturbed: accounts ending in 0 gain 0.02 per row
    (discrepant), ending in 1 gain 0.004 (within tolerance for one or two
    rows), ending in 2 are missing; three accounts exist only here."""
    first = dt.date(SOT_YEAR, SOT_MONTH, 1)
    nxt = dt.date(SOT_YEAR, SOT_MONTH + 1, 1)
    last_digit = F.col("account_id").cast("long") % 10
    rows = silver.filter(
        (F.col("transaction_date") >= F.lit(first))
        & (F.col("transaction_date") < F.lit(nxt))
        & (last_digit != 2)
        & F.col("amount_usd").isNotNull()
    ).select(
        "account_id",
        (
            F.col("amount_usd")
            + F.when(last_digit == 0, 0.02).when(last_digit == 1, 0.004).otherwise(0.0)
        ).alias("amount_usd"),
    )
    spark = silver.sparkSession
    ghosts = spark.createDataFrame([(g, 10.0) for g in GHOST_ACCOUNTS], "account_id string, amount_usd double")
    return rows.unionByName(ghosts)


def merge_side(raw_with_ties: DataFrame, before_split: bool) -> DataFrame:
    """Silver rules on the versions before (target) or from (source) 1999."""
    from finlake.operators.dedup import latest

    cut = F.col("updated_at") < F.lit(MERGE_SPLIT)
    part = raw_with_ties.filter(cut if before_split else ~cut)
    return (
        latest(part, ["transaction_id"], "updated_at", TIE_BREAKERS)
        .filter(F.col("status") == "COMPLETED")
        .select(
            "transaction_id",
            "account_id",
            "amount",
            "currency",
            "status",
            "updated_at",
            F.to_date("created_at").alias("transaction_date"),
        )
    )


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream payload rows derived from ``events`` (``n`` = event number)."""
    ev = table(spark, sf_dir, "events")
    n = F.col("event_id")
    # Currency spelling of the stream fixture.
    currency = (
        F.when(n % 5 == 0, F.lit(None))
        .when(n % 5 == 1, "usd")
        .when(n % 5 == 2, "EUR")
        .when(n % 5 == 3, "gbp")
        .otherwise("VND")
    )
    return ev.select(
        n.alias("n"),
        n.cast("string").alias("event_id"),
        F.concat(F.lit("t"), (n % 4000).cast("string")).alias("transaction_id"),
        F.when(n % 89 == 0, F.lit(None)).otherwise(F.col("user_id").cast("string")).alias("account_id"),
        F.col("value").alias("amount"),
        currency.alias("currency"),
        F.col("event_type"),
        F.col("ts").alias("event_time"),
    )


def event_payloads(rows: DataFrame) -> DataFrame:
    """Kafka-shaped rows (``n``, binary ``value``): JSON of the payload, with
    every 97th message cut in half (malformed)."""
    text = F.to_json(
        F.struct(*EVENT_COLUMNS),
        {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"},
    )
    cut = F.expr("substring(_json, 1, CAST(length(_json) / 2 AS INT))")
    return (
        rows.withColumn("_json", text)
        .withColumn("_json", F.when(F.col("n") % 97 == 0, cut).otherwise(F.col("_json")))
        .select("n", F.col("_json").cast("binary").alias("value"))
    )


def redelivered(payloads: DataFrame) -> DataFrame:
    """The messages delivered a second time, unchanged (every 10th)."""
    return payloads.filter(F.col("n") % 10 == 0)
