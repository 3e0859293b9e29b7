"""Quality gate of the silver table (B4) in one aggregate.

``report`` computes every rule from a single ``agg`` of ``count_if``s and
returns one row per rule; ``enforce`` collects that (tiny) report and
raises on the first failed error rule, in rule order. ``metrics`` are the
same counts for ``DataFrame.observe``: a write can gather them as it goes,
and ``report_of`` judges them without reading the rows again.
"""
from __future__ import annotations

import logging

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# The gate's rules, checked in this order.
#   rows after transform must be > 0                      (error)
#   NULL rate of amount_usd must be <= 5%                 (error)
#   NULL rate of account_id must be <= 0%                 (error)
#   NULL rate of transaction_type must be <= 1%           (error)
#   negative amount_usd rows                              (warning only)
#   rate of has_currency_issue = true must be <= 2%       (error)
NULL_RATE_RULES: tuple[tuple[str, float], ...] = (
    ("amount_usd", 0.05),
    ("account_id", 0.0),
    ("transaction_type", 0.01),
)
NEGATIVE_AMOUNT_COLUMN = "amount_usd"
CURRENCY_ISSUE_COLUMN = "has_currency_issue"
CURRENCY_ISSUE_MAX_RATE = 0.02

REPORT_COLUMNS = [
    "rule_order",
    "rule",
    "column_name",
    "violations",
    "total_rows",
    "metric",
    "threshold",
    "severity",
    "passed",
]


def _rule(order: int, rule: str, column: str | None, violations: Column, metric: Column,
          threshold: float, severity: str, passed: Column) -> Column:
    return F.struct(
        F.lit(order).cast("int").alias("rule_order"),
        F.lit(rule).alias("rule"),
        F.lit(column).cast("string").alias("column_name"),
        violations.cast("long").alias("violations"),
        F.col("_total").cast("long").alias("total_rows"),
        metric.cast("double").alias("metric"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit(severity).alias("severity"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def metrics(columns: Sequence[str]) -> list[Column]:
    """The counts that the rules need, for a table with these columns."""
    out = [F.count(F.lit(1)).alias("_total")]
    for order, (column, _) in enumerate(NULL_RATE_RULES, 2):
        if column in columns:
            out.append(F.count_if(F.col(column).isNull()).alias(f"_null_{order}"))
    if NEGATIVE_AMOUNT_COLUMN in columns:
        c = F.col(NEGATIVE_AMOUNT_COLUMN)
        out.append(F.count_if(c.isNotNull() & (c < 0)).alias("_neg"))
    if CURRENCY_ISSUE_COLUMN in columns:
        out.append(F.count_if(F.col(CURRENCY_ISSUE_COLUMN)).alias("_cur"))
    return out


def _judged(counts: DataFrame) -> DataFrame:
    """One row of ``metrics`` -> one row per rule that it has the count of."""
    total = F.col("_total")

    def rate(v: str) -> Column:
        return F.try_divide(F.col(v).cast("double"), total.cast("double"))

    rules = [_rule(1, "row_count", None, (total == 0).cast("long"), total, 0.0, "error", total > 0)]
    for order, (column, max_rate) in enumerate(NULL_RATE_RULES, 2):
        v = f"_null_{order}"
        if v in counts.columns:
            rules.append(_rule(order, "null_rate", column, F.col(v), rate(v), max_rate, "error", rate(v) <= F.lit(max_rate)))
    order = 2 + len(NULL_RATE_RULES)
    if "_neg" in counts.columns:
        rules.append(_rule(order, "negative_amount", NEGATIVE_AMOUNT_COLUMN, F.col("_neg"), F.col("_neg"), 0.0, "warning", F.col("_neg") == 0))
    if "_cur" in counts.columns:
        rules.append(_rule(order + 1, "currency_issue_rate", CURRENCY_ISSUE_COLUMN, F.col("_cur"), rate("_cur"),
                           CURRENCY_ISSUE_MAX_RATE, "error", rate("_cur") <= F.lit(CURRENCY_ISSUE_MAX_RATE)))
    return counts.select(F.inline(F.array(*rules)))


def report(df: DataFrame) -> DataFrame:
    """One row per applicable rule (a rule whose column is absent is
    skipped). ``metric`` is a rate for rate rules and a count otherwise."""
    return _judged(df.agg(*metrics(df.columns)))


def report_of(spark: SparkSession, counted: Mapping[str, int]) -> DataFrame:
    """The report from counts already taken (an observation's values)."""
    ddl = ", ".join(f"{c} long" for c in counted)
    return _judged(spark.createDataFrame([tuple(int(v or 0) for v in counted.values())], ddl))


class QualityError(ValueError):
    """A failed error rule of the quality gate."""


def enforce(report_df) -> list[str]:
    """Raise ``QualityError`` on the first failed error rule; return the
    messages of failed warning rules. Takes the report DataFrame or its
    already collected rows (at most one row per rule)."""
    warnings: list[str] = []
    rows = report_df if isinstance(report_df, list) else report_df.collect()
    for row in sorted(rows, key=lambda r: r["rule_order"]):
        if row["passed"]:
            continue
        if row["rule"] == "row_count":
            raise QualityError("the transform left no rows to load")
        if row["severity"] == "warning":
            msg = f"{row['column_name']} is below zero in {row['violations']} rows"
            log.warning(msg)
            warnings.append(msg)
            continue
        metric = row["metric"]
        if row["rule"] == "null_rate":
            raise QualityError(
                f"{row['column_name']} is null in {metric:.2%} of rows, allowed are {row['threshold']:.2%}"
            )
        raise QualityError(
            f"{metric:.2%} of rows have an unknown currency, allowed are {row['threshold']:.0%}"
        )
    return warnings
