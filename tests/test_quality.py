import pytest

from finlake.operators.quality import QualityError, enforce, report

DDL = "amount_usd double, account_id string, transaction_type string, has_currency_issue boolean"


def _rows(n, **over):
    base = dict(amount_usd=1.0, account_id="a", transaction_type="PAYMENT", has_currency_issue=False)
    return [tuple({**base, **over(i)}.values()) if callable(over) else tuple(base.values()) for i in range(n)]


def _df(spark, rows):
    return spark.createDataFrame(rows, DDL)


def make(spark, n, amount_nulls=0, acct_nulls=0, type_nulls=0, issues=0, negatives=0):
    rows = []
    for i in range(n):
        rows.append(
            (
                None if i < amount_nulls else (-1.0 if i < amount_nulls + negatives else 1.0),
                None if i < acct_nulls else "a",
                None if i < type_nulls else "PAYMENT",
                i < issues,
            )
        )
    return _df(spark, rows)


def test_empty_frame_fails(spark):
    with pytest.raises(QualityError, match="no rows to load"):
        enforce(report(_df(spark, [])))


def test_thresholds_are_inclusive(spark):
    # exactly 5% NULL amounts, 1% NULL types, 2% unknown currency: passes
    rep = report(make(spark, 100, amount_nulls=5, type_nulls=1, issues=2))
    assert enforce(rep) == []
    assert all(r["passed"] for r in rep.collect())


def test_just_above_threshold_fails(spark):
    with pytest.raises(QualityError, match="amount_usd is null in"):
        enforce(report(make(spark, 100, amount_nulls=6)))
    with pytest.raises(QualityError, match="account_id is null in"):
        enforce(report(make(spark, 100, acct_nulls=1)))
    with pytest.raises(QualityError, match="transaction_type is null in"):
        enforce(report(make(spark, 100, type_nulls=2)))
    with pytest.raises(QualityError, match="unknown currency"):
        enforce(report(make(spark, 100, issues=3)))


def test_negative_amount_is_warning_only(spark):
    warnings = enforce(report(make(spark, 100, negatives=3)))
    assert len(warnings) == 1 and "3 rows" in warnings[0]


def test_absent_column_skips_rule(spark):
    df = make(spark, 10).drop("transaction_type", "has_currency_issue")
    rules = {r["rule"] + ":" + str(r["column_name"]) for r in report(df).collect()}
    assert "null_rate:transaction_type" not in rules
    assert "currency_issue_rate:has_currency_issue" not in rules
    assert "null_rate:amount_usd" in rules


def test_report_is_one_aggregate(spark):
    plan = report(make(spark, 10))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") <= 2  # partial + final of one aggregate
