import datetime as dt

import pytest

from finlake.plans.silver import transform
from finlake.schemas import RAW_TRANSACTION
from finlake.sinks.upsert import upsert

T0 = dt.datetime(2024, 1, 1, 9)


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_TRANSACTION)


def row(tx, acct, amount, cur, status, created, updated):
    return (tx, acct, amount, cur, "PAYMENT", status, created, updated, None)


def test_collapse_runs_before_status_filter(spark):
    rows = [
        row("t1", "a", 10.0, "USD", "COMPLETED", T0, T0),
        row("t1", "a", 10.0, "USD", "PENDING", T0, T0 + dt.timedelta(hours=1)),  # newest: not completed
        row("t2", "a", 5.0, "EUR", "COMPLETED", T0, T0),
    ]
    out = transform(_raw(spark, rows), T0)
    assert sorted(r["transaction_id"] for r in out.collect()) == ["t2"]


def test_required_fields_are_enforced_and_dates_derived(spark):
    rows = [
        row("t1", None, 10.0, "USD", "COMPLETED", T0, T0),
        row("t2", "a", 10.0, "USD", "COMPLETED", None, T0),
        row("t3", "a", 10.0, "GBP", "COMPLETED", dt.datetime(2024, 2, 29, 23, 59), T0),
    ]
    out = transform(_raw(spark, rows), T0).collect()
    assert [r["transaction_id"] for r in out] == ["t3"]
    r = out[0]
    assert (r["transaction_date"], r["transaction_year"], r["transaction_month"]) == (dt.date(2024, 2, 29), 2024, 2)
    assert r["amount_usd"] == pytest.approx(10.0 / 0.79) and r["has_currency_issue"] is False
    assert r["_etl_loaded_at"] == T0


def test_catalog_table_is_created_not_replaced(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    name = "default.finlake_upsert_probe"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    res = upsert(spark, df, name, ["k"])
    assert res == {"rows_inserted": 1, "rows_updated": 0, "created": True}
    assert spark.catalog.tableExists(name)
    # a file table has no row-level MERGE, and this one no partitions to merge
    # by: a second upsert must fail loudly, never replace the table
    with pytest.raises(ValueError):
        upsert(spark, spark.createDataFrame([("a", 2)], "k string, v int"), name, ["k"])
    assert [tuple(r) for r in spark.table(name).collect()] == [("a", 1)]


def test_dates_are_utc_whatever_the_session_zone(spark):
    from finlake.plans import catalogue

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = catalogue.q_silver_transactions(spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
        bad = df.filter("transaction_date <> CAST(created_at AS DATE)").count()
        assert bad == 0 and df.count() == 734
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
