import pytest
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from finlake.functions.currency import flag_currency_issues, normalize_to_usd

SCHEMA = StructType(
    [StructField("tx_id", StringType()), StructField("amount", DoubleType()), StructField("currency", StringType())]
)


# code, amount, expected dollars, expected flag
CASES = [
    ("USD", 0.0, 0.0, False),
    ("USD", -31.5, -31.5, False),
    ("EUR", 460.0, 500.0, False),
    ("QQQ", 7.25, None, True),
    ("", 1.0, None, True),
    ("EUR", None, None, False),
]


def test_conversion_and_flag_by_case(spark):
    df = spark.createDataFrame([(str(k), amount, code) for k, (code, amount, _, _) in enumerate(CASES)], SCHEMA)
    both = flag_currency_issues(normalize_to_usd(df, "amount", "currency"), "currency")
    got = {int(r["tx_id"]): (r["amount_usd"], r["has_currency_issue"]) for r in both.collect()}
    assert got == {k: (pytest.approx(usd) if usd is not None else None, flag) for k, (_, _, usd, flag) in enumerate(CASES)}


def test_edge_codes(spark):
    df = spark.createDataFrame(
        [("a", 10.0, "usd"), ("b", 10.0, " USD"), ("c", 10.0, None), ("d", 248.0, "VND")], SCHEMA
    )
    out = {r["tx_id"]: r for r in flag_currency_issues(normalize_to_usd(df, "amount", "currency"), "currency").collect()}
    # exact, case-sensitive match, no trimming
    assert out["a"]["amount_usd"] is None and out["a"]["has_currency_issue"] is True
    assert out["b"]["amount_usd"] is None and out["b"]["has_currency_issue"] is True
    # NULL code: NULL amount and NULL flag (not true)
    assert out["c"]["amount_usd"] is None and out["c"]["has_currency_issue"] is None
    assert out["d"]["amount_usd"] == pytest.approx(0.01)


def test_custom_rates(spark):
    df = spark.createDataFrame([("a", 10.0, "USD"), ("b", 9.0, "EUR"), ("c", 10.0, "GBP"), ("d", 5.0, "XYZ")], SCHEMA)
    out = {r["tx_id"]: r["amount_usd"] for r in normalize_to_usd(df, "amount", "currency", exchange_rates={"USD": 3.0, "EUR": 0.9, "XYZ": 0.0}).collect()}
    assert out["a"] == 10.0  # a custom USD rate is ignored
    assert out["b"] == pytest.approx(10.0)
    assert out["c"] is None  # custom rates replace the defaults
    assert out["d"] is None  # zero rate: NULL, not an error


def test_empty_rates_mean_defaults(spark):
    df = spark.createDataFrame([("b", 92.0, "EUR")], SCHEMA)
    assert normalize_to_usd(df, "amount", "currency", exchange_rates={}).first()["amount_usd"] == pytest.approx(100.0)


def test_string_amounts(spark):
    df = spark.createDataFrame([("a", "92", "EUR"), ("b", "abc", "EUR")], "tx_id string, amount string, currency string")
    out = {r["tx_id"]: r["amount_usd"] for r in normalize_to_usd(df, "amount", "currency").collect()}
    assert out["a"] == pytest.approx(100.0) and out["b"] is None


def test_flag_uses_default_list_even_with_custom_rates(spark):
    df = spark.createDataFrame([("a", 1.0, "JPY")], SCHEMA)
    out = flag_currency_issues(normalize_to_usd(df, "amount", "currency", exchange_rates={"EUR": 0.9}), "currency").first()
    assert out["amount_usd"] is None and out["has_currency_issue"] is False


def test_dated_rates(spark):
    import datetime as dt

    from finlake.functions.currency import normalize_with_rate_table

    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    tx = spark.createDataFrame(
        [("a", 90.0, "EUR", d1), ("b", 90.0, "EUR", d2), ("c", 90.0, "EUR", d3), ("d", 7.0, "USD", d3)],
        "tx_id string, amount double, currency string, day date",
    )
    rates = spark.createDataFrame(
        [(d1, "EUR", 0.9), (d2, "EUR", 0.8), (d1, "USD", 5.0)], "rate_date date, currency string, units_per_usd double"
    )
    out = normalize_with_rate_table(tx, rates, "amount", "currency", "day")
    got = {r["tx_id"]: r["amount_usd"] for r in out.collect()}
    assert got["a"] == pytest.approx(100.0) and got["b"] == pytest.approx(112.5)
    assert got["c"] is None  # no rate for that day
    assert got["d"] == 7.0  # USD passes through
