"""Currency normalisation (B1, B2) as code-generated column expressions.

Conversion is a map lookup inside one Project: no join, no shuffle, no UDF.
A dated rate table is joined instead (``normalize_with_rate_table``), in an
equi-join that Spark broadcasts while the table is small.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Default units of each currency per one US dollar.
DEFAULT_RATES: dict[str, float] = {
    "USD": 1.0,
    "EUR": 0.92,
    "GBP": 0.79,
    "VND": 24800.0,
    "JPY": 149.5,
    "SGD": 1.34,
}
# The codes accepted by the currency-issue flag.
VALID_CURRENCIES: tuple[str, ...] = tuple(DEFAULT_RATES)

BASE_CURRENCY = "USD"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def usd_expr(
    amount: str | Column,
    currency: str | Column,
    rates: Mapping[str, float] | None = None,
) -> Column:
    """Amount in US dollars: ``amount / rate[currency]``.

    * USD passes through unchanged, whatever ``rates`` says about USD.
    * ``None`` or an empty mapping means the default rates.
    * An unknown or NULL code, a NULL amount, a non-numeric amount and a
      zero rate all give NULL (``try_cast`` / ``try_divide`` under ANSI).
    * Codes match exactly: no trimming, no case folding.
    """
    table = dict(rates) if rates else dict(DEFAULT_RATES)
    amount_d = _as_col(amount).try_cast("double")
    code = _as_col(currency)
    others = [(k, float(v)) for k, v in table.items() if k != BASE_CURRENCY]
    if others:
        rate_map = F.create_map(*[F.lit(x) for kv in others for x in kv])
        converted = F.try_divide(amount_d, F.try_element_at(rate_map, code))
    else:
        converted = F.lit(None).cast("double")
    return F.when(code == F.lit(BASE_CURRENCY), amount_d).otherwise(converted)


def normalize_to_usd(
    df: DataFrame,
    amount_col: str,
    currency_col: str,
    output_col: str = "amount_usd",
    exchange_rates: Mapping[str, float] | None = None,
) -> DataFrame:
    """Add ``output_col`` = the amount converted to US dollars (B1)."""
    return df.withColumn(output_col, usd_expr(amount_col, currency_col, exchange_rates))


def currency_issue_expr(
    currency: str | Column, valid_currencies: Iterable[str] | None = None
) -> Column:
    """TRUE for a code outside the accepted list, NULL for a NULL code."""
    valid = list(valid_currencies) if valid_currencies is not None else list(VALID_CURRENCIES)
    return ~_as_col(currency).isin(valid)


def flag_currency_issues(
    df: DataFrame,
    currency_col: str,
    valid_currencies: Iterable[str] | None = None,
    output_col: str = "has_currency_issue",
) -> DataFrame:
    """Add the currency-issue flag (B2). The default list is the default
    rate table's codes, also when custom rates were used for conversion."""
    return df.withColumn(output_col, currency_issue_expr(currency_col, valid_currencies))


def normalize_with_rate_table(
    df: DataFrame,
    rates: DataFrame,
    amount_col: str,
    currency_col: str,
    date_col: str,
    output_col: str = "amount_usd",
    rate_date_col: str = "rate_date",
    rate_currency_col: str = "currency",
    rate_col: str = "units_per_usd",
) -> DataFrame:
    """Convert with a dated rate table (date, currency, units per USD).

    One left equi-join on (date, currency); Spark picks the join by the
    measured size of the rates. The
    rate table must hold at most one rate per (date, currency).
    """
    r = rates.select(
        F.col(rate_date_col).alias("_fx_date"),
        F.col(rate_currency_col).alias("_fx_code"),
        F.col(rate_col).cast("double").alias("_fx_rate"),
    )
    joined = df.join(
        r,
        (F.col(date_col) == F.col("_fx_date")) & (F.col(currency_col) == F.col("_fx_code")),
        "left",
    )
    amount_d = F.col(amount_col).try_cast("double")
    usd = F.when(F.col(currency_col) == F.lit(BASE_CURRENCY), amount_d).otherwise(
        F.try_divide(amount_d, F.col("_fx_rate"))
    )
    return joined.withColumn(output_col, usd).drop("_fx_date", "_fx_code", "_fx_rate")
