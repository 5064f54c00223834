"""Conversion of monetary columns to US dollars.

The rates table has one row per currency code. The optimizer broadcasts it because its
file size is known and small; nothing is forced, so a table that grew past the broadcast
threshold would be joined by shuffle with adaptive skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from concord.schema import AMOUNT, MONETARY_FIELDS

# Target currency and kept decimal places.
TARGET_CURRENCY = "USD"
USD_PLACES = 4


def needs_no_conversion(currency: Column) -> Column:
    return currency.isNull() | (currency == TARGET_CURRENCY)


def usd_amount(amount: Column, rate: Column) -> Column:
    """``amount / rate`` rounded half-even to four places."""
    quotient = amount / F.when(rate > 0, rate)
    return F.bround(quotient, USD_PLACES).cast(AMOUNT)


def unique_rates(rates: DataFrame) -> DataFrame:
    """One row per currency. Repeated rows are one; two rates for a currency are an error,
    because a row would be converted twice or at random."""
    clash = F.raise_error(F.concat(F.lit("two rates for currency "), F.col("currency")))
    least, most = F.min("rate"), F.max("rate")
    one = F.when(least.eqNullSafe(most), least).otherwise(clash.cast(rates.schema["rate"].dataType))
    return rates.groupBy("currency").agg(one.alias("rate"))


def _with_verdict(df: DataFrame, rates: DataFrame, money: Sequence[str], currency: str):
    table = unique_rates(rates).select(F.col("currency").alias("_fx_code"), F.col("rate").alias("_fx_rate"))
    joined = df.join(table, F.col(currency) == F.col("_fx_code"), "left")
    passes = needs_no_conversion(F.col(currency))
    has_money = F.coalesce(*[F.col(m) for m in money]).isNotNull()
    rate = F.col("_fx_rate")
    usable = rate.isNotNull() & ((rate > 0) | ~has_money)
    return joined, passes, passes | usable


def to_usd(
    df: DataFrame,
    rates: DataFrame,
    money: Sequence[str] = MONETARY_FIELDS,
    currency: str = "currency",
    counters: str | Observation | None = None,
) -> DataFrame:
    """Convert, dropping rows whose currency has no usable rate.

    ``rates`` holds ``currency, rate`` (foreign units per dollar). A currency without a
    rate drops its row even when no money is set; a rate that is not positive drops
    only rows that carry money. ``counters`` observes the converted and skipped rows.
    """
    joined, passes, kept = _with_verdict(df, rates, money, currency)
    if counters is not None:
        joined = joined.observe(
            counters, F.count_if(kept).alias("converted"), F.count_if(~kept).alias("skipped")
        )
    rate = F.col("_fx_rate")
    converted = {m: F.when(passes, F.col(m)).otherwise(usd_amount(F.col(m), rate)) for m in money}
    code = F.when(passes, F.col(currency)).otherwise(F.lit(TARGET_CURRENCY))
    return (
        joined.filter(kept)
        .withColumns({**converted, currency: code})
        .drop("_fx_code", "_fx_rate")
    )


def without_rate(
    df: DataFrame,
    rates: DataFrame,
    money: Sequence[str] = MONETARY_FIELDS,
    currency: str = "currency",
) -> DataFrame:
    """The rows :func:`to_usd` drops, for the quarantine."""
    joined, _, kept = _with_verdict(df, rates, money, currency)
    return joined.filter(~kept).drop("_fx_code", "_fx_rate")
