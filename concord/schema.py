"""Row types: the flat raw record, the nested canonical record, field groups."""

from __future__ import annotations

from pyspark.sql import types as T

#: Money and ratios. ``DECIMAL(28,10) / DECIMAL(18,8)`` keeps scale 12 in Spark, so
#: a quotient can still be rounded to four places without loss.
AMOUNT = T.DecimalType(28, 10)
RATE = T.DecimalType(18, 8)

# Field names and groups of the record, in schema order.
IDENTITY_FIELDS = (
    "name",
    "symbol",
    "share_class_figi",
    "isin",
    "cusip",
    "cik",
    "lei",
)
UNSIGNED_FIELDS = (
    "last_price",
    "market_cap",
    "fifty_two_week_min",
    "fifty_two_week_max",
    "dividend_yield",
    "market_volume",
    "held_insiders",
    "held_institutions",
    "short_interest",
    "share_float",
    "shares_outstanding",
    "total_debt",
)
SIGNED_FIELDS = (
    "revenue_per_share",
    "profit_margin",
    "gross_margin",
    "operating_margin",
    "free_cash_flow",
    "operating_cash_flow",
    "return_on_equity",
    "return_on_assets",
    "performance_1_year",
    "revenue",
    "ebitda",
    "trailing_pe",
    "price_to_book",
    "trailing_eps",
)
MONETARY_FIELDS = (
    "last_price",
    "market_cap",
    "fifty_two_week_min",
    "fifty_two_week_max",
    "revenue_per_share",
    "free_cash_flow",
    "operating_cash_flow",
    "total_debt",
    "revenue",
    "ebitda",
    "trailing_eps",
)
PRICE_SENSITIVE_FIELDS = (
    "last_price",
    "fifty_two_week_min",
    "fifty_two_week_max",
    "market_volume",
    "market_cap",
)
PRICE_RANGE_FIELDS = ("last_price", "fifty_two_week_min", "fifty_two_week_max")

AMOUNT_FIELDS = UNSIGNED_FIELDS + SIGNED_FIELDS
LABEL_FIELDS = ("analyst_rating", "industry", "sector")
FINANCIAL_FIELDS = ("mics", "currency", *AMOUNT_FIELDS, *LABEL_FIELDS)
RECORD_FIELDS = (*IDENTITY_FIELDS, *FINANCIAL_FIELDS)

#: Deterministic source order: registry position of the feed, then position in it.
ORDER_FIELDS = ("feed_rank", "row_no")


#: Place of a record in its feed: page, place in the page, place within that record's own list.
POSITION = T.StructType([T.StructField(n, T.LongType()) for n in ("page", "position", "inner")])


def field_type(name: str) -> T.DataType:
    if name == "mics":
        return T.ArrayType(T.StringType())
    return AMOUNT if name in AMOUNT_FIELDS else T.StringType()


RECORD_SCHEMA = T.StructType([T.StructField(f, field_type(f)) for f in RECORD_FIELDS])

RAW_SCHEMA = T.StructType(
    [
        T.StructField("feed", T.StringType()),
        T.StructField("feed_rank", T.IntegerType()),
        T.StructField("row_no", POSITION),
        *RECORD_SCHEMA.fields,
    ]
)

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField(
            "identity",
            T.StructType([T.StructField(f, field_type(f)) for f in IDENTITY_FIELDS]),
        ),
        T.StructField(
            "financials",
            T.StructType([T.StructField(f, field_type(f)) for f in FINANCIAL_FIELDS]),
        ),
        T.StructField("snapshot_date", T.DateType()),
    ]
)
