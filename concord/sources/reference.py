"""Reference inputs: FX rates, ISIN to LEI, search results, quotes, identifications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions.checked import Checked
from concord.functions.numbers import json_kind, json_number, json_percent_ratio, json_text
from concord.functions.text import non_blank, strip
from concord.functions.times import is_stale, unix_time, unless_stale
from concord.operators.dedup import last_per_key
from concord.operators.validate import validate
from concord.schema import RAW_SCHEMA, RATE
from concord.sources.landed import merge_maps_last_wins, place, read_json

# --- FX rates ------------------------------------------------------------------------

FX_DOC = f"result STRING, conversion_rates MAP<STRING, {RATE.simpleString().upper()}>"
# Fixed value: what a usable rates document says.
FX_SUCCESS = "success"


def read_rates(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``currency, rate``; a document that does not report success is an error.

    Of several landed documents the newest file that names a currency gives its rate.
    """
    docs = read_json(spark, path, FX_DOC, multi_line).select(
        "*", F.col("_metadata.file_modification_time").alias("_landed"), F.col("_metadata.file_path").alias("_file")
    )
    sound = F.coalesce(F.col("result") == FX_SUCCESS, F.lit(False))
    rates = F.when(sound, F.col("conversion_rates")).otherwise(
        F.raise_error(F.lit("the exchange-rate document does not report success")).cast(
            docs.schema["conversion_rates"].dataType
        )
    )
    every = docs.select(F.explode(rates).alias("currency", "rate"), "_landed", "_file")
    return last_per_key(every, F.col("currency"), ["_landed", "_file", "rate"]).select("currency", "rate")


# --- ISIN to LEI -----------------------------------------------------------------------


def read_isin_lei(spark: SparkSession, path: str) -> DataFrame:
    """``isin, lei`` from CSV with header ``LEI,ISIN``; the last row of an ISIN wins.

    Rows are ordered by file, block and position in the block.
    """
    raw = spark.read.schema("LEI STRING, ISIN STRING").option("header", True).csv(path)
    placed = raw.select(
        F.upper(strip(F.col("ISIN"))).alias("isin"),
        F.upper(strip(F.col("LEI"))).alias("lei"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    full = placed.filter((F.col("isin") != "") & (F.col("lei") != ""))
    return last_per_key(full, F.col("isin"), ["_file", "_block", "_line"]).select("isin", "lei")


# --- Search results ----------------------------------------------------------------------

SEARCH_DOC = """
    query STRING,
    quotes ARRAY<STRUCT<symbol: STRING, longname: STRING, shortname: STRING,
                        quoteType: STRING, exchange: STRING>>
"""


def read_search(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """``term, pos, candidate, longname, shortname, quote_type``."""
    docs = read_json(spark, path, SEARCH_DOC, multi_line)
    rows = docs.select(F.col("query").alias("term"), F.posexplode("quotes").alias("pos", "q"))
    return rows.select(
        "term",
        "pos",
        F.col("q.symbol").alias("candidate"),
        "q.longname",
        "q.shortname",
        F.col("q.quoteType").alias("quote_type"),
    )


# --- Quotes --------------------------------------------------------------------------------

QUOTE_SUMMARY_DOC = "symbol STRING, modules MAP<STRING, VARIANT>"
QUOTE_FALLBACK_DOC = "symbol STRING, results ARRAY<MAP<STRING, VARIANT>>"
# Quote modules in merge order; a later module overrides an earlier one.
QUOTE_MODULES = (
    "price",
    "quoteType",
    "summaryProfile",
    "summaryDetail",
    "defaultKeyStatistics",
    "financialData",
    "assetProfile",
    "esgScores",
    "incomeStatementHistory",
    "incomeStatementHistoryQuarterly",
    "balanceSheetHistory",
    "balanceSheetHistoryQuarterly",
    "cashFlowStatementHistory",
    "cashFlowStatementHistoryQuarterly",
    "calendarEvents",
    "secFilings",
    "recommendationTrend",
    "upgradeDowngradeHistory",
    "institutionOwnership",
    "fundOwnership",
    "majorDirectHolders",
    "majorHoldersBreakdown",
    "insiderTransactions",
    "insiderHolders",
    "earnings",
    "earningsHistory",
    "earningsTrend",
    "industryTrend",
    "indexTrend",
    "sectorTrend",
)
# Fixed value: the key only the primary endpoint has, even if its value is null.
PRIMARY_KEY = "52WeekChange"


def flat_modules(modules: Column, names: tuple[str, ...] = QUOTE_MODULES) -> Column:
    """One flat map from the module objects, in module order; later modules win."""
    objects = [
        F.try_variant_get(F.try_element_at(modules, F.lit(n)), "$", "map<string,variant>")
        for n in names
    ]
    return merge_maps_last_wins(F.array(*objects))


def read_quotes(
    spark: SparkSession, primary: str, fallback: str | None = None, multi_line: bool = False
) -> DataFrame:
    """``quote_symbol, q`` (flat map), plus the columns the candidate search checks.

    The fallback answers only for symbols the primary source has no document for.
    """
    docs = read_json(spark, primary, QUOTE_SUMMARY_DOC, multi_line)
    quotes = docs.select("symbol", flat_modules(F.col("modules")).alias("q"))
    if fallback:
        other = read_json(spark, fallback, QUOTE_FALLBACK_DOC, multi_line)
        other = other.select("symbol", F.get("results", F.lit(0)).alias("q"))
        other = other.filter(F.col("q").isNotNull()).join(quotes.select("symbol"), "symbol", "left_anti")
        quotes = quotes.unionByName(other)

    def text(key: str) -> Column:
        return json_text(F.try_element_at("q", F.lit(key)))

    return quotes.select(
        F.col("symbol").alias("quote_symbol"),
        "q",
        text("quoteType").alias("quote_type"),
        text("longName").alias("long_name"),
        text("shortName").alias("short_name"),
    )


# Quote keys behind the record fields that are copied as they are.
QUOTE_NUMBERS = {
    "market_cap": "marketCap",
    "fifty_two_week_min": "fiftyTwoWeekLow",
    "fifty_two_week_max": "fiftyTwoWeekHigh",
    "held_insiders": "heldPercentInsiders",
    "held_institutions": "heldPercentInstitutions",
    "short_interest": "shortPercentOfFloat",
    "share_float": "floatShares",
    "shares_outstanding": "sharesOutstanding",
    "revenue_per_share": "revenuePerShare",
    "profit_margin": "profitMargins",
    "gross_margin": "grossMargins",
    "operating_margin": "operatingMargins",
    "free_cash_flow": "freeCashflow",
    "operating_cash_flow": "operatingCashflow",
    "return_on_equity": "returnOnEquity",
    "return_on_assets": "returnOnAssets",
    "total_debt": "totalDebt",
    "revenue": "totalRevenue",
    "ebitda": "ebitda",
    "trailing_pe": "trailingPE",
    "price_to_book": "priceToBook",
}
# Quote keys in order of preference.
QUOTE_NUMBER_CHOICES = {
    "last_price": ("currentPrice", "regularMarketPrice"),
    "market_volume": ("volume", "regularMarketVolume"),
    "trailing_eps": ("trailingEps", "epsTrailingTwelveMonths"),
}
QUOTE_TEXT_CHOICES = {
    "name": ("longName", "shortName"),
    "symbol": ("underlyingSymbol", "symbol"),
    "currency": ("currency",),
    "analyst_rating": ("recommendationKey", "averageAnalystRating"),
    "industry": ("industry",),
    "sector": ("sector",),
}


def _known(v: Column) -> Column:
    """A JSON null counts as absent."""
    return F.when(json_kind(v).isNotNull(), v)


def quote_keys() -> tuple[str, ...]:
    """Every key of a flat quote that the projection reads."""
    choices = [*QUOTE_NUMBER_CHOICES.values(), *QUOTE_TEXT_CHOICES.values()]
    scaled = ("dividendYield", PRIMARY_KEY, "fiftyTwoWeekChangePercent")
    every = [*QUOTE_NUMBERS.values(), *[k for keys in choices for k in keys], *scaled, "regularMarketTime"]
    return tuple(dict.fromkeys(every))


def with_quote_keys(found: DataFrame) -> DataFrame:
    """Take the keys out of the map ``q`` once, as struct ``k``, and note its source."""
    keys = F.struct(*[F.try_element_at("q", F.lit(k)).alias(k) for k in quote_keys()])
    primary = F.map_contains_key("q", PRIMARY_KEY)
    return found.withColumns({"k": keys, "is_primary": primary}).drop("q")


def quote_fields(now: Column) -> dict[str, Column | Checked]:
    """Projection of a quote (see :func:`with_quote_keys`) onto the record."""

    def at(key: str) -> Column:
        return F.col("k").getField(key)

    def first_text(keys: tuple[str, ...]) -> Column:
        options = [json_text(at(k)) for k in keys]
        return F.coalesce(*[F.when(o != "", o) for o in options])

    def scaled(ratio_key: str, percent_key: str) -> Column:
        ratio, percent = json_number(at(ratio_key)), json_percent_ratio(at(percent_key))
        return F.when(F.col("is_primary"), ratio).otherwise(percent)

    fields: dict[str, Column] = {f: first_text(k) for f, k in QUOTE_TEXT_CHOICES.items()}
    fields |= {f: json_number(at(k)) for f, k in QUOTE_NUMBERS.items()}
    fields |= {
        f: json_number(F.coalesce(*[_known(at(k)) for k in keys]))
        for f, keys in QUOTE_NUMBER_CHOICES.items()
    }
    fields["dividend_yield"] = scaled("dividendYield", "dividendYield")
    fields["performance_1_year"] = scaled(PRIMARY_KEY, "fiftyTwoWeekChangePercent")
    traded = at("regularMarketTime")
    stale = is_stale(unix_time(F.when(json_kind(traded) == "number", json_text(traded))), now)
    return unless_stale(fields, stale)


def enrichment_rows(found: DataFrame, fields: dict, feed: str, rank: int) -> DataFrame:
    """Checked enrichment rows of groups (``share_class_figi`` plus feed columns); rows
    that fail are dropped, the group stays."""
    raw = {**fields, "share_class_figi": F.col("share_class_figi")}
    tagged = found.withColumns(
        {"feed": F.lit(feed), "feed_rank": F.lit(rank), "row_no": place(F.lit(0), F.lit(0))}
    )
    checked = validate(tagged, raw, counters=f"checked {feed}")
    return checked.filter(F.size("errors") == 0).select(*RAW_SCHEMA.names)


def lei_fields() -> dict[str, Column]:
    return {f: F.col(f) for f in ("name", "symbol", "isin", "lei")}


# --- Identification responses ---------------------------------------------------------------

RESPONSE_SCHEMA = """
    batch STRING, row_no BIGINT, query_number INT, queryId INT, request_index INT,
    shareClassFIGI STRING, ticker STRING, name STRING, securityName STRING
"""
QUERY_SCHEMA = "batch STRING, query_no BIGINT, id_type STRING, id_value STRING"


def read_responses(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    rows = read_json(spark, path, RESPONSE_SCHEMA, multi_line)
    return rows.withColumns({c: non_blank(F.col(c)) for c in ("ticker",)})
