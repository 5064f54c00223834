"""Discovery feeds: landed documents to validated raw records.

Each feed is a schema, a function from documents to deduplicated records, and a
projection onto the common record. ``read_discovery`` unions them in registry order.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions.checked import Checked
from concord.functions.numbers import (
    json_kind,
    json_number,
    json_percent_ratio,
    json_text,
    json_typed_number,
    pence_number,
    pounds,
    zero_missing,
)
from concord.functions.text import padded_cik
from concord.functions.times import is_stale, iso_time, unix_time, unless_stale
from concord.operators.dedup import (
    first_per_key,
    first_per_key_or_blank,
    first_per_present_key,
    key_or_alternative,
)
from concord.operators.validate import validate
from concord.schema import RAW_SCHEMA
from concord.session import stage
from concord.sources.gates import before_gap, count_documents, document_status, keep_if_whole, pages_for_rows, single_page
from concord.sources.landed import BROKEN, exploded, place, read_json

log = logging.getLogger(__name__)

CHECKED_SCHEMA = T.StructType([*RAW_SCHEMA, T.StructField("errors", T.ArrayType(T.StringType()))])

Projection = Callable[[Column], Mapping[str, Column | Checked]]


Part = tuple[str, str]  # folder and schema of documents


@dataclass(frozen=True)
class Feed:
    """``rows(docs)`` takes the documents of each part (one frame, or one per folder of ``parts``) and
    gives ``r`` (struct) and ``row_no``; ``pick`` and ``key`` say which of equal records stay.

    ``page`` is the schema of the documents whose pages are counted; ``announced`` gives the number of
    pages that one announces. ``unbroken``: pages after a missing or unreadable one do not count.
    """

    name: str
    page: str
    rows: Callable[..., DataFrame]
    pick: Callable[[DataFrame, Column, Sequence[str]], DataFrame]
    key: Callable[[], Column]
    fields: Projection
    announced: Callable[[], Column] | None = None
    unbroken: bool = False
    #: Folders of a feed whose records are put together from several kinds of documents; the first
    #: has the pages.
    parts: tuple[Part, ...] = ()
    #: Joins what belongs to a record only after equal ones are gone.
    complete: Callable[..., DataFrame] | None = None

    def documents(self, spark: SparkSession, path: str, multi_line: bool = False, **streaming) -> list[DataFrame]:
        parts = [(f"{path}/{folder}", schema) for folder, schema in self.parts] or [(path, self.page)]
        return [read_json(spark, at, schema, multi_line, **streaming) for at, schema in parts]

    def status(self, docs: Sequence[DataFrame]) -> DataFrame:
        """What has landed of the feed (:func:`concord.sources.gates.document_status`), over all its
        folders: an unreadable document anywhere makes it incomplete."""
        found = document_status(docs[0], self.announced() if self.announced else None)
        for part in docs[1:]:
            broken = count_documents(part, F.col(BROKEN).isNotNull(), part.columns[0]).scalar()
            found = found.withColumn("unreadable", F.col("unreadable") + broken)
        return found.withColumn("complete", F.col("complete") & (F.col("unreadable") == 0))

    def all_rows(self, docs: Sequence[DataFrame]) -> DataFrame:
        docs = [single_page(docs[0]) if self.unbroken else docs[0], *docs[1:]]
        if self.unbroken:
            known = docs[0].filter(F.col("page_no").isNotNull()).withColumn("_feed", F.lit(self.name))
            docs[0] = before_gap(known, ["_feed"], "page_no")
        return self.rows(*docs)

    def records(self, docs: Sequence[DataFrame]) -> DataFrame:
        """The feed's records, the first of equal ones."""
        unique = self.pick(self.all_rows(docs), self.key(), ["row_no"])
        return self.complete(unique, *docs) if self.complete else unique


# --- Xetra -----------------------------------------------------------------------

XETRA_PAGE = """
    page_no INT, recordsTotal INT,
    data ARRAY<STRUCT<
        name: STRUCT<originalValue: STRING>, wkn: STRING, isin: STRING, slug: STRING,
        overview: STRUCT<lastPrice: VARIANT, dateTimeLastPrice: STRING>,
        performance: STRUCT<weeks52Low: VARIANT, weeks52High: VARIANT, performance1Year: VARIANT>,
        keyData: STRUCT<marketCapitalisation: VARIANT, dividendYield: VARIANT,
                        priceBookRatio: VARIANT, earningsPerShareBasic: VARIANT>>>
"""
# Venue and currency of the feed.
XETRA_MIC, XETRA_CURRENCY = "XETR", "EUR"
# Fixed value: rows per page.
XETRA_PAGE_ROWS = 100


def xetra_pages() -> Column:
    return pages_for_rows(F.col("recordsTotal"), XETRA_PAGE_ROWS)


def xetra_rows(docs: DataFrame) -> DataFrame:
    return exploded(docs, F.col("data"))


def xetra_fields(now: Column) -> dict[str, Column]:
    quote, past, key = F.col("r.overview"), F.col("r.performance"), F.col("r.keyData")
    fields = {
        "name": F.col("r.name.originalValue"),
        "symbol": F.col("r.wkn"),
        "isin": F.col("r.isin"),
        "mics": F.array(F.lit(XETRA_MIC)),
        "currency": F.lit(XETRA_CURRENCY),
        "last_price": json_number(quote["lastPrice"]),
        "market_cap": json_number(key["marketCapitalisation"]),
        "fifty_two_week_min": json_number(past["weeks52Low"]),
        "fifty_two_week_max": json_number(past["weeks52High"]),
        "performance_1_year": json_percent_ratio(past["performance1Year"]),
        "dividend_yield": json_percent_ratio(key["dividendYield"]),
        "price_to_book": json_number(key["priceBookRatio"]),
        "trailing_eps": json_number(key["earningsPerShareBasic"]),
    }
    return unless_stale(fields, is_stale(iso_time(quote["dateTimeLastPrice"]), now))


# --- LSEG ------------------------------------------------------------------------

LSEG_PAGE = """
    page_no INT,
    components ARRAY<STRUCT<type: STRING, content: ARRAY<STRUCT<name: STRING,
        value: STRUCT<totalPages: INT, content: ARRAY<STRUCT<
            issuername: STRING, tidm: STRING, isin: STRING, currency: STRING,
            lastprice: VARIANT, marketcapitalization: VARIANT,
            fiftyTwoWeeksMin: VARIANT, fiftyTwoWeeksMax: VARIANT>>>>>>>
"""
# Where the page keeps its rows, and the pence code with its major unit.
LSEG_COMPONENT, LSEG_ITEM = "price-explorer", "priceexplorersearch"
PENCE, POUND = "GBX", "GBP"


def lseg_value() -> Column:
    """The page's value object: first matching component, first matching item in it."""
    part = F.get(F.filter("components", lambda c: c["type"] == LSEG_COMPONENT), F.lit(0))
    return F.get(F.filter(part["content"], lambda i: i["name"] == LSEG_ITEM), F.lit(0))["value"]


def lseg_rows(docs: DataFrame) -> DataFrame:
    return exploded(docs, lseg_value()["content"])


def major_unit(v: Column, in_pence: Column) -> Column:
    """A price in the major unit; zero is how the feed writes a missing number."""
    number = json_number(v)
    usual = F.when(json_kind(v) == "number", zero_missing(number)).otherwise(number)
    return F.when(in_pence, pounds(pence_number(json_text(v)))).otherwise(usual)


def lseg_fields(now: Column) -> dict[str, Column]:
    in_pence = F.coalesce(F.col("r.currency") == PENCE, F.lit(False))
    return {
        "name": F.col("r.issuername"),
        "symbol": F.col("r.tidm"),
        "isin": F.col("r.isin"),
        "currency": F.when(in_pence, POUND).otherwise(F.col("r.currency")),
        "last_price": major_unit(F.col("r.lastprice"), in_pence),
        "market_cap": major_unit(F.col("r.marketcapitalization"), F.lit(False)),
        "fifty_two_week_min": major_unit(F.col("r.fiftyTwoWeeksMin"), in_pence),
        "fifty_two_week_max": major_unit(F.col("r.fiftyTwoWeeksMax"), in_pence),
    }


# --- Stock screener ----------------------------------------------------------------

SCREENER_PAGE = """
    page_no INT,
    data STRUCT<data: ARRAY<STRUCT<
        s: STRING, n: STRING, cusip: STRING, isin: STRING, sector: STRING, industry: STRING,
        marketCap: VARIANT, price: VARIANT, volume: VARIANT, peRatio: VARIANT,
        revenue: VARIANT, fcf: VARIANT, roe: VARIANT, roa: VARIANT, ebitda: VARIANT>>>
"""
# Fixed value: the feed lists one market only.
SCREENER_CURRENCY = "USD"


def screener_rows(docs: DataFrame) -> DataFrame:
    return exploded(docs, F.col("data.data"))


def screener_fields(now: Column) -> dict[str, Column | Checked]:
    return {
        "name": F.col("r.n"),
        "symbol": F.col("r.s"),
        "cusip": F.col("r.cusip"),
        "isin": F.col("r.isin"),
        "currency": F.lit(SCREENER_CURRENCY),
        "market_cap": json_typed_number(F.col("r.marketCap")),
        "last_price": json_typed_number(F.col("r.price")),
        "market_volume": json_typed_number(F.col("r.volume")),
        "trailing_pe": json_typed_number(F.col("r.peRatio")),
        "sector": F.col("r.sector"),
        "industry": F.col("r.industry"),
        "revenue": json_typed_number(F.col("r.revenue")),
        "free_cash_flow": json_typed_number(F.col("r.fcf")),
        "return_on_equity": json_percent_ratio(F.col("r.roe")),
        "return_on_assets": json_percent_ratio(F.col("r.roa")),
        "ebitda": json_typed_number(F.col("r.ebitda")),
    }


# --- Scanner -----------------------------------------------------------------------

SCANNER_PAGE = "page_no INT, totalCount INT, data ARRAY<STRUCT<s: STRING, d: ARRAY<VARIANT>>>"
# Length of a row and rows per page.
SCANNER_WIDTH, SCANNER_PAGE_ROWS = 20, 1000
# Position of each field in a scanner row.
SCANNER_TEXT = {"symbol": 0, "name": 1, "currency": 3, "sector": 17, "industry": 18}
SCANNER_NUMBERS = {
    "last_price": 4,
    "market_cap": 5,
    "market_volume": 6,
    "shares_outstanding": 9,
    "revenue": 10,
    "ebitda": 11,
    "trailing_pe": 12,
    "price_to_book": 13,
    "trailing_eps": 14,
}
SCANNER_PERCENTS = {"dividend_yield": 7, "return_on_equity": 15, "return_on_assets": 16}
SCANNER_TRADE_TIME = 19


def position(row: Column, at: int) -> Column:
    """Element of a positional row, null when the row is too short."""
    return F.get(row, F.lit(at))


def scanner_pages() -> Column:
    return pages_for_rows(F.col("totalCount"), SCANNER_PAGE_ROWS)


def scanner_symbol() -> Column:
    return json_text(position(F.col("r.d"), 0))


def scanner_rows(docs: DataFrame) -> DataFrame:
    rows = exploded(docs, F.col("data"))
    name = json_text(position(F.col("r.d"), 1))
    return rows.filter((F.size("r.d") >= SCANNER_WIDTH) & (scanner_symbol() != "") & (name != ""))


def scanner_fields(now: Column) -> dict[str, Column | Checked]:
    row = F.col("r.d")
    traded = position(row, SCANNER_TRADE_TIME)
    stale = is_stale(unix_time(F.when(json_kind(traded) == "number", json_text(traded))), now)
    numbers = {f: json_typed_number(position(row, i)) for f, i in SCANNER_NUMBERS.items()}
    # A stale price is dropped before it is looked at, so it cannot reject its row.
    values = unless_stale({f: n.value for f, n in numbers.items()}, stale)
    flags = unless_stale({f: n.wrong for f, n in numbers.items()}, stale)
    checked = {f: Checked(values[f], F.coalesce(flags[f], F.lit(False))) for f in numbers}
    texts = {f: json_text(position(row, i)) for f, i in SCANNER_TEXT.items()}
    percents = {f: json_percent_ratio(position(row, i)) for f, i in SCANNER_PERCENTS.items()}
    return {**texts, **checked, **percents}


# --- SEC ---------------------------------------------------------------------------

SEC_PAGE = "page_no INT, data ARRAY<ARRAY<VARIANT>>"
# Exchange names and their market codes.
EXCHANGE_MICS = {"Nasdaq": "XNAS", "NYSE": "XNYS", "CBOE": "XCBO", "OTC": "XOTC"}


def exchange_mics(exchange: Column) -> Column:
    pairs = [F.lit(x) for pair in EXCHANGE_MICS.items() for x in pair]
    mic = F.try_element_at(F.create_map(*pairs), exchange)
    return F.when(mic.isNotNull(), F.array(mic)).otherwise(F.array().cast("array<string>"))


def sec_rows(docs: DataFrame) -> DataFrame:
    rows = exploded(docs, F.col("data"))
    cells = [json_text(position(F.col("r"), i)) for i in range(4)]
    names = ("cik", "name", "symbol", "exchange")
    named = rows.select(F.struct(*[c.alias(n) for c, n in zip(cells, names)]).alias("r"), "row_no")
    full = [F.coalesce(F.col(f"r.{n}") != "", F.lit(False)) for n in names]
    return named.filter(full[0] & full[1] & full[2] & full[3] & (F.col("r.cik") != "0"))


def sec_fields(now: Column) -> dict[str, Column]:
    return {
        "cik": padded_cik(F.col("r.cik")),
        "name": F.col("r.name"),
        "symbol": F.col("r.symbol"),
        "mics": exchange_mics(F.col("r.exchange")),
    }


# --- Intrinio ------------------------------------------------------------------------

COMPANIES_PAGE = """
    page_no INT, next_page STRING,
    companies ARRAY<STRUCT<id: STRING, ticker: STRING, name: STRING, lei: STRING, cik: STRING>>
"""
SECURITIES_DOC = """
    company_ticker STRING,
    company STRUCT<id: STRING, ticker: STRING, name: STRING, lei: STRING, cik: STRING>,
    securities ARRAY<STRUCT<ticker: STRING, share_class_figi: STRING, figi: STRING,
                            composite_figi: STRING, currency: STRING, exchange_mic: STRING>>
"""
QUOTE_DOC = """
    share_class_figi STRING,
    quote STRUCT<last: VARIANT, eod_fifty_two_week_low: VARIANT, eod_fifty_two_week_high: VARIANT,
                 market_volume: VARIANT, dividendyield: VARIANT, marketcap: VARIANT,
                 change_percent_365_days: VARIANT, last_time: STRING>
"""


def valid_companies(pages: DataFrame) -> DataFrame:
    """``company_ticker, company_no`` of companies with a ticker and a name, once each."""
    rows = exploded(pages, F.col("companies"))
    sound = rows.filter((F.col("r.ticker") != "") & (F.col("r.name") != ""))
    named = sound.select(F.col("r.ticker").alias("company_ticker"), F.col("row_no").alias("company_no"))
    return named.groupBy("company_ticker").agg(F.min("company_no").alias("company_no"))


def one_document(docs: DataFrame, key: str, newest: Column, content: Column) -> DataFrame:
    """One document per key, whatever landed twice: the newest, of equal ones any by content."""
    order = F.struct(newest.alias("newest"), F.xxhash64(F.to_json(content)).alias("content"))
    kept = docs.filter(F.col(key).isNotNull()).groupBy(key)
    return kept.agg(F.max_by(F.struct(*[c for c in docs.columns if c != key]), order).alias("d")).select(key, "d.*")


def securities_of(companies: DataFrame, documents: DataFrame) -> DataFrame:
    """Securities with a share-class id, carrying the company named in their own
    document. A company without a document contributes none, one with several a single one."""
    whole = F.struct("company", "securities")
    single = one_document(documents.select("company_ticker", "company", "securities"), "company_ticker", F.lit(0), whole)
    joined = companies.join(single, "company_ticker", "inner")
    each = joined.select("company_no", "company", F.posexplode("securities").alias("_at", "s"))
    sound = each.filter(F.coalesce(F.col("s.share_class_figi") != "", F.lit(False)))
    return sound.select(
        place(F.col("company_no.page"), F.col("company_no.position"), F.col("_at")).alias("row_no"),
        F.struct("company.name", "company.lei", "company.cik", "s.*").alias("r"),
    )


def with_quotes(securities: DataFrame, quotes: DataFrame) -> DataFrame:
    """Left join with one quote per id, the newest: a security without a quote keeps a null one."""
    single = one_document(quotes.select("share_class_figi", "quote"), "share_class_figi", F.col("quote.last_time"), F.col("quote"))
    table = single.select(F.col("share_class_figi").alias("_id"), "quote")
    joined = securities.join(table, F.col("r.share_class_figi") == F.col("_id"), "left")
    return joined.select(F.struct("r.*", "quote").alias("r"), "row_no")


def intrinio_rows(companies: DataFrame, securities: DataFrame, quotes: DataFrame) -> DataFrame:
    return securities_of(valid_companies(companies), securities)


def intrinio_complete(unique: DataFrame, companies: DataFrame, securities: DataFrame, quotes: DataFrame) -> DataFrame:
    return with_quotes(unique, quotes)


def intrinio_fields(now: Column) -> dict[str, Column]:
    quote, mic = F.col("r.quote"), F.col("r.exchange_mic")
    fields = {
        "name": F.col("r.name"),
        "cik": F.col("r.cik"),
        "lei": F.col("r.lei"),
        "symbol": F.col("r.ticker"),
        "share_class_figi": F.col("r.share_class_figi"),
        "mics": F.when(mic != "", F.array(mic)),
        "currency": F.col("r.currency"),
        "last_price": json_number(quote["last"]),
        "fifty_two_week_min": json_number(quote["eod_fifty_two_week_low"]),
        "fifty_two_week_max": json_number(quote["eod_fifty_two_week_high"]),
        "market_volume": json_number(quote["market_volume"]),
        "dividend_yield": json_percent_ratio(quote["dividendyield"]),
        "market_cap": json_number(quote["marketcap"]),
        "performance_1_year": json_percent_ratio(quote["change_percent_365_days"]),
    }
    return unless_stale(fields, is_stale(iso_time(quote["last_time"]), now))


# --- Registry ----------------------------------------------------------------------

#: The discovery feeds; the position in the list is the feed's rank.
DISCOVERY_FEEDS: tuple[Feed, ...] = (
    Feed("xetra", XETRA_PAGE, xetra_rows, first_per_key_or_blank, lambda: F.col("r.isin"), xetra_fields, announced=xetra_pages),
    Feed(
        "lseg", LSEG_PAGE, lseg_rows, first_per_present_key, lambda: F.col("r.isin"), lseg_fields,
        announced=lambda: lseg_value()["totalPages"], unbroken=True,
    ),
    Feed("screener", SCREENER_PAGE, screener_rows, first_per_key, lambda: key_or_alternative(F.col("r.isin"), F.col("r.s")), screener_fields),
    Feed("scanner", SCANNER_PAGE, scanner_rows, first_per_present_key, scanner_symbol, scanner_fields, announced=scanner_pages),
    Feed("sec", SEC_PAGE, sec_rows, first_per_key, lambda: F.col("r.cik"), sec_fields),
    Feed(
        "intrinio", COMPANIES_PAGE, intrinio_rows, first_per_present_key, lambda: F.col("r.share_class_figi"), intrinio_fields,
        parts=(("companies", COMPANIES_PAGE), ("securities", SECURITIES_DOC), ("quotes", QUOTE_DOC)), complete=intrinio_complete,
    ),
)


def checked_records(feed: Feed, rank: int, records: DataFrame, now: Column) -> DataFrame:
    """Validated rows with their ``errors``, good and bad alike; columns besides ``r`` stay."""
    tagged = records.withColumns({"feed": F.lit(feed.name), "feed_rank": F.lit(rank)})
    return validate(tagged, feed.fields(now), counters=f"checked {feed.name}").drop("r")


def checked_feed(
    spark: SparkSession, feed: Feed, rank: int, path: str, now: Column, multi_line: bool = False
) -> DataFrame:
    """Validated rows of one feed as it has landed."""
    records = feed.records(feed.documents(spark, path, multi_line))
    return checked_records(feed, rank, records, now).select(*RAW_SCHEMA.names, "errors")


def _read_feed(
    spark: SparkSession, feed: Feed, rank: int, path: str, now: Column, multi_line: bool, keep: str | None
) -> DataFrame | None:
    """One feed's rows, staged; none if it cannot be read or has not begun."""
    try:
        status = feed.status(feed.documents(spark, path, multi_line))
        found = status.first()
        if not found["started"]:
            log.error("feed %s skipped: its first page is missing or unreadable", feed.name)
            return None
        rows = stage(checked_feed(spark, feed, rank, path, now, multi_line), f"feed-{feed.name}")
        if not found["complete"]:
            log.warning("feed %s is incomplete: %s", feed.name, found.asDict())
        elif keep is not None:
            keep_if_whole(rows, status, f"{keep}/{feed.name}")
        return rows
    except (PySparkException, Py4JJavaError) as failure:  # what reading or parsing threw, on the driver or in a task
        log.error("feed %s skipped: %s", feed.name, str(failure).splitlines()[0])
        return None


def read_discovery(
    spark: SparkSession,
    root: str,
    now: Column,
    feeds: Sequence[Feed] = DISCOVERY_FEEDS,
    multi_line: bool = False,
    keep: str | None = None,
) -> DataFrame:
    """Union of all feeds under ``root/<feed name>``, checked and staged.

    Each feed is a job of its own and all run side by side. A feed that fails, be it while its rows are
    read, or whose first page is missing, contributes no rows and does not stop the others. One that
    is incomplete (unreadable or missing pages) is used and its faults are logged; only complete feeds
    are kept, as Parquet under ``keep/<feed name>``.
    """

    def one(ranked: tuple[int, Feed]) -> DataFrame | None:
        rank, feed = ranked
        return _read_feed(spark, feed, rank, f"{root}/{feed.name}", now, multi_line, keep)

    with ThreadPoolExecutor(max(1, len(feeds))) as pool:
        staged = [rows for rows in pool.map(one, enumerate(feeds)) if rows is not None]
    return reduce(DataFrame.unionByName, staged, spark.createDataFrame([], CHECKED_SCHEMA))
