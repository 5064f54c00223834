"""The discovery feeds over documents that are made of the given tables.

Each query writes its table as the JSON pages which the feed's service would have answered (a bounded
number of records a page), parses them like landed files, and gives the checked records. Its SQL takes the
same fields straight from the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.queries.base import doubles, query, table
from concord.sources.feeds import DISCOVERY_FEEDS, checked_records
from concord.sources.landed import BROKEN

NOW = "2026-03-10 12:00:00"
FRESH, OLD = "2026-03-10T09:00:00Z", "2026-03-01T09:00:00Z"
PAGE = 100


def documents(texts: DataFrame, schema: str) -> DataFrame:
    """Parsed documents of a column ``doc`` of JSON text, a broken one kept as text."""
    parsed = F.from_json("doc", f"{schema}, {BROKEN} STRING", {"columnNameOfCorruptRecord": BROKEN})
    return texts.select(parsed.alias("d")).select("d.*")


def pages(rows: DataFrame, key: str, record: Column, wrap: tuple[str, str]) -> DataFrame:
    """One document per ``PAGE`` consecutive keys (from 1): ``record`` is JSON text, ``wrap`` what stands
    around the list."""
    at = (F.col(key) - 1).cast("long")
    each = rows.select((at / PAGE).cast("long").alias("page_no"), F.struct(at.alias("at"), record.alias("record")).alias("r"))
    listed = each.groupBy("page_no").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    body = F.concat_ws(",", F.transform("rs", lambda r: r["record"]))
    return listed.select(F.concat(F.lit('{"page_no":'), "page_no", F.lit("," + wrap[0]), body, F.lit(wrap[1])).alias("doc"))


def checked(name: str, docs: Sequence[DataFrame], texts: Sequence[str], amounts: Sequence[str]) -> DataFrame:
    """Records of a feed: text fields, amounts as doubles, the first market code and the errors as text."""
    rank = next(i for i, f in enumerate(DISCOVERY_FEEDS) if f.name == name)
    feed = DISCOVERY_FEEDS[rank]
    rows = checked_records(feed, rank, feed.records(docs), F.lit(NOW).cast("timestamp"))
    shown = rows.select(*texts, *amounts, F.get("mics", F.lit(0)).alias("mic"), F.array_join("errors", ",").alias("errors"))
    return doubles(shown, *amounts)


def feed_page(name: str) -> str:
    return next(f.page for f in DISCOVERY_FEEDS if f.name == name)


def json_text_of(c: Column | str) -> Column:
    """A JSON string, or null."""
    column = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit('"'), column.cast("string"), F.lit('"')), F.lit("null"))


def json_object(**fields: Column) -> Column:
    """A JSON object of fields that are JSON text."""
    parts = [x for i, (name, value) in enumerate(fields.items()) for x in (F.lit(f'{"," if i else "{"}"{name}":'), value)]
    return F.concat(*parts, F.lit("}"))


def json_list(*values: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))


def stamp(stale: Column) -> Column:
    return F.when(stale, OLD).otherwise(FRESH)


# --- Xetra: parts. Sizes divisible by 10 have no ISIN, by 7 a malformed one, by 5 an old price.


@query(
    "feed_xetra",
    """
WITH r AS (
  SELECT p_partkey, p_name, p_size, p_retailprice, CASE WHEN p_size % 10 = 0 THEN NULL WHEN p_size % 7 = 0 THEN 'DE00'
         ELSE 'DE' || lpad((p_partkey % 700)::VARCHAR, 10, '0') END AS isin FROM part
), f AS (SELECT *, row_number() OVER (PARTITION BY coalesce(isin, '') ORDER BY p_partkey) AS n FROM r)
SELECT upper(p_name) AS name, 'W' || p_partkey AS symbol, isin, 'EUR' AS currency,
       CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS last_price,
       CASE WHEN p_size % 5 <> 0 THEN (p_retailprice * 100)::BIGINT * 1000 / 100.0 END AS market_cap,
       p_size / 100.0 AS performance_1_year, 'XETR' AS mic, CASE WHEN isin = 'DE00' THEN 'isin' ELSE '' END AS errors
FROM f WHERE n = 1
""",
)
def feed_xetra(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, price = F.col("p_size"), F.col("p_retailprice")
    number = F.lpad((F.col("p_partkey") % 700).cast("string"), 10, "0")
    isin = F.when(size % 10 != 0, F.when(size % 7 == 0, "DE00").otherwise(F.concat(F.lit("DE"), number)))
    # prices of even sizes are JSON numbers, the others text
    quoted = F.when(size % 2 == 0, price.cast("string")).otherwise(F.concat(F.lit('"'), price.cast("string"), F.lit('"')))
    cap = F.concat((price.cast("decimal(18,2)") * 1000).cast("string"))
    record = json_object(
        name=json_object(originalValue=json_text_of("p_name")),
        wkn=json_text_of(F.concat(F.lit("W"), "p_partkey")),
        isin=json_text_of(isin),
        overview=json_object(lastPrice=quoted, dateTimeLastPrice=json_text_of(stamp(size % 5 == 0))),
        performance=json_object(performance1Year=size.cast("string")),
        keyData=json_object(marketCapitalisation=json_text_of(cap)),
    )
    docs = documents(pages(table(spark, sf_dir, "part"), "p_partkey", record, ('"recordsTotal":1,"data":[', "]}")), feed_page("xetra"))
    return checked("xetra", [docs], ["name", "symbol", "isin", "currency"], ["last_price", "market_cap", "performance_1_year"])


# --- LSEG: customers. A segment in pence, one in a sub-unit that is rejected; balances below zero.


@query(
    "feed_lseg",
    """
WITH r AS (
  SELECT c_custkey, c_name, c_acctbal AS b, (c_acctbal * 100)::BIGINT AS cents, c_mktsegment = 'AUTOMOBILE' AS pence, c_mktsegment = 'BUILDING' AS sub,
         CASE WHEN c_nationkey <> 3 THEN 'GB' || lpad((c_custkey // 2)::VARCHAR, 10, '0') END AS isin FROM customer
), f AS (SELECT *, row_number() OVER (PARTITION BY isin ORDER BY c_custkey) AS n FROM r WHERE isin IS NOT NULL)
SELECT replace(upper(c_name), '#', ' ') AS name, 'T' || c_custkey AS symbol, isin, CASE WHEN pence THEN 'GBP' WHEN sub THEN 'GBP' ELSE 'USD' END AS currency,
       CASE WHEN pence THEN CASE WHEN b > 0 THEN cents / 10000.0 END WHEN b <> 0 THEN b END AS last_price, NULL::VARCHAR AS mic,
       concat_ws(',', CASE WHEN sub THEN 'currency' END, CASE WHEN b < 0 AND NOT pence THEN 'last_price' END) AS errors
FROM f WHERE n = 1
""",
)
def feed_lseg(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    code = F.when(segment == "AUTOMOBILE", "GBX").when(segment == "BUILDING", "GBp").otherwise("USD")
    number = F.lpad(F.floor(F.col("c_custkey") / 2).cast("string"), 10, "0")
    record = json_object(
        issuername=json_text_of("c_name"),
        tidm=json_text_of(F.concat(F.lit("T"), "c_custkey")),
        isin=json_text_of(F.when(F.col("c_nationkey") != 3, F.concat(F.lit("GB"), number))),
        currency=json_text_of(code),
        lastprice=F.col("c_acctbal").cast("string"),
    )
    wrap = ('"components":[{"type":"price-explorer","content":[{"name":"priceexplorersearch","value":{"totalPages":1,"content":[', "]}}]}]}")
    docs = documents(pages(table(spark, sf_dir, "customer"), "c_custkey", record, wrap), feed_page("lseg"))
    return checked("lseg", [docs], ["name", "symbol", "isin", "currency"], ["last_price"])


# --- Screener: suppliers. Text that is no number in a numeric column, negative amounts, two keys.


@query(
    "feed_screener",
    """
WITH r AS (
  SELECT s_suppkey, s_name, s_nationkey AS k, s_acctbal AS b, CASE WHEN s_suppkey % 2 = 0 THEN 'US' || lpad((s_suppkey // 4)::VARCHAR, 10, '0') END AS isin FROM supplier
), f AS (SELECT *, row_number() OVER (PARTITION BY coalesce(isin, 'S' || s_suppkey) ORDER BY s_suppkey) AS n FROM r)
SELECT replace(upper(s_name), '#', ' ') AS name, 'S' || s_suppkey AS symbol, isin, lpad(s_suppkey::VARCHAR, 9, '0') AS cusip, 'USD' AS currency,
       CASE WHEN k <> 5 THEN b END AS last_price, k * 15 / 1000.0 AS return_on_equity, b AS revenue, 'SECTOR ' || k AS sector, NULL::VARCHAR AS mic,
       CASE WHEN k = 5 OR b < 0 THEN 'last_price' ELSE '' END AS errors
FROM f WHERE n = 1
""",
)
def feed_screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, balance = F.col("s_nationkey"), F.col("s_acctbal").cast("string")
    number = F.lpad(F.floor(F.col("s_suppkey") / 4).cast("string"), 10, "0")
    record = json_object(
        s=json_text_of(F.concat(F.lit("S"), "s_suppkey")),
        n=json_text_of("s_name"),
        cusip=json_text_of(F.lpad(F.col("s_suppkey").cast("string"), 9, "0")),
        isin=json_text_of(F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("US"), number))),
        price=F.when(nation == 5, json_text_of(F.lit("n/a"))).when(nation % 2 == 0, balance).otherwise(json_text_of(balance)),
        roe=(nation.cast("decimal(9,1)") * F.lit(1.5).cast("decimal(2,1)")).cast("string"),
        revenue=balance,
        sector=json_text_of(F.concat(F.lit("sector-"), nation)),
    )
    docs = documents(pages(table(spark, sf_dir, "supplier"), "s_suppkey", record, ('"data":{"data":[', "]}}")), feed_page("screener"))
    return checked("screener", [docs], ["name", "symbol", "isin", "cusip", "currency", "sector"], ["last_price", "return_on_equity", "revenue"])


# --- Scanner: parts as positional rows. Old trade times, text in place of a number, repeated symbols.


@query(
    "feed_scanner",
    """
WITH r AS (SELECT *, 'P' || (p_partkey % 900) AS symbol FROM part),
f AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY p_partkey) AS n FROM r)
SELECT upper(p_name) AS name, symbol, 'USD' AS currency, replace(upper(p_brand), '#', ' ') AS sector,
       CASE WHEN p_size % 3 <> 0 AND p_size % 4 <> 0 THEN p_retailprice END AS last_price, p_size::DOUBLE AS shares_outstanding, p_size / 100.0 AS dividend_yield,
       -p_size::DOUBLE AS ebitda, NULL::VARCHAR AS mic, CASE WHEN p_size % 4 = 0 AND p_size % 3 <> 0 THEN 'last_price' ELSE '' END AS errors
FROM f WHERE n = 1
""",
)
def feed_scanner(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    symbol = F.concat(F.lit("P"), F.col("p_partkey") % 900)
    seconds = F.unix_timestamp(F.lit(NOW).cast("timestamp"))
    traded = F.when(size % 3 == 0, seconds - 20 * 86_400).otherwise(seconds - 3_600)
    cells = {
        0: json_text_of(symbol), 1: json_text_of("p_name"), 3: json_text_of(F.lit("USD")),
        4: F.when(size % 4 == 0, json_text_of(F.lit("unknown"))).otherwise(F.col("p_retailprice").cast("string")),
        7: size.cast("string"), 9: size.cast("string"), 11: (-size).cast("string"), 17: json_text_of("p_brand"), 19: traded.cast("string"),
    }
    record = json_object(s=json_text_of(symbol), d=json_list(*[cells.get(i, F.lit("null")) for i in range(20)]))
    docs = documents(pages(table(spark, sf_dir, "part"), "p_partkey", record, ('"totalCount":1,"data":[', "]}")), feed_page("scanner"))
    return checked("scanner", [docs], ["name", "symbol", "currency", "sector"], ["last_price", "shares_outstanding", "dividend_yield", "ebitda"])


# --- SEC: customers as rows of four cells, numbers and text.


@query(
    "feed_sec",
    """
WITH r AS (SELECT *, c_custkey // 3 + 1 AS cik FROM customer WHERE c_nationkey <> 4),
f AS (SELECT *, row_number() OVER (PARTITION BY cik ORDER BY c_custkey) AS n FROM r)
SELECT lpad(cik::VARCHAR, 10, '0') AS cik, replace(upper(c_name), '#', ' ') AS name, 'C' || c_custkey AS symbol,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'XNAS' WHEN 'BUILDING' THEN 'XNYS' WHEN 'MACHINERY' THEN 'XOTC' END AS mic, '' AS errors
FROM f WHERE n = 1
""",
)
def feed_sec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation 4 has no symbol, so its rows are no records."""
    segment = F.col("c_mktsegment")
    exchange = F.when(segment == "AUTOMOBILE", "Nasdaq").when(segment == "BUILDING", "NYSE").when(segment == "MACHINERY", "OTC").otherwise("Moon")
    symbol = F.when(F.col("c_nationkey") == 4, "").otherwise(F.concat(F.lit("C"), "c_custkey"))
    cik = (F.floor(F.col("c_custkey") / 3) + 1).cast("string")
    record = json_list(cik, json_text_of("c_name"), json_text_of(symbol), json_text_of(exchange))
    docs = documents(pages(table(spark, sf_dir, "customer"), "c_custkey", record, ('"data":[', "]}")), feed_page("sec"))
    return checked("sec", [docs], ["cik", "name", "symbol"], [])


# --- Intrinio: customers, a document of each one's orders, and a quote for every order with lines.


@query(
    "feed_intrinio",
    """
WITH q AS (SELECT l_orderkey, max(l_extendedprice) AS last, max(l_shipdate) < TIMESTAMP '1998-06-01' AS stale FROM lineitem GROUP BY 1)
SELECT replace(upper(c_name), '#', ' ') AS name, 'O' || o_orderkey AS symbol, 'BBG' || lpad(o_orderkey::VARCHAR, 9, '0') AS share_class_figi,
       'USD' AS currency, CASE WHEN NOT stale THEN last END AS last_price, CASE WHEN o_orderstatus = 'F' THEN 'XNYS' END AS mic, '' AS errors
FROM customer JOIN orders ON c_custkey = o_custkey LEFT JOIN q ON l_orderkey = o_orderkey
""",
)
def feed_intrinio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company to securities to quotes, joined by the feed's own code."""
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    figi = F.concat(F.lit("BBG"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0"))
    companies = json_object(ticker=json_text_of("c_custkey"), name=json_text_of("c_name"))
    security = json_object(
        ticker=json_text_of(F.concat(F.lit("O"), "o_orderkey")),
        share_class_figi=json_text_of(figi),
        currency=json_text_of(F.lit("USD")),
        exchange_mic=json_text_of(F.when(F.col("o_orderstatus") == "F", "XNYS")),
    )
    named = orders.join(customers.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    listed = named.groupBy("c_custkey", "c_name").agg(F.concat_ws(",", F.collect_list(security)).alias("securities"))
    company = json_object(
        company_ticker=json_text_of("c_custkey"),
        company=json_object(name=json_text_of("c_name")),
        securities=F.concat(F.lit("["), "securities", F.lit("]")),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("last"), F.max("l_shipdate").alias("shipped"))
    old = F.col("shipped") < F.lit("1998-06-01").cast("timestamp_ntz")
    quote = json_object(
        share_class_figi=json_text_of(F.concat(F.lit("BBG"), F.lpad(F.col("l_orderkey").cast("string"), 9, "0"))),
        quote=json_object(last=F.col("last").cast("string"), last_time=json_text_of(stamp(old))),
    )
    texts = (
        pages(customers, "c_custkey", companies, ('"companies":[', "]}")),
        listed.select(company.alias("doc")),
        lines.select(quote.alias("doc")),
    )
    feed = DISCOVERY_FEEDS[-1]
    docs = [documents(t, schema) for t, (_, schema) in zip(texts, feed.parts, strict=True)]
    return checked("intrinio", docs, ["name", "symbol", "share_class_figi", "currency"], ["last_price"])
