"""Deduplication, unions, lookups, candidate search and gates over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import dedup, enrich
from concord.queries.base import amount, doubles, query, table
from concord.queries.cells import ratio_sql
from concord.sources import gates
from concord.sources.feeds import exchange_mics

# --- First and last per key ------------------------------------------------------------------


@query(
    "last_wins",
    """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1
""",
)
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts", "event_id")
    return dedup.last_per_key(events, F.col("user_id"), ["ts", "event_id"]).select("user_id", "event_type", "value")


@query(
    "first_seen",
    """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r FROM events) WHERE r = 1
""",
)
def first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "value", "ts", "event_id")
    return dedup.first_per_key(events, F.col("user_id"), ["ts", "event_id"]).select("user_id", "event_type", "value")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a key that most of them lack: source and quality of the label."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    joined = docs.join(labels, "doc_id", "left")
    key = F.when(F.col("toxic") == 1, "").otherwise(F.concat_ws("-", F.col("source"), F.col("quality").cast("string")))
    return joined.select("doc_id", F.when(F.col("toxic").isNotNull(), key).alias("key"))


LABELLED_SQL = """
WITH k AS (
  SELECT doc_id, CASE WHEN toxic = 1 THEN '' WHEN toxic IS NOT NULL THEN concat_ws('-', source, quality) END AS key
  FROM documents LEFT JOIN labels USING (doc_id)
)
"""


@query(
    "first_seen_blank_key",
    LABELLED_SQL + "SELECT coalesce(key, '') AS key, min(doc_id) AS doc_id FROM k GROUP BY 1",
)
def first_seen_blank_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows without a key share one survivor."""
    kept = dedup.first_per_key_or_blank(labelled(spark, sf_dir), F.col("key"), ["doc_id"])
    return kept.select(F.coalesce("key", F.lit("")).alias("key"), "doc_id")


@query(
    "first_seen_present_key",
    LABELLED_SQL + "SELECT key, min(doc_id) AS doc_id FROM k WHERE key <> '' GROUP BY 1",
)
def first_seen_present_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup.first_per_present_key(labelled(spark, sf_dir), F.col("key"), ["doc_id"])
    return kept.select("key", "doc_id")


@query(
    "first_seen_or_alt_key",
    LABELLED_SQL + "SELECT min(doc_id) AS doc_id FROM k GROUP BY coalesce(nullif(key, ''), 'doc ' || doc_id)",
)
def first_seen_or_alt_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = dedup.key_or_alternative(F.col("key"), F.concat(F.lit("doc "), "doc_id"))
    return dedup.first_per_key(labelled(spark, sf_dir), key, ["doc_id"]).select("doc_id")


# --- Unions ----------------------------------------------------------------------------------------


def tagged_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables as ranked feeds of one union."""
    sources = (("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"), ("part", "p_partkey", "p_name"))
    frames = [
        table(spark, sf_dir, t).select(
            F.lit(t).alias("feed"), F.lit(rank).alias("feed_rank"), F.col(k).alias("row_no"), F.col(n).alias("name")
        )
        for rank, (t, k, n) in enumerate(sources)
    ]
    return enrich.append_rows(*frames)


@query(
    "feed_union",
    """
SELECT 'customer' AS feed, 0 AS feed_rank, c_custkey AS row_no, c_name AS name FROM customer
UNION ALL SELECT 'supplier', 1, s_suppkey, s_name FROM supplier
UNION ALL SELECT 'part', 2, p_partkey, p_name FROM part
""",
)
def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_feeds(spark, sf_dir)


@query(
    "feed_liveness",
    """
SELECT feed, n FROM (
  SELECT 'customer' AS feed, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
  UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'broker', 0)
""",
)
def feed_liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per registered feed; a registered feed that sent nothing shows zero."""
    registry = spark.createDataFrame([(f,) for f in ("customer", "supplier", "part", "broker")], "feed string")
    return gates.feed_counts(tagged_feeds(spark, sf_dir), registry)


@query(
    "append_enrichment",
    """
SELECT key, count(*) AS sources, min(feed) AS first_feed, max(price)::DOUBLE AS price FROM (
  SELECT 'P' || p_partkey AS key, 'catalogue' AS feed, p_retailprice AS price FROM part
  UNION ALL SELECT 'P' || l_partkey, 'quotes', max(l_extendedprice) FROM lineitem GROUP BY l_partkey)
GROUP BY key
""",
)
def append_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment rows without an id take the id of the group that asked for them."""
    catalogue = table(spark, sf_dir, "part").select(
        F.concat(F.lit("P"), "p_partkey").alias("share_class_figi"),
        F.lit("catalogue").alias("feed"),
        amount("p_retailprice").alias("price"),
    )
    quotes = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.max(amount("l_extendedprice")).alias("price"))
        .select(F.lit(None).cast("string").alias("share_class_figi"), F.lit("quotes").alias("feed"), "price", "l_partkey")
    )
    injected = enrich.inject_key(quotes, F.concat(F.lit("P"), "l_partkey")).drop("l_partkey")
    rows = enrich.append_rows(catalogue, injected)
    merged = rows.groupBy(F.col("share_class_figi").alias("key")).agg(
        F.count(F.lit(1)).alias("sources"), F.min("feed").alias("first_feed"), F.max("price").alias("price")
    )
    return doubles(merged, "price")


# --- Lookups -----------------------------------------------------------------------------------------------


@query(
    "key_lookup_upper",
    """
SELECT c_custkey, 'LEI' || n_regionkey AS lei FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey <> 5
""",
)
def key_lookup_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys are upper-cased before the lookup; rows without a hit drop out."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("nation_"), "c_nationkey").alias("isin")
    )
    nations = table(spark, sf_dir, "nation").filter(F.col("n_nationkey") != 5)
    index = nations.select(F.col("n_name").alias("key"), F.concat(F.lit("LEI"), "n_regionkey").alias("lei"))
    return enrich.attach_by_key(customers, "isin", index, "key").select("c_custkey", "lei")


@query(
    "company_security_quote",
    """
WITH quotes AS (
  SELECT l_orderkey, first(l_extendedprice ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS last
  FROM lineitem GROUP BY l_orderkey
)
SELECT c_name AS company, o_orderkey AS security, last
FROM customer JOIN orders ON c_custkey = o_custkey LEFT JOIN quotes ON l_orderkey = o_orderkey
""",
)
def company_security_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Company to securities to quotes; a security without a quote keeps a null one."""
    companies = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("company"))
    securities = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").alias("security"))
    lines = table(spark, sf_dir, "lineitem")
    first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    quotes = lines.groupBy("l_orderkey").agg(first["l_extendedprice"].alias("last"))
    joined = companies.join(securities, F.col("c_custkey") == F.col("o_custkey"))
    return joined.join(quotes, F.col("security") == F.col("l_orderkey"), "left").select("company", "security", "last")


# --- Candidate search ----------------------------------------------------------------------------------------

# Each customer searches for its orders: by ISIN (balance from 5000) among urgent orders, by CUSIP
# (from 2000) among the rest, by name among finished ones, by symbol among all of them. Names are
# single words of nearly one length, for which the weighted ratio is the plain one.

LETTERS = ("0123456789", "ABCDEFGHIJ")


def ticker(key: str) -> Column:
    """A symbol of letters only, told apart by the number."""
    return F.concat(F.lit("LISTED"), F.translate(F.col(key).cast("string"), *LETTERS))


def padded(word: str, number: Column) -> Column:
    return F.concat(F.lit(word), F.lpad(number.cast("string"), 9, "0"))


def searching_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, balance = F.col("c_custkey"), F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        key.alias("share_class_figi"),
        ticker("c_custkey").alias("symbol"),
        F.replace("c_name", F.lit("#"), F.lit("")).alias("name"),
        F.when(balance >= 5000, F.concat(F.lit("I"), key)).alias("isin"),
        F.when(balance >= 2000, F.concat(F.lit("C"), key)).alias("cusip"),
    )


def order_symbol() -> Column:
    """The customer's ticker at a venue of the order's own; every third has a letter more, so another root."""
    order = F.col("o_orderkey")
    return F.concat(ticker("o_custkey"), F.when(order % 3 == 1, "Q").otherwise(""), F.lit("."), order)


def order_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed search results: an order answers one of its customer's identifiers, its name and its symbol."""
    key, order, priority = F.col("o_custkey"), F.col("o_orderkey"), F.col("o_orderpriority")
    identifier = F.when(priority.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("I"), key)).otherwise(F.concat(F.lit("C"), key))
    named = F.when(F.col("o_orderstatus") == "F", padded("Customer", key))
    answered = F.array_compact(F.array(identifier, named, ticker("o_custkey")))
    other = F.when(order % 5 == 0, F.reverse(padded("Customer", key))).otherwise(padded("Customer", key + order % 7 * 1111))
    return table(spark, sf_dir, "orders").select(
        F.explode(answered).alias("term"),
        order.alias("pos"),
        order_symbol().alias("candidate"),
        F.when(priority != "3-MEDIUM", other).alias("longname"),
        padded("Custom", key).alias("shortname"),
        F.when(priority == "5-LOW", "ETF").otherwise("EQUITY").alias("quote_type"),
    )


CASCADE_SQL = f"""
WITH cust AS (
  SELECT c_custkey AS k, 'LISTED' || translate(c_custkey::VARCHAR, '{LETTERS[0]}', '{LETTERS[1]}') AS symbol,
         replace(c_name, '#', '') AS name, c_acctbal >= 5000 AS has_isin, c_acctbal >= 2000 AS has_cusip FROM customer
),
ord AS (
  SELECT k, o_orderkey AS pos, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent, o_orderstatus = 'F' AS named, has_isin, has_cusip,
         lower(symbol) AS symbol, lower(name) AS name, o_orderkey % 3 <> 1 AS same_root, lower(symbol) || 'q ' || o_orderkey AS found,
         lower(CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL WHEN o_orderkey % 5 = 0 THEN reverse(name)
                    ELSE 'Customer' || lpad((k + o_orderkey % 7 * 1111)::VARCHAR, 9, '0') END) AS longname,
         'custom' || lpad(k::VARCHAR, 9, '0') AS shortname
  FROM cust JOIN orders ON o_custkey = k WHERE o_orderpriority <> '5-LOW'
),
by_symbol AS (
  SELECT *, CASE WHEN same_root THEN 100.0::DOUBLE ELSE {ratio_sql("found", "symbol")} END AS s FROM ord
),
by_name AS (
  SELECT *, 0 AS pass, CASE WHEN longname = name THEN 100.0::DOUBLE ELSE {ratio_sql("longname", "name")} END AS n FROM by_symbol WHERE longname IS NOT NULL
  UNION ALL SELECT *, 1, {ratio_sql("shortname", "name")} FROM by_symbol
),
scored AS (SELECT *, CASE WHEN s >= 70 AND n >= 70 THEN s + n ELSE 0 END AS score FROM by_name),
levels AS (
  SELECT *, unnest([CASE WHEN has_isin AND urgent THEN 1 WHEN has_cusip AND NOT urgent THEN 2 END, CASE WHEN named THEN 3 END, 4]) AS level
  FROM scored
),
counted AS (
  SELECT *, count(DISTINCT pos) OVER (PARTITION BY k, level) AS hits FROM levels WHERE level IS NOT NULL
),
accepted AS (
  SELECT * FROM counted WHERE score >= CASE WHEN level <= 2 AND hits = 1 THEN 120 ELSE 160 END
),
best AS (
  SELECT *, min(level * 10 + pass) OVER (PARTITION BY k) AS first_step FROM accepted
),
ranked AS (
  SELECT k, level, pos, score, row_number() OVER (PARTITION BY k ORDER BY score DESC, pos) AS rank
  FROM best WHERE level * 10 + pass = first_step
)
"""


@query(
    "rank_candidates",
    CASCADE_SQL
    + "SELECT k AS customer, level, pos AS order_key, score, rank::BIGINT AS rank FROM ranked",
)
def rank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted candidates of the first level that has any, by symbol and name."""
    keyed = enrich.with_lookup(searching_customers(spark, sf_dir))
    ranked = enrich.rank_candidates(enrich.search_hits(keyed, order_search(spark, sf_dir)))
    back = ranked.join(keyed.select("lookup", "share_class_figi"), "lookup")
    return back.select(
        F.col("share_class_figi").alias("customer"),
        "level",
        F.substring_index("candidate", ".", -1).cast("bigint").alias("order_key"),
        "score",
        F.col("rank").cast("bigint").alias("rank"),
    )


@query(
    "candidate_cascade",
    CASCADE_SQL
    + """
SELECT k AS customer, arg_min(pos, rank) AS order_key FROM ranked JOIN orders ON o_orderkey = pos
WHERE o_orderstatus <> 'P' GROUP BY k
""",
)
def candidate_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First valid quote of the accepted level; later levels are not reconsidered."""
    quotes = table(spark, sf_dir, "orders").select(
        order_symbol().alias("quote_symbol"),
        F.when(F.col("o_orderstatus") == "P", "ETF").otherwise("EQUITY").alias("quote_type"),
        F.col("o_orderpriority").alias("long_name"),
        F.lit(None).cast("string").alias("short_name"),
        "o_orderkey",
    )
    found = enrich.find_quotes(searching_customers(spark, sf_dir), order_search(spark, sf_dir), quotes)
    return found.select(F.col("share_class_figi").alias("customer"), F.col("o_orderkey").alias("order_key"))


# --- Gates and codes -------------------------------------------------------------------------------------------


@query(
    "page_gate",
    """
SELECT l_orderkey, count(DISTINCT l_linenumber) AS pages, max(l_linenumber)::BIGINT AS total_pages,
       count(DISTINCT l_linenumber) >= max(l_linenumber) AS complete
FROM lineitem GROUP BY l_orderkey
""",
)
def page_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as feeds, line numbers as pages: complete when none is missing."""
    return gates.page_status(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", "l_linenumber")


@query(
    "page_gate_rows",
    """
SELECT o_custkey, count(DISTINCT o_orderdate) AS pages, greatest(ceil(max(o_totalprice) / 50000), 1)::BIGINT AS total_pages,
       count(DISTINCT o_orderdate) >= greatest(ceil(max(o_totalprice) / 50000), 1) AS complete
FROM orders GROUP BY o_custkey
""",
)
def page_gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same gate for a feed that announces rows instead of pages."""
    pages = gates.pages_for_rows(F.col("o_totalprice"), 50000)
    return gates.page_status(table(spark, sf_dir, "orders"), ["o_custkey"], "o_orderdate", pages)


@query(
    "pages_before_gap",
    """
WITH p AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
run AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS place FROM p)
SELECT l_orderkey, count(*) AS n FROM lineitem SEMI JOIN (SELECT * FROM run WHERE place = l_linenumber) r
  ON lineitem.l_orderkey = r.l_orderkey AND lineitem.l_linenumber = r.l_linenumber
GROUP BY l_orderkey
""",
)
def pages_before_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the unbroken run of pages; what follows a missing page is ignored."""
    kept = gates.before_gap(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber", first=1)
    return kept.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query(
    "exchange_codes",
    """
SELECT event_id, CASE event_type WHEN 'click' THEN 'XNAS' WHEN 'view' THEN 'XNYS' ELSE '' END AS mics FROM events
""",
)
def exchange_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    exchange = F.when(kind == "click", "Nasdaq").when(kind == "view", "NYSE").otherwise("Elsewhere")
    return table(spark, sf_dir, "events").select("event_id", F.array_join(exchange_mics(exchange), ",").alias("mics"))
