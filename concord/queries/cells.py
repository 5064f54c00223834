"""Text, number, code, time and validation rules over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.functions import codes, numbers, text, times
from concord.functions.fuzzy import candidate_score, symbol_score
from concord.functions.checked import Checked
from concord.operators.validate import (
    error_list,
    money_without_currency,
    required_error,
)
from concord.queries.base import amount, doubles, longs, query, table
from concord.sources.feeds import position
from concord.sources.landed import merge_maps_last_wins

# --- Text -------------------------------------------------------------------------------

# RE2 has no look-behind, so the SQL removes the dots run by run; it also needs the
# sharp s spelled out, which its upper() keeps.
UPPER_SQL = r"""upper(trim(regexp_replace(
  list_reduce(list_prepend({c}, regexp_extract_all({c}, '(?:[A-Za-z]\.){{2,}}')),
              lambda t, run: replace(t, run, replace(run, '.', ''))),
  '[^\p{{L}}\p{{N}}_]+', ' ', 'g')))"""


@query(
    "text_upper",
    f"""
SELECT doc_id, length(t)::BIGINT AS n_chars, md5(t) AS digest FROM (
  SELECT doc_id, {UPPER_SQL.format(c="replace(text, 'ß', 'SS')")} AS t FROM documents)
""",
)
def text_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    upper = text.upper_text(F.col("text"))
    docs = table(spark, sf_dir, "documents").select("doc_id", upper.alias("t"))
    return docs.select("doc_id", F.length("t").cast("bigint").alias("n_chars"), F.md5("t").alias("digest"))


@query(
    "symbol_norm",
    r"""
SELECT conv_id, turn, md5(upper(regexp_replace(regexp_replace(replace(text, 'ß', 'SS'), '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'))) AS digest
FROM conversations WHERE trim(text) <> ''
""",
)
def symbol_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    turns = turns.select("conv_id", "turn", text.symbol_text(F.col("text")).alias("t"))
    return turns.filter(F.col("t").isNotNull()).select("conv_id", "turn", F.md5("t").alias("digest"))


@query(
    "root_symbol",
    r"""
SELECT page_id, regexp_replace(split_part(upper(regexp_extract(url, '://([^/]+)', 1)), '.', 1), '^[0-9]+|[0-9]+$', '', 'g') AS root
FROM pages
""",
)
def root_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", "://([^/]+)", 1)
    return table(spark, sf_dir, "pages").select("page_id", text.root_symbol(host).alias("root"))


@query(
    "root_symbol_prefixed",
    r"""
SELECT s_suppkey, regexp_replace(split_part(upper(s_suppkey || 'Ab' || s_nationkey || '.l.' || s_nationkey), '.', 1), '^[0-9]+|[0-9]+$', '', 'g') AS root
FROM supplier
""",
)
def root_symbol_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("s_nationkey")
    symbol = F.concat(F.col("s_suppkey"), F.lit("Ab"), nation, F.lit(".l."), nation)
    return table(spark, sf_dir, "supplier").select("s_suppkey", text.root_symbol(symbol).alias("root"))


@query(
    "lookup_keys",
    """
SELECT c_custkey, c_mktsegment || '|' || CASE WHEN c_acctbal >= 3000 THEN 'ISIN' || c_custkey ELSE c_name END AS key
FROM customer
""",
)
def lookup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    isin = F.when(F.col("c_acctbal") >= 3000, F.concat(F.lit("ISIN"), "c_custkey")).when(F.col("c_acctbal") >= 0, "")
    key = text.lookup_key(F.col("c_mktsegment"), isin, F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key"))


def common_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence, row by row of the usual table."""
    cell = (
        f"CASE WHEN substring({a}, i::INT, 1) = substring({b}, j::INT, 1) THEN above[j] + 1 "
        f"ELSE greatest(above[j + 1], done[-1]) END"
    )
    row = f"list_reduce(range(1, length({b}) + 1), lambda done, j: list_append(done, {cell}), [0::BIGINT])"
    start = f"list_resize([0::BIGINT], length({b}) + 1, 0)"
    return f"list_reduce(range(1, length({a}) + 1), lambda above, i: {row}, {start})[-1]"


def ratio_sql(a: str, b: str) -> str:
    return f"200.0 * {common_sql(a, b)} / (length({a}) + length({b}))"


# Without their sign the names are single words of equal length, for which the weighted ratio is
# the plain one. Suppliers take turns, so every customer is scored.


@query(
    "candidate_score",
    f"""
WITH pairs AS (
  SELECT c_custkey, 'ab' || chr(97 + s_nationkey % 5) || chr((97 + s_suppkey % 7)::INT) AS symbol,
         'ab' || chr(97 + c_nationkey % 5) || chr((97 + c_custkey % 7)::INT) AS expected,
         lower(replace(s_name, '#', '')) AS name, lower(replace(c_name, '#', '')) AS expected_name
  FROM customer JOIN supplier ON s_suppkey = (c_custkey - 1) % (SELECT count(*) FROM supplier) + 1
),
scored AS (
  SELECT c_custkey, CASE WHEN symbol = expected THEN 100.0 ELSE {ratio_sql("symbol", "expected")} END AS by_symbol,
         {ratio_sql("name", "expected_name")} AS by_name FROM pairs
)
SELECT c_custkey, CASE WHEN by_symbol >= 70 AND by_name >= 70 THEN by_symbol + by_name ELSE 0 END::DOUBLE AS score FROM scored
""",
)
def candidate_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol and name scores of every customer against one of the suppliers."""
    suppliers = table(spark, sf_dir, "supplier")
    turn = (F.col("c_custkey") - 1) % suppliers.agg(F.count(F.lit(1))).scalar() + 1
    customers = table(spark, sf_dir, "customer").withColumn("turn", turn)
    joined = customers.join(suppliers, F.col("s_suppkey") == F.col("turn"))

    def ticker(nation: str, key: str) -> Column:
        return F.concat(F.lit("AB"), F.char(65 + F.col(nation) % 5), F.char(65 + F.col(key) % 7))

    score = candidate_score(
        ticker("s_nationkey", "s_suppkey"),
        F.concat(F.replace("s_name", F.lit("#"), F.lit("")), F.lit("! ")),
        ticker("c_nationkey", "c_custkey"),
        F.replace("c_name", F.lit("#"), F.lit("")),
    )
    return joined.select("c_custkey", score.alias("score"))


@query(
    "symbol_score_same_root",
    f"""
WITH s AS (
  SELECT s_suppkey, 'ticker' || chr(97 + s_nationkey % 3) AS root, 'ticker' || chr((97 + s_suppkey % 3)::INT) AS expected,
         'ticker' || chr(97 + s_nationkey % 3) || ' ' || s_nationkey % 10 AS listed, s_suppkey % 10 || 'ticker' || chr((97 + s_suppkey % 3)::INT) AS other FROM supplier
),
scored AS (SELECT s_suppkey, CASE WHEN root = expected THEN 100.0::DOUBLE ELSE {ratio_sql("listed", "other")} END AS score FROM s)
SELECT s_suppkey, CASE WHEN score >= 70 THEN score ELSE 0 END AS score FROM scored
""",
)
def symbol_score_same_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange variants of one ticker score full marks on their shared root, others their likeness."""
    nation, key = F.col("s_nationkey"), F.col("s_suppkey")
    listed = F.concat(F.lit("TICKER"), F.char(65 + nation % 3), F.lit("."), nation % 10)
    expected = F.concat(key % 10, F.lit("ticker"), F.char(97 + key % 3))
    return table(spark, sf_dir, "supplier").select("s_suppkey", symbol_score(listed, expected).alias("score"))


# --- Numbers ----------------------------------------------------------------------------------

K_SQL = "(props::JSON->>'k')"


def shaped_number() -> Column:
    """The events' number in five spellings, one per event type."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    return (
        F.when(kind == "click", F.concat(F.lit("+"), k))
        .when(kind == "view", F.concat(F.lit(" -"), k, F.lit(".50")))
        .when(kind == "error", F.concat(k, F.lit(",5")))
        .when(kind == "signup", F.concat(F.lit("  "), k, F.lit(".25 ")))
        .otherwise(F.concat(k, F.lit("e2")))
    )


@query(
    "numeric_text",
    f"""
SELECT event_id,
       CASE event_type WHEN 'click' THEN {K_SQL}::DOUBLE WHEN 'view' THEN -({K_SQL}::DOUBLE + 0.5)
                       WHEN 'signup' THEN {K_SQL}::DOUBLE + 0.25 END AS signed_value,
       CASE event_type WHEN 'click' THEN {K_SQL}::DOUBLE WHEN 'signup' THEN {K_SQL}::DOUBLE + 0.25 END AS unsigned_value,
       event_type = 'view' AS rejected,
       CASE event_type WHEN 'click' THEN {K_SQL}::DOUBLE WHEN 'view' THEN -({K_SQL}::DOUBLE + 0.5)
                       WHEN 'signup' THEN {K_SQL}::DOUBLE + 0.25 WHEN 'purchase' THEN {K_SQL}::DOUBLE * 100 END AS any_value
FROM events
""",
)
def numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    shaped = table(spark, sf_dir, "events").select("event_id", shaped_number().alias("t"))
    signed = numbers.plain_number(F.col("t"))
    checked = numbers.unsigned(signed)
    out = shaped.select(
        "event_id",
        signed.alias("signed_value"),
        checked.value.alias("unsigned_value"),
        checked.wrong.alias("rejected"),
        numbers.any_number(F.col("t")).alias("any_value"),
    )
    return doubles(out, "signed_value", "unsigned_value", "any_value")


@query(
    "json_numbers",
    f"""
SELECT event_id,
       CASE WHEN event_type IN ('click', 'view') THEN {K_SQL}::DOUBLE WHEN event_type = 'error' THEN {K_SQL}::DOUBLE * 1e3 END AS value,
       event_type = 'signup' AS rejected
FROM events
""",
)
def json_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON numbers in any notation, JSON text only in plain form, other text rejects."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    literal = (
        F.when(kind == "click", k)
        .when(kind == "view", F.concat(F.lit('"'), k, F.lit('"')))
        .when(kind == "error", F.concat(k, F.lit("e3")))
        .when(kind == "signup", F.concat(F.lit('"'), k, F.lit(' units"')))
        .otherwise(F.lit("null"))
    )
    rows = table(spark, sf_dir, "events").select("event_id", F.parse_json(literal).alias("v"))
    out = rows.select(
        "event_id",
        numbers.json_number(F.col("v")).alias("value"),
        numbers.json_typed_number(F.col("v")).wrong.alias("rejected"),
    )
    return doubles(out, "value")


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "pence_to_pounds",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       CASE l_returnflag WHEN 'R' THEN l_extendedprice ELSE round(l_extendedprice / 100, 4) END AS price,
       CASE l_returnflag WHEN 'R' THEN 'GBP' ELSE 'GBP' END AS currency
FROM lineitem
""",
)
def pence_to_pounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices quoted in pence, half of them with a decimal comma."""
    flag = F.col("l_returnflag")
    plain = amount("l_extendedprice").cast("string")
    quoted = F.when(flag == "N", F.translate(plain, ".", ",")).otherwise(plain)
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_returnflag", quoted.alias("quoted"))
    pounds = numbers.pounds(numbers.pence_number(F.col("quoted")))
    out = lines.select(
        *LINE_KEY,
        F.when(flag != "R", pounds).otherwise(numbers.plain_number(F.col("quoted"))).alias("price"),
        F.lit("GBP").alias("currency"),
    )
    return doubles(out, "price")


@query(
    "zero_as_null",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       nullif(l_tax, 0) AS tax, nullif(l_discount, 0) AS discount FROM lineitem
""",
)
def zero_as_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        *LINE_KEY,
        numbers.zero_missing(F.col("l_tax")).alias("tax"),
        numbers.zero_missing(F.col("l_discount")).alias("discount"),
    )


@query(
    "percent_ratio",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, round(l_extendedprice / 100, 4) AS ratio FROM lineitem
""",
)
def percent_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = numbers.percent_ratio(amount("l_extendedprice"))
    return doubles(table(spark, sf_dir, "lineitem").select(*LINE_KEY, ratio.alias("ratio")), "ratio")


# --- Codes -------------------------------------------------------------------------------------


@query(
    "id_formats",
    """
WITH c AS (
  SELECT c_custkey, lpad(c_custkey::VARCHAR, 8, '0') AS k, c_nationkey AS n, c_custkey::VARCHAR AS t FROM customer
)
SELECT c_custkey,
       CASE WHEN n <> 3 THEN 'US0' || k || '4' END AS isin, n = 3 AS isin_wrong,
       CASE WHEN n <> 4 THEN 'Q' || k END AS cusip, n = 4 AS cusip_wrong,
       CASE WHEN n <> 5 THEN lpad(t, 10, '0') END AS cik, n = 5 AS cik_wrong,
       CASE WHEN n <> 6 THEN 'LEI0000000' || k || '99' END AS lei, n = 6 AS lei_wrong,
       CASE WHEN n <> 7 THEN 'BBG0' || k END AS figi, n = 7 AS figi_wrong,
       CASE WHEN n < 10 THEN 'X00' || n END AS mic, n >= 10 AS mic_wrong
FROM c
""",
)
def id_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes built from the customer number; one nation per code spells it wrongly."""
    key = F.col("c_custkey").cast("string")
    k, n = F.lpad(key, 8, "0"), F.col("c_nationkey")

    def spelled(bad: int, good: Column, wrong: Column) -> Column:
        return F.when(n == bad, wrong).otherwise(good)

    checks = {
        "isin": codes.isin(spelled(3, F.concat(F.lit(" us0"), k, F.lit("4 ")), F.concat(F.lit("US0"), k, F.lit("X")))),
        "cusip": codes.cusip(spelled(4, F.concat(F.lit("q"), k), F.concat(F.lit("Q"), k, F.lit("12")))),
        "cik": codes.cik(spelled(5, key, F.concat(F.lit("C"), key))),
        "lei": codes.lei(spelled(6, F.concat(F.lit("lei0000000"), k, F.lit("99")), F.concat(F.lit("LEI0000000"), k, F.lit("9X")))),
        "figi": codes.figi(spelled(7, F.concat(F.lit("bbg0"), k), F.concat(F.lit("BBG"), k))),
        "mic": codes.mic(F.concat(F.lit("x00"), n)),
    }
    columns = [c for f, v in checks.items() for c in (v.value.alias(f), v.wrong.alias(f"{f}_wrong"))]
    return table(spark, sf_dir, "customer").select("c_custkey", *columns)


@query(
    "mic_lists",
    """
SELECT n_nationkey, CASE WHEN n_regionkey = 2 OR n_regionkey = 1 THEN NULL
            ELSE 'XN' || lpad(n_nationkey::VARCHAR, 2, '0') || ',-,XR0' || n_regionkey END AS mics,
       n_regionkey = 1 AS wrong
FROM nation
""",
)
def mic_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Venue lists: empty for region 2, a malformed element for region 1."""
    nation, region = F.col("n_nationkey"), F.col("n_regionkey")
    first = F.concat(F.lit("xn"), F.lpad(nation.cast("string"), 2, "0"))
    last = F.when(region == 1, F.lit("TOO LONG")).otherwise(F.concat(F.lit("XR0"), region))
    venues = F.when(region == 2, F.array().cast("array<string>")).otherwise(F.array(first, F.lit(" "), last))
    checked = codes.mic_list(venues)
    joined = F.array_join(checked.value, ",", "-")
    return table(spark, sf_dir, "nation").select("n_nationkey", joined.alias("mics"), checked.wrong.alias("wrong"))


@query(
    "currency_check",
    """
SELECT c_custkey, CASE WHEN n BETWEEN 5 AND 20 THEN 'ZA' || chr(65 + n) END AS currency,
       n < 5 OR n IN (21, 22) AS wrong
FROM (SELECT c_custkey, c_nationkey AS n FROM customer)
""",
)
def currency_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations 0-4 quote in a sub-unit (mixed case), 21-22 spell a digit, 23-24 none."""
    n = F.col("c_nationkey")
    raw = (
        F.when(n < 5, F.concat(F.lit("ZA"), F.char(97 + n)))
        .when(n <= 20, F.concat(F.lit(" za"), F.char(97 + n)))
        .when(n <= 22, F.lit("U2D"))
        .otherwise(F.lit("  "))
    )
    checked = codes.currency(raw)
    return table(spark, sf_dir, "customer").select("c_custkey", checked.value.alias("currency"), checked.wrong.alias("wrong"))


@query(
    "date_check",
    """
SELECT o_orderkey,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN strftime(o_orderdate, '%Y-%m-%d') END AS day,
       o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '5-LOW') AS wrong
FROM orders
""",
)
def date_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashed dates pass; compact and impossible ones reject; blank ones are null."""
    day, urgency = F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1)
    raw = (
        F.when(urgency <= "2", F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .when(urgency == "3", F.date_format(day, "yyyyMMdd"))
        .when(urgency == "4", F.concat(F.date_format(day, "yyyy"), F.lit("-13-"), F.date_format(day, "dd")))
        .otherwise(F.lit(" "))
    )
    checked = codes.snapshot_date(raw)
    shown = F.date_format(checked.value, "yyyy-MM-dd")
    return table(spark, sf_dir, "orders").select("o_orderkey", shown.alias("day"), checked.wrong.alias("wrong"))


@query(
    "rating_map",
    """
SELECT event_id, CASE event_type WHEN 'click' THEN 'BUY' WHEN 'view' THEN 'SELL' WHEN 'error' THEN 'HOLD' END AS rating
FROM events
""",
)
def rating_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    raw = (
        F.when(kind == "click", "strong_buy")
        .when(kind == "view", " Sell ")
        .when(kind == "error", "hold.")
        .otherwise(kind)
    )
    return table(spark, sf_dir, "events").select("event_id", codes.analyst_rating(raw).alias("rating"))


# --- Times --------------------------------------------------------------------------------------


def event_time_text(ts: Column, kind: Column) -> Column:
    """The event time with offset, as UTC, without offset, compact or broken."""
    plus = F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    utc = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        F.when(kind == "click", F.concat(plus, F.lit("+02:00")))
        .when(kind == "view", F.concat(utc, F.lit("Z")))
        .when(kind == "error", utc)
        .when(kind == "signup", F.date_format(ts, "yyyy-MM-dd"))
        .otherwise(F.concat(F.lit("at "), utc))
    )


@query(
    "parse_time",
    """
SELECT event_id,
       CASE event_type WHEN 'signup' THEN epoch_us(date_trunc('day', ts)) WHEN 'purchase' THEN NULL ELSE epoch_us(ts) END AS iso_us,
       CASE event_type WHEN 'purchase' THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS unix_us
FROM events
""",
)
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, kind = F.col("ts").cast("timestamp"), F.col("event_type")
    seconds = F.when(kind == "purchase", "soon").otherwise(F.unix_seconds(ts).cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(times.iso_time(event_time_text(F.col("ts"), kind))).alias("iso_us"),
        F.unix_micros(times.unix_time(seconds)).alias("unix_us"),
    )


@query(
    "parse_time_odd",
    """
SELECT event_id,
       CASE event_id % 5 WHEN 4 THEN NULL WHEN 3 THEN epoch_us(date_trunc('minute', ts)) - 7200000000
            WHEN 2 THEN epoch_us(date_trunc('hour', ts)) WHEN 1 THEN epoch_us(date_trunc('second', ts)) + 500000
            ELSE epoch_us(date_trunc('second', ts)) END AS iso_us,
       CASE WHEN event_id % 3 > 0 THEN NULL ELSE epoch_us(date_trunc('second', ts)) END AS unix_us
FROM events
""",
)
def parse_time_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact forms, a decimal comma, short times with an offset, and times beyond the calendar."""
    ts = F.col("ts").cast("timestamp")
    form = F.pmod("event_id", F.lit(5))
    text = (
        F.when(form == 0, F.date_format(ts, "yyyyMMdd'T'HHmmss'Z'"))
        .when(form == 1, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss',5'"))
        .when(form == 2, F.date_format(ts, "yyyy-MM-dd HH"))
        .when(form == 3, F.date_format(ts, "yyyyMMdd'T'HHmm'+0200'"))
        .otherwise(F.date_format(ts, "yyyy-13-dd"))
    )
    beyond = F.when(F.pmod("event_id", F.lit(3)) == 1, "99999999999999").when(
        F.pmod("event_id", F.lit(3)) == 2, "-99999999999999"
    )
    seconds = F.coalesce(beyond, F.unix_seconds(ts).cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(times.iso_time(text)).alias("iso_us"), F.unix_micros(times.unix_time(seconds)).alias("unix_us")
    )


@query(
    "stale_nullify",
    """
SELECT event_id, CASE WHEN event_type = 'error' OR ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 36 HOURS THEN value END AS last_price,
       value AS dividend_yield
FROM events
""",
)
def stale_nullify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late quotes lose their price and keep their row; unknown times are not late."""
    now = F.lit("2024-01-30 12:00:00").cast("timestamp")
    traded = F.when(F.col("event_type") != "error", F.col("ts").cast("timestamp"))
    fields = {"last_price": F.col("value"), "dividend_yield": F.col("value")}
    kept = times.unless_stale(fields, times.is_stale(traded, now))
    return table(spark, sf_dir, "events").select("event_id", *[c.alias(f) for f, c in kept.items()])


# --- Shapes of landed records -----------------------------------------------------------------------


@query(
    "positional_fields",
    f"""
SELECT event_id, event_type AS symbol, {K_SQL}::DOUBLE AS price, CASE WHEN event_type = 'click' THEN user_id::VARCHAR END AS venue
FROM events WHERE event_type <> 'error'
""",
)
def positional_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as positional arrays: too short ones drop out, absent positions are null."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    short = F.array(kind)
    middle = F.array(kind, k)
    full = F.array(kind, k, F.col("user_id").cast("string"))
    row = F.when(kind == "error", short).when(kind == "click", full).otherwise(middle)
    rows = table(spark, sf_dir, "events").select("event_id", row.alias("d")).filter(F.size("d") >= 2)
    return rows.select(
        "event_id",
        position(F.col("d"), 0).alias("symbol"),
        numbers.plain_number(position(F.col("d"), 1)).cast("double").alias("price"),
        position(F.col("d"), 2).alias("venue"),
    )


@query("json_fields", f"SELECT event_id, {K_SQL}::DOUBLE AS k FROM events")
def json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.from_json("props", "k double")
    return table(spark, sf_dir, "events").select("event_id", doc["k"].alias("k"))


@query(
    "module_flatten",
    f"""
SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE event_type END AS name,
       CASE WHEN event_type = 'view' THEN {K_SQL} ELSE value::VARCHAR END AS price
FROM events
""",
)
def module_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quote modules merged into one map: a later module wins, even with a null."""
    k, kind = F.get_json_object("props", "$.k"), F.col("event_type")
    first = F.create_map(F.lit("name"), kind, F.lit("price"), F.col("value").cast("string"))
    null = F.lit(None).cast("string")
    second = F.when(kind == "click", F.create_map(F.lit("name"), null)).when(
        kind == "view", F.create_map(F.lit("price"), k)
    )
    flat = merge_maps_last_wins(F.array(first, second))
    rows = table(spark, sf_dir, "events").select("event_id", flat.alias("q"))
    return rows.select("event_id", F.col("q")["name"].alias("name"), F.col("q")["price"].alias("price"))


# --- Row validation -------------------------------------------------------------------------------------


def faulty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with faults by nation: 1 has no name, 2 owes money in no currency,
    3 a malformed id; a negative balance is a fault of its own."""
    nation = F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(nation == 1, " ").otherwise(F.col("c_name")).alias("name"),
        F.when(nation != 2, "EUR").alias("currency"),
        F.when(nation == 3, "?").otherwise(F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("cusip"),
        amount("c_acctbal").alias("market_cap"),
    )
    name, cap = text.upper_text(F.col("name")), numbers.unsigned(F.col("market_cap"))
    currency, cusip = codes.currency(F.col("currency")), codes.cusip(F.col("cusip"))
    unpaired = money_without_currency(currency.value, [cap.value])
    errors = error_list(
        {
            "name": required_error(name),
            "currency": currency.wrong | unpaired,
            "cusip": cusip.wrong | required_error(cusip.value),
            "market_cap": cap.wrong,
        }
    )
    return rows.select("c_custkey", errors.alias("errors"))


FAULTS_SQL = """
WITH f AS (
  SELECT c_custkey, c_nationkey = 1 AS a, c_nationkey = 2 AND c_acctbal >= 0 AS b, c_nationkey = 3 AS c, c_acctbal < 0 AS d
  FROM customer
)
"""


@query(
    "validate_split",
    FAULTS_SQL
    + """
SELECT c_custkey, NOT (a OR b OR c OR d) AS accepted,
       concat_ws(',', CASE WHEN a THEN 'name' END, CASE WHEN b THEN 'currency' END,
                 CASE WHEN c THEN 'cusip' END, CASE WHEN d THEN 'market_cap' END) AS errors FROM f
""",
)
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = faulty_customers(spark, sf_dir)
    return rows.select(
        "c_custkey", (F.size("errors") == 0).alias("accepted"), F.array_join("errors", ",").alias("errors")
    )


@query(
    "validate_counts",
    FAULTS_SQL
    + """
SELECT count(*) FILTER (NOT (a OR b OR c OR d)) AS accepted, count(*) FILTER (a OR b OR c OR d) AS rejected,
       count(*) FILTER (a) AS name, count(*) FILTER (b) AS currency, count(*) FILTER (c) AS cusip, count(*) FILTER (d) AS market_cap
FROM f
""",
)
def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage counters of the split, in one pass."""
    ok = F.size("errors") == 0
    fields = ("name", "currency", "cusip", "market_cap")
    return faulty_customers(spark, sf_dir).agg(
        F.count_if(ok).alias("accepted"),
        F.count_if(~ok).alias("rejected"),
        *[F.count_if(F.array_contains("errors", f)).alias(f) for f in fields],
    )
