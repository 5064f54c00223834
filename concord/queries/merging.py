"""Voting, merging, conversion and identification over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.operators import golden, ranks, votes, wide
from concord.operators.fx import to_usd, without_rate
from concord.operators.golden import FUZZY, MODE, PAIR, SINGLE, TIGHT_PAIR, UNION, PriceRange
from concord.operators.identify import identify, query_key, responses_to_lookup
from concord.queries.base import (
    FX_SQL,
    amount,
    doubles,
    nation_currency,
    nation_rates,
    query,
    table,
    usd_sql,
)
from concord.session import stage

# --- Golden record per part ----------------------------------------------------------

GOLDEN_RULES = {
    "name": MODE,
    "symbol": MODE,
    "mics": UNION,
    "currency": MODE,
    "last_price": TIGHT_PAIR,
    "fifty_two_week_min": TIGHT_PAIR,
    "fifty_two_week_max": TIGHT_PAIR,
    "market_cap": TIGHT_PAIR,
    "market_volume": PAIR,
    "analyst_rating": MODE,
}
GOLDEN_RANGE = PriceRange("last_price", "fifty_two_week_min", "fifty_two_week_max")
GOLDEN_NUMBERS = ("last_price", "fifty_two_week_min", "fifty_two_week_max", "market_cap", "market_volume")


def part_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price report per part and supplier, in the supplier's currency.

    Line items are reduced to reports before anything is joined to them.
    """
    price, units = cents("l_extendedprice"), cents("l_quantity")
    reports = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            newest("l_shipdate", price).alias("last_price"),
            F.min(price).alias("fifty_two_week_min"),
            F.max(price).alias("fifty_two_week_max"),
            F.sum(price).alias("market_cap"),
            F.sum(units).alias("market_volume"),
            F.max(F.ascii("l_returnflag")).alias("flag"),
        )
        .withColumns({f: from_cents(f) for f in GOLDEN_NUMBERS})
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    located = reports.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    nation = F.col("s_nationkey")
    return located.select(
        F.col("l_partkey").alias("part"),
        F.lit(1).alias("feed_rank"),
        F.col("l_suppkey").alias("row_no"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("symbol"),
        F.array(F.concat(F.lit("M"), F.lpad(nation.cast("string"), 3, "0"))).alias("mics"),
        nation_currency(nation).alias("currency"),
        *GOLDEN_NUMBERS,
        F.char("flag").alias("analyst_rating"),
    )


# Reports aggregate whole cents: BIGINT buffers stay in the hash operator with code
# generation, where decimals are slower and a maximum over a struct would have to sort.


def cents(column: str) -> Column:
    return F.round(F.col(column) * 100).cast("bigint")


def from_cents(column: str) -> Column:
    return (F.col(column).cast("decimal(18,0)") * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(18,2)")


def newest(day: str, price: Column) -> Column:
    """Highest price of the newest day: day and cents share a whole number (prices stay
    below ten thousand million)."""
    return F.max(F.unix_date(F.to_date(day)).cast("bigint") * 10**12 + price) % 10**12


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"),
        F.lit(0).alias("feed_rank"),
        F.col("p_partkey").alias("row_no"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("symbol"),
    )


@query(
    "golden_part",
    f"""
WITH {FX_SQL},
reports AS (
  SELECT l_partkey AS part, l_suppkey AS ord,
         max({{'d': l_shipdate::DATE, 'p': l_extendedprice::DECIMAL(18,2)}}).p AS last_price,
         min(l_extendedprice::DECIMAL(18,2)) AS lo, max(l_extendedprice::DECIMAL(18,2)) AS hi,
         sum(l_extendedprice::DECIMAL(18,2)) AS cap, sum(l_quantity::DECIMAL(18,2)) AS vol,
         max(l_returnflag) AS rating
  FROM lineitem GROUP BY ALL
),
usd AS (
  SELECT part, ord, 'M' || lpad(s_nationkey::VARCHAR, 3, '0') AS mic, rating, vol::DECIMAL(28,10) AS vol,
         {usd_sql('last_price')}::DECIMAL(28,10) AS last_price,
         {usd_sql('lo')}::DECIMAL(28,10) AS lo,
         {usd_sql('hi')}::DECIMAL(28,10) AS hi,
         {usd_sql('cap')}::DECIMAL(28,10) AS cap
  FROM reports JOIN supplier ON ord = s_suppkey JOIN fx ON s_nationkey = n_nationkey
  WHERE currency = 'USD' OR rate > 0
),
long AS (
  SELECT part, 'cap' AS f, 0.2 AS d, cap AS v FROM usd
  UNION ALL SELECT part, 'vol', 0.3, vol FROM usd
  UNION ALL SELECT part, 'last', 0.2, last_price FROM usd
  UNION ALL SELECT part, 'lo', 0.2, lo FROM usd
  UNION ALL SELECT part, 'hi', 0.2, hi FROM usd
),
mid AS (
  SELECT part, f, d, list_sort(list(v)) AS s FROM long GROUP BY ALL
),
near AS (
  SELECT part, f, list_filter(s, lambda v: len(s) < 2 OR
           abs(2 * v - (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]))
             < d * abs(s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1])) AS k
  FROM mid
),
single AS (
  SELECT part, f, CASE WHEN len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END AS v FROM near
),
flat AS (
  SELECT part, max(v) FILTER (f = 'cap') AS cap, max(v) FILTER (f = 'vol') AS vol,
         max(v) FILTER (f = 'last') AS l, max(v) FILTER (f = 'lo') AS a, max(v) FILTER (f = 'hi') AS b
  FROM single GROUP BY part
),
joint AS (
  SELECT part, count(*) AS n, list_sort(list(last_price)) AS l, list_sort(list(lo)) AS a, list_sort(list(hi)) AS b
  FROM usd WHERE lo <= hi AND lo * 0.9 <= last_price AND last_price <= hi * 1.1 GROUP BY part
),
ratings AS (
  SELECT part, first(rating ORDER BY c DESC, o) AS rating FROM (
    SELECT part, rating, count(*) AS c, min(ord) AS o FROM usd GROUP BY ALL) GROUP BY part
),
mics AS (
  SELECT part, string_agg(mic, ',' ORDER BY o) AS mics FROM (
    SELECT part, mic, min(ord) AS o FROM usd GROUP BY ALL) GROUP BY part
)
SELECT p_partkey AS part, p_name AS name, p_brand AS symbol, mics,
       CASE WHEN usd_rows.part IS NOT NULL THEN 'USD' END AS currency,
       CASE WHEN joint.n >= 2 THEN joint.l[(joint.n - 1) // 2 + 1] ELSE flat.l END::DOUBLE AS last_price,
       CASE WHEN joint.n >= 2 THEN joint.a[(joint.n - 1) // 2 + 1]
            WHEN coalesce(flat.a > flat.b, false) THEN NULL ELSE flat.a END::DOUBLE AS fifty_two_week_min,
       CASE WHEN joint.n >= 2 THEN joint.b[(joint.n - 1) // 2 + 1]
            WHEN coalesce(flat.a > flat.b, false) THEN NULL ELSE flat.b END::DOUBLE AS fifty_two_week_max,
       cap::DOUBLE AS market_cap, vol::DOUBLE AS market_volume, rating AS analyst_rating
FROM part
LEFT JOIN (SELECT DISTINCT part FROM usd) usd_rows ON usd_rows.part = p_partkey
LEFT JOIN flat ON flat.part = p_partkey LEFT JOIN joint ON joint.part = p_partkey
LEFT JOIN ratings ON ratings.part = p_partkey LEFT JOIN mics ON mics.part = p_partkey
""",
)
def golden_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest golden record per part from the catalogue and its suppliers' reports.

    The reports are staged: they are far smaller than the line items, and both the size
    check of the merge and the merge read them.
    """
    money = ("last_price", "fifty_two_week_min", "fifty_two_week_max", "market_cap")
    reports = to_usd(part_reports(spark, sf_dir), nation_rates(spark, sf_dir), money)
    rows = reports.unionByName(part_catalogue(spark, sf_dir), allowMissingColumns=True)
    merged = golden.merge(stage(rows, "reports"), "part", GOLDEN_RULES, ("feed_rank", "row_no"), GOLDEN_RANGE)
    joined = merged.withColumn("mics", F.array_join("mics", ","))
    return doubles(joined.select("part", *GOLDEN_RULES), *GOLDEN_NUMBERS)


# --- Mode, median, deviation, union ------------------------------------------------------

LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey")


@query(
    "mode_first",
    """
SELECT l_orderkey, first(f ORDER BY c DESC, o) AS l_returnflag FROM (
  SELECT l_orderkey, l_returnflag AS f, count(*) AS c, min(r) AS o FROM (
    SELECT l_orderkey, l_returnflag, row_number() OVER (
      PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS r
    FROM lineitem) GROUP BY ALL) GROUP BY l_orderkey
""",
)
def mode_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return golden.merge(lines, "l_orderkey", {"l_returnflag": MODE}, LINE_ORDER, None)


@query(
    "mode_first_wide",
    """
SELECT l_suppkey, first(f ORDER BY c DESC, o) AS mode, sum(c)::BIGINT AS sources FROM (
  SELECT l_suppkey, l_returnflag AS f, count(*) AS c, min(r) AS o FROM (
    SELECT l_suppkey, l_returnflag, row_number() OVER (
      PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag) AS r
    FROM lineitem) GROUP BY ALL) GROUP BY l_suppkey
""",
)
def mode_first_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    return wide.mode_wide(lines, ["l_suppkey"], "l_returnflag", order)


@query(
    "median_low",
    """
SELECT l_orderkey, list_sort(list(l_extendedprice))[(count(*) - 1) // 2 + 1] AS price
FROM lineitem GROUP BY l_orderkey
""",
)
def median_low(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("price", amount("l_extendedprice"))
    plain = golden.Rule(golden.Strategy.MEDIAN, max_deviation=None)
    return doubles(golden.merge(lines, "l_orderkey", {"price": plain}, LINE_ORDER, None), "price")


@query(
    "median_low_wide",
    """
SELECT l_returnflag, count(*) AS n, list_sort(list(l_extendedprice))[(count(*) - 1) // 2 + 1] AS low_median
FROM lineitem GROUP BY l_returnflag
""",
)
def median_low_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("price", amount("l_extendedprice"))
    return doubles(ranks.low_median(lines, ["l_returnflag"], "price"), "low_median")


HEAVY = "CASE WHEN l_orderkey % 40 = 0 THEN l_discount ELSE 0.05 END"
FLAGGED = "CASE WHEN l_linestatus = 'F' THEN l_returnflag END"


@query(
    "heavy_value_ranks",
    f"""
WITH v AS (SELECT {FLAGGED} AS flag, CAST({HEAVY} AS DECIMAL(18,2)) AS d FROM lineitem),
     s AS (SELECT flag, list_sort(list(d)) AS s, count(*) AS n FROM v GROUP BY flag)
SELECT flag, n, s[1]::DOUBLE AS lowest, s[(n - 1) // 2 + 1]::DOUBLE AS low_median,
       s[n // 50 + 1]::DOUBLE AS fiftieth, s[n]::DOUBLE AS highest FROM s
""",
)
def heavy_value_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value has more than 97 % of the rows; rows without a flag are a group."""
    values = table(spark, sf_dir, "lineitem").selectExpr(f"{FLAGGED} AS flag", f"CAST({HEAVY} AS DECIMAL(18,2)) AS d")
    wanted = {"lowest": "0", "low_median": "(n - 1) div 2", "fiftieth": "n div 50", "highest": "n - 1"}
    return doubles(ranks.pick_ranks(values, ["flag"], "d", wanted), *wanted)


DEVIATION_SQL = """
WITH mid AS (
  SELECT {key}, list_sort(list({value})) AS s, list_sort(list(abs({value}))) AS a FROM lineitem GROUP BY ALL
),
scaled AS (
  SELECT *, s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1] AS m,
         a[(len(s) - 1) // 2 + 1] + a[len(s) // 2 + 1] AS z FROM mid
),
near AS (
  SELECT {key}, CASE WHEN len(s) < 2 THEN s
      WHEN m <> 0 THEN list_filter(s, lambda v: abs(2 * v - m) < {d} * abs(m))
      WHEN z = 0 THEN s
      ELSE list_filter(s, lambda v: 2 * abs(v) < {d} * z) END AS k
  FROM scaled
)
"""


@query(
    "deviation_filter",
    DEVIATION_SQL.format(key="l_orderkey", value="l_extendedprice::DECIMAL(28,10)", d="0.2")
    + "SELECT l_orderkey, CASE WHEN len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END::DOUBLE AS price FROM near",
)
def deviation_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("price", amount("l_extendedprice"))
    merged = golden.merge(lines, "l_orderkey", {"price": TIGHT_PAIR}, LINE_ORDER, None)
    return doubles(merged, "price")


@query(
    "deviation_wide",
    DEVIATION_SQL.format(key="l_returnflag, l_linestatus", value="l_extendedprice::DECIMAL(28,10)", d="0.3")
    + """SELECT l_returnflag, l_linestatus, len(k)::BIGINT AS kept,
       k[1]::DOUBLE AS lowest, k[len(k)]::DOUBLE AS highest FROM near""",
)
def deviation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = ["l_returnflag", "l_linestatus"]
    lines = table(spark, sf_dir, "lineitem").select(*group, amount("l_extendedprice").alias("price"))
    near = wide.deviation_wide(lines, group, "price", F.lit("0.3").cast("decimal(4,3)"))
    kept = near.groupBy(*group).agg(
        F.count(F.lit(1)).alias("kept"), F.min("price").alias("lowest"), F.max("price").alias("highest")
    )
    return doubles(kept, "lowest", "highest")


@query(
    "deviation_zero_median",
    DEVIATION_SQL.format(key="l_orderkey", value="l_discount::DECIMAL(4,2) - 0.05", d="0.3")
    + "SELECT l_orderkey, k[(len(k) - 1) // 2 + 1]::DOUBLE AS gap FROM near",
)
def deviation_zero_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    gap = (F.col("l_discount").cast("decimal(4,2)") - F.lit("0.05").cast("decimal(4,2)"))
    lines = table(spark, sf_dir, "lineitem").withColumn("gap", gap)
    return doubles(golden.merge(lines, "l_orderkey", {"gap": SINGLE}, LINE_ORDER, None), "gap")


def order_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array("o_orderpriority", F.lit(" "), "o_orderstatus")
    return table(spark, sf_dir, "orders").withColumn("tags", tags)


UNION_SQL = """
SELECT {key}, string_agg(tag, '|' ORDER BY seen) AS tags FROM (
  SELECT {key}, tag, min((o_orderdate, o_orderkey, spot)) AS seen FROM (
    SELECT {key}, o_orderdate, o_orderkey, 0 AS spot, o_orderpriority AS tag FROM orders
    UNION ALL SELECT {key}, o_orderdate, o_orderkey, 2, o_orderstatus FROM orders) GROUP BY {key}, tag)
GROUP BY {key}
"""


@query("union_ordered", UNION_SQL.format(key="o_custkey"))
def union_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_tags(spark, sf_dir)
    merged = golden.merge(rows, "o_custkey", {"tags": UNION}, ("o_orderdate", "o_orderkey"), None)
    return merged.withColumn("tags", F.array_join("tags", "|"))


@query("union_ordered_wide", UNION_SQL.format(key="o_orderstatus"))
def union_ordered_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = order_tags(spark, sf_dir)
    merged = wide.union_wide(rows, ["o_orderstatus"], "tags", ("o_orderdate", "o_orderkey"))
    return merged.select("o_orderstatus", F.array_join("merged", "|").alias("tags"))


def range_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per part and supplier: newest price, low from shipped lines, high from returned
    ones, so that some reports are incomplete or contradict themselves."""
    price, flag = cents("l_extendedprice"), F.col("l_returnflag")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(
            newest("l_shipdate", price).alias("last"),
            F.min(F.when(flag.isin("N", "A"), price)).alias("low"),
            F.max(F.when(flag.isin("R", "A"), price)).alias("high"),
        )
        .withColumns({f: from_cents(f) for f in ("last", "low", "high")})
    )


@query(
    "price_range",
    """
WITH reports AS (
  SELECT l_partkey, l_suppkey,
         max({'d': l_shipdate::DATE, 'p': l_extendedprice::DECIMAL(28,10)}).p AS last,
         min(l_extendedprice::DECIMAL(28,10)) FILTER (l_returnflag IN ('N', 'A')) AS low,
         max(l_extendedprice::DECIMAL(28,10)) FILTER (l_returnflag IN ('R', 'A')) AS high
  FROM lineitem GROUP BY ALL
),
long AS (
  SELECT l_partkey, 'last' AS f, last AS v FROM reports
  UNION ALL SELECT l_partkey, 'low', low FROM reports WHERE low IS NOT NULL
  UNION ALL SELECT l_partkey, 'high', high FROM reports WHERE high IS NOT NULL
),
mid AS (SELECT l_partkey, f, list_sort(list(v)) AS s FROM long GROUP BY ALL),
near AS (
  SELECT l_partkey, f, list_filter(s, lambda v: len(s) < 2 OR
           abs(2 * v - (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]))
             < 0.2 * abs(s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1])) AS k FROM mid
),
flat AS (
  SELECT l_partkey,
         max(CASE WHEN f = 'last' AND len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END) AS l,
         max(CASE WHEN f = 'low' AND len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END) AS a,
         max(CASE WHEN f = 'high' AND len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END) AS b
  FROM near GROUP BY l_partkey
),
joint AS (
  SELECT l_partkey, count(*) AS n, list_sort(list(last)) AS l, list_sort(list(low)) AS a, list_sort(list(high)) AS b
  FROM reports WHERE low <= high AND low * 0.9 <= last AND last <= high * 1.1 GROUP BY l_partkey
)
SELECT flat.l_partkey,
       CASE WHEN n >= 2 THEN joint.l[(n - 1) // 2 + 1] ELSE flat.l END::DOUBLE AS last,
       CASE WHEN n >= 2 THEN joint.a[(n - 1) // 2 + 1] WHEN coalesce(flat.a > flat.b, false) THEN NULL ELSE flat.a END::DOUBLE AS low,
       CASE WHEN n >= 2 THEN joint.b[(n - 1) // 2 + 1] WHEN coalesce(flat.a > flat.b, false) THEN NULL ELSE flat.b END::DOUBLE AS high
FROM flat LEFT JOIN joint USING (l_partkey)
""",
)
def price_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {f: TIGHT_PAIR for f in ("last", "low", "high")}
    reports = range_reports(spark, sf_dir)
    merged = golden.merge(stage(reports, "reports"), "l_partkey", rules, ("l_suppkey",), PriceRange("last", "low", "high"))
    return doubles(merged, "last", "low", "high")


@query(
    "identifiers",
    """
WITH r AS (
  SELECT l_orderkey, l_returnflag, l_linestatus, l_suppkey, row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS o
  FROM lineitem
)
SELECT a.l_orderkey, symbol, isin, cusip FROM
 (SELECT l_orderkey, first(v ORDER BY c DESC, o) AS symbol FROM
   (SELECT l_orderkey, l_returnflag AS v, count(*) AS c, min(o) AS o FROM r GROUP BY ALL) GROUP BY 1) a
JOIN (SELECT l_orderkey, first(v ORDER BY c DESC, o) AS isin FROM
   (SELECT l_orderkey, l_linestatus AS v, count(*) AS c, min(o) AS o FROM r GROUP BY ALL) GROUP BY 1) b USING (l_orderkey)
JOIN (SELECT l_orderkey, first(v ORDER BY c DESC, o) AS cusip FROM
   (SELECT l_orderkey, l_suppkey::VARCHAR AS v, count(*) AS c, min(o) AS o FROM r GROUP BY ALL) GROUP BY 1) d USING (l_orderkey)
""",
)
def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"symbol": F.col("l_returnflag"), "isin": F.col("l_linestatus"), "cusip": F.col("l_suppkey").cast("string")}
    )
    rules = {f: golden.IDENTIFIER_RULES[f] for f in ("symbol", "isin", "cusip")}
    order = (*LINE_ORDER, "l_returnflag", "l_linestatus")
    return golden.identifiers(lines, "l_orderkey", rules=rules, order=order)


# A spelling is the part name, alone or with one of two legal forms. Names of one part
# differ in nothing else, so the base spelling matches both forms and these two do not
# match each other: the leader rule reduces to the SQL below.


@query(
    "fuzzy_name_vote",
    """
WITH spelled AS (
  SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN ' INCORPORATED' ELSE ' XYZ' END AS form,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_returnflag) AS o
  FROM lineitem
),
t AS (SELECT l_partkey, form, count(*) AS c, min(o) AS o FROM spelled GROUP BY ALL),
g AS (
  SELECT l_partkey, first(form ORDER BY o) AS head, first(form ORDER BY o) FILTER (form <> '') AS lead,
         first(o ORDER BY o) FILTER (form <> '') AS lead_o,
         coalesce(max(c) FILTER (form = ''), 0) AS base
  FROM t GROUP BY ALL
),
w AS (
  SELECT t.l_partkey, form, c * c + CASE WHEN form = lead THEN base * base ELSE 0 END AS weight, o
  FROM t JOIN g USING (l_partkey) WHERE form <> '' AND head <> ''
),
pick AS (
  SELECT l_partkey, first(form ORDER BY weight DESC, o) AS form FROM w GROUP BY l_partkey
  UNION ALL SELECT l_partkey, '' FROM g WHERE head = ''
)
SELECT l_partkey, p_name || form AS name FROM pick JOIN part ON p_partkey = l_partkey
""",
)
def fuzzy_name_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    form = F.when(F.col("l_returnflag") == "A", "").when(F.col("l_returnflag") == "N", " INCORPORATED").otherwise(" XYZ")
    lines = table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    spelled = lines.withColumn("name", F.concat("p_name", form))
    order = ("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag")
    return golden.merge(spelled, "l_partkey", {"name": FUZZY}, order, None)


# Of the two-word part names only "cold x" and "old x" come within the threshold of each
# other, so clusters are spellings with that pair put together.


@query(
    "fuzzy_name_vote_wide",
    """
WITH t AS (
  SELECT p_brand, p_name, regexp_replace(p_name, '^cold ', 'old ') AS cluster, count(*) AS c, min(p_partkey) AS o
  FROM part GROUP BY ALL
),
g AS (
  SELECT p_brand, cluster, sum(c * c) AS w, sum(c) AS n, min(o) AS o, first(p_name ORDER BY o) AS leader
  FROM t GROUP BY ALL
)
SELECT p_brand, first(leader ORDER BY w DESC, o) AS name, sum(n)::BIGINT AS sources FROM g GROUP BY p_brand
""",
)
def fuzzy_name_vote_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name vote of whole brands."""
    parts = table(spark, sf_dir, "part")
    voted = wide.fuzzy_wide(parts, ["p_brand"], "p_name", ["p_partkey"])
    return voted.select("p_brand", F.col("chosen").alias("name"), "sources")


def all_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``kind, key, name`` of every customer, supplier and part."""

    def named(kind: str, key: str, name: str) -> DataFrame:
        return table(spark, sf_dir, kind).select(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.col(name).alias("name"))

    both = named("customer", "c_custkey", "c_name").unionByName(named("supplier", "s_suppkey", "s_name"))
    return both.unionByName(named("part", "p_partkey", "p_name"))


@query("fuzzy_names_one_group")
def fuzzy_names_one_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name vote over all names as one group. The leader rule has no SQL form; a test visits the
    names one by one instead."""
    names = all_names(spark, sf_dir).withColumn("everyone", F.lit(1))
    voted = wide.fuzzy_wide(names, ["everyone"], "name", ["kind", "key"])
    return voted.select(F.col("chosen").alias("name"), "sources")


@query(
    "golden_wide",
    """
WITH flags AS (
  SELECT l_linestatus, first(f ORDER BY c DESC, o) AS flag FROM (
    SELECT l_linestatus, l_returnflag AS f, count(*) AS c, min((l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS o
    FROM lineitem GROUP BY ALL) GROUP BY l_linestatus
),
mid AS (SELECT l_linestatus, list_sort(list(l_extendedprice::DECIMAL(28,10))) AS s FROM lineitem GROUP BY ALL),
near AS (
  SELECT l_linestatus, list_filter(s, lambda v: abs(2 * v - (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]))
             < 0.2 * abs(s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1])) AS k FROM mid
)
SELECT l_linestatus, flag, CASE WHEN len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END::DOUBLE AS price
FROM flags JOIN near USING (l_linestatus)
""",
)
def golden_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge where two keys hold the whole table: every rule runs distributed."""
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {"flag": F.col("l_returnflag"), "price": amount("l_extendedprice")}
    )
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    merged = golden.merge(lines, "l_linestatus", {"flag": MODE, "price": TIGHT_PAIR}, order, None)
    return doubles(merged, "price")


@query(
    "group_stats",
    """
SELECT count(*) AS total, count(DISTINCT l_orderkey) AS unique_keys,
       count(*) - count(DISTINCT l_orderkey) AS duplicates FROM lineitem
""",
)
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return golden.group_counts(table(spark, sf_dir, "lineitem"), "l_orderkey")


# --- Conversion ------------------------------------------------------------------------------


def priced_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", amount("o_totalprice").alias("price"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", nation_currency(F.col("c_nationkey")).alias("currency"), "price")


PRICED_SQL = f"""
WITH {FX_SQL},
priced AS (
  SELECT o_orderkey, currency, rate, o_totalprice::DECIMAL(18,2) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN fx ON c_nationkey = n_nationkey
)
"""


@query(
    "fx_convert",
    PRICED_SQL
    + f"""
SELECT o_orderkey, 'USD' AS currency, {usd_sql("price")} AS price
FROM priced WHERE currency = 'USD' OR rate > 0
""",
)
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    converted = to_usd(priced_orders(spark, sf_dir), nation_rates(spark, sf_dir), ["price"])
    return doubles(converted, "price")


@query(
    "fx_convert_duplicates",
    PRICED_SQL
    + f"""
SELECT o_orderkey, 'USD' AS currency, {usd_sql("price")} AS price
FROM priced WHERE currency = 'USD' OR rate > 0
""",
)
def fx_convert_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates that landed twice convert no row twice."""
    rates = nation_rates(spark, sf_dir)
    converted = to_usd(priced_orders(spark, sf_dir), rates.union(rates), ["price"])
    return doubles(converted, "price")


@query(
    "fx_dropped",
    PRICED_SQL
    + """
SELECT currency, count(*) AS n FROM priced
WHERE currency <> 'USD' AND (rate IS NULL OR rate <= 0) GROUP BY currency
""",
)
def fx_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    dropped = without_rate(priced_orders(spark, sf_dir), nation_rates(spark, sf_dir), ["price"])
    return dropped.groupBy("currency").agg(F.count(F.lit(1)).alias("n"))


# --- Identification ------------------------------------------------------------------------------


def code(prefix: str, key: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


@query(
    "identify_lookup",
    """
WITH q AS (
  SELECT *, CASE WHEN s_acctbal >= 5000 THEN 'ID_ISIN' WHEN s_acctbal >= 1000 THEN 'ID_CUSIP' ELSE 'TICKER' END AS id_type
  FROM supplier
)
SELECT s_suppkey AS supplier, id_type,
       CASE WHEN s_nationkey < 8 THEN 'FOUND ' || s_suppkey ELSE s_name END AS name,
       CASE WHEN s_nationkey < 16 THEN 'SYM' || s_suppkey ELSE 'S' || lpad(s_suppkey::VARCHAR, 6, '0') END AS symbol,
       'BBG' || lpad(s_suppkey::VARCHAR, 9, '0') AS share_class_figi
FROM q WHERE s_nationkey <> 20
""",
)
def identify_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers looked up by ISIN, else CUSIP, else ticker; nation 20 resolves to no id."""
    key, balance, nation = F.col("s_suppkey"), F.col("s_acctbal"), F.col("s_nationkey")
    rows = table(spark, sf_dir, "supplier").select(
        key.alias("supplier"),
        nation.alias("nation"),
        F.col("s_name").alias("name"),
        code("S", key, 6).alias("symbol"),
        F.when(balance >= 5000, code("US", key, 10)).alias("isin"),
        F.when(balance >= 1000, code("C", key, 8)).alias("cusip"),
    )
    kind, value = query_key(F.col("isin"), F.col("cusip"), F.col("symbol"))
    lookup = rows.select(
        kind.alias("id_type"),
        value.alias("id_value"),
        F.when(F.col("nation") < 8, F.concat(F.lit("FOUND "), "supplier")).otherwise("").alias("found_name"),
        F.when(F.col("nation") < 16, F.concat(F.lit("SYM"), "supplier")).alias("found_symbol"),
        F.when(F.col("nation") != 20, code("BBG", F.col("supplier"), 9)).alias("found_figi"),
    )
    found = identify(rows.withColumn("kind", kind), lookup)
    return found.select("supplier", F.col("kind").alias("id_type"), "name", "symbol", "share_class_figi")


@query(
    "identify_responses",
    """
WITH valid AS (
  SELECT s_suppkey, 'P' || l_partkey AS ticker, CASE l_linestatus WHEN 'O' THEN 'SEC ' || l_partkey END AS label,
         'BBG' || lpad(l_partkey::VARCHAR, 9, '0') AS figi,
         row_number() OVER (PARTITION BY s_suppkey ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_linestatus DESC) AS r
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag <> 'R'
)
SELECT s_suppkey::VARCHAR AS id_value, coalesce(label, ticker) AS found_name, ticker AS found_symbol, figi AS found_figi
FROM valid WHERE r = 1
""",
)
def identify_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional responses to a keyed lookup: malformed ids ignored, last row wins."""
    part, flag = F.col("l_partkey"), F.col("l_returnflag")
    queries = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("query_no"),
        F.lit("TICKER").alias("id_type"),
        F.col("s_suppkey").cast("string").alias("id_value"),
    )
    responses = table(spark, sf_dir, "lineitem").select(
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus").alias("row_no"),
        F.when(flag == "A", F.col("l_suppkey")).alias("query_number"),
        F.col("l_suppkey").alias("queryId"),
        F.when(flag == "R", code("bbg", part, 9)).otherwise(code("BBG", part, 9)).alias("shareClassFIGI"),
        F.concat(F.lit("P"), part).alias("ticker"),
        F.lit("").alias("name"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("SEC "), part)).alias("securityName"),
    )
    found = responses_to_lookup(queries, responses)
    return found.select("id_value", "found_name", "found_symbol", "found_figi")


@query(
    "price_consistency",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       (l_extendedprice::DECIMAL(18,2) * 0.95 * 0.9 <= l_quantity::DECIMAL(18,2) * 1500
        AND l_quantity::DECIMAL(18,2) * 1500 <= l_extendedprice::DECIMAL(18,2) * 1.1
        AND l_extendedprice::DECIMAL(18,2) * 0.95 <= l_extendedprice::DECIMAL(18,2)) AS consistent
FROM lineitem
""",
)
def price_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerance test of every line: a nominal price against its own range."""
    key = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").withColumns(
        {
            "high": amount("l_extendedprice"),
            "last": amount("l_quantity") * 1500,
        }
    )
    lines = lines.withColumn("low", F.col("high") * F.lit("0.95").cast("decimal(3,2)"))
    bounds = ("last", "low", "high")
    flag = f"{votes.is_complete(*bounds)} AND {votes.is_consistent(*bounds)} AS consistent"
    return lines.selectExpr(*key, flag)
