"""Store, report and streaming operators over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions.display import display_date, display_usd
from concord.operators import golden
from concord.operators.fx import to_usd
from concord.operators.golden import MODE, TIGHT_PAIR
from concord.plans import report
from concord.plans.store import (
    Store,
    cache_get,
    cache_put,
    count_dates,
    history,
    latest,
    staleness,
    unexpired,
)
from concord.queries.base import FX_SQL, amount, doubles, nation_currency, nation_rates, query, table, usd_sql
from concord.session import scratch_dir
from concord.streaming import streams

# --- Latest, by key, history -----------------------------------------------------------------


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per customer and day: the day's last order."""
    orders = table(spark, sf_dir, "orders")
    last = F.max(F.struct("o_orderkey", "o_totalprice", "o_orderpriority"))
    daily = orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("snapshot_date")).agg(last.alias("r"))
    return daily.select(F.col("o_custkey").alias("c_custkey"), "snapshot_date", "r.o_totalprice", "r.o_orderpriority")


def shown(df: DataFrame) -> DataFrame:
    return df.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd"))


SNAPSHOT_SQL = """
WITH snap AS (
  SELECT o_custkey AS c_custkey, o_orderdate::DATE AS d, arg_max(o_totalprice, o_orderkey) AS o_totalprice,
         arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
  FROM orders GROUP BY ALL
)
"""
SHOWN = "c_custkey, c_name, strftime(d, '%Y-%m-%d') AS snapshot_date, o_totalprice, o_orderpriority"


@query(
    "latest_snapshot",
    SNAPSHOT_SQL
    + f"""
SELECT {SHOWN} FROM customer JOIN snap USING (c_custkey)
WHERE d = (SELECT max(d) FROM snap s2 WHERE s2.c_custkey = customer.c_custkey)
""",
)
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(latest(identities(spark, sf_dir), snapshots(spark, sf_dir), "c_custkey"))


KEY = 7


@query(
    "by_key",
    SNAPSHOT_SQL + f"SELECT {SHOWN} FROM customer JOIN snap USING (c_custkey) WHERE c_custkey = {KEY} ORDER BY d DESC LIMIT 1",
)
def by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    same = F.col("c_custkey") == KEY
    return shown(latest(identities(spark, sf_dir).filter(same), snapshots(spark, sf_dir).filter(same), "c_custkey"))


@query(
    "history_range",
    SNAPSHOT_SQL
    + f"SELECT {SHOWN} FROM customer JOIN snap USING (c_custkey) WHERE c_custkey = {KEY} AND d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'",
)
def history_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = history(identities(spark, sf_dir), snapshots(spark, sf_dir), "c_custkey", KEY, "1996-01-01", "1999-12-31")
    return shown(rows)


# --- Upsert ------------------------------------------------------------------------------------------


def order_store(spark: SparkSession) -> Store:
    key = T.StructField("customer", T.LongType())
    facts = T.StructType([key, T.StructField("price", T.DoubleType()), T.StructField("snapshot_date", T.DateType())])
    names = T.StructType([key, T.StructField("status", T.StringType())])
    root = f"{scratch_dir(spark)}/concord/store-{uuid.uuid4().hex}"
    return Store(spark, root, names, facts, key="customer", buckets=8)


UPSERT_SQL = """
WITH b AS (
  SELECT o_custkey AS customer, date_trunc('year', o_orderdate)::DATE AS d, o_totalprice AS price, o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS batch, o_orderdate, o_orderkey
  FROM orders
),
snap AS (SELECT customer, d, arg_max(price, (batch, o_orderdate, o_orderkey)) AS price FROM b GROUP BY ALL),
ident AS (
  SELECT customer, arg_max(status, (batch, d, o_orderdate, o_orderkey)) AS status FROM b GROUP BY ALL
)
"""


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"),
        F.to_date(F.trunc("o_orderdate", "year")).alias("snapshot_date"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
        "o_orderdate",
        "o_orderkey",
    )


def saved_orders(spark: SparkSession, sf_dir: str) -> Store:
    """Two overlapping batches saved in turn: finished orders, then the others."""
    orders, store = dated_orders(spark, sf_dir), order_store(spark)
    for batch in (orders.filter("status = 'F'"), orders.filter("status <> 'F'")):
        store.save(batch, order=("o_orderdate", "o_orderkey"))
    return store


@query(
    "snapshot_upsert",
    UPSERT_SQL
    + "SELECT customer, status, strftime(d, '%Y-%m-%d') AS snapshot_date, price FROM ident JOIN snap USING (customer)",
)
def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches saved in turn, the second one twice; read back whole."""
    store = saved_orders(spark, sf_dir)
    store.save(dated_orders(spark, sf_dir).filter("status <> 'F'"), order=("o_orderdate", "o_orderkey"))
    view = store.view()
    return shown(view.identities().join(view.snapshots(), "customer"))


@query(
    "stored_latest",
    UPSERT_SQL
    + """SELECT customer, status, strftime(max(d), '%Y-%m-%d') AS snapshot_date, arg_max(price, d) AS price
FROM ident JOIN snap USING (customer) GROUP BY customer, status""",
)
def stored_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The store's current rows after two saves: one scan."""
    return shown(saved_orders(spark, sf_dir).latest())


@query(
    "stored_by_key",
    UPSERT_SQL
    + f"""SELECT customer, status, strftime(max(d), '%Y-%m-%d') AS snapshot_date, arg_max(price, d) AS price
FROM ident JOIN snap USING (customer) WHERE customer = {KEY} GROUP BY customer, status""",
)
def stored_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key of the saved orders, from its bucket."""
    return shown(saved_orders(spark, sf_dir).by_key(KEY, required=True))


@query(
    "stored_history",
    UPSERT_SQL
    + f"""SELECT customer, status, strftime(d, '%Y-%m-%d') AS snapshot_date, price
FROM ident JOIN snap USING (customer) WHERE customer = {KEY} AND d BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'""",
)
def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key's saved snapshots of four years, from its bucket of those dates."""
    return shown(saved_orders(spark, sf_dir).history(KEY, "1996-01-01", "1999-12-31"))


# --- Cache with time-to-live -------------------------------------------------------------------------------


NOW = "2024-01-25 00:00:00"
TTL = 7 * 24 * 3600


def cache_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("cache_name"),
        F.col("user_id").cast("string").alias("key"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("created_at"),
        F.col("value").alias("payload"),
        "event_id",
    )


CACHE_SQL = f"""
WITH e AS (
  SELECT event_type AS cache_name, user_id::VARCHAR AS key, epoch(date_trunc('second', ts))::BIGINT AS created_at, value AS payload, event_id FROM events
),
put AS (
  SELECT cache_name, key, created_at, payload FROM (
    SELECT *, row_number() OVER (PARTITION BY cache_name, key ORDER BY created_at DESC, event_id DESC) AS r FROM e) WHERE r = 1
),
now AS (SELECT epoch(TIMESTAMP '{NOW}')::BIGINT AS t)
"""


@query("cache_put", CACHE_SQL + "SELECT * FROM put")
def cache_puts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cache_put(None, cache_rows(spark, sf_dir), ["event_id"])


@query(
    "cache_put_over",
    CACHE_SQL.replace("ORDER BY created_at DESC, event_id DESC", "ORDER BY payload >= 20 DESC, created_at DESC, event_id DESC")
    + "SELECT * FROM put",
)
def cache_put_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of high value put over the others."""
    rows, late = cache_rows(spark, sf_dir), F.col("payload") >= 20
    old = cache_put(None, rows.filter(~late), ["event_id"])
    return cache_put(old, rows.filter(late), ["event_id"])


@query(
    "ttl_sweep",
    CACHE_SQL + f"SELECT cache_name, key, created_at, payload FROM put, now WHERE t - created_at <= {TTL}",
)
def ttl_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = cache_puts(spark, sf_dir)
    return unexpired(entries, F.unix_seconds(F.lit(NOW).cast("timestamp")), TTL)


@query(
    "cache_get",
    CACHE_SQL
    + f"SELECT cache_name, key, created_at, payload FROM put, now WHERE t - created_at <= {TTL} AND cache_name = 'click'",
)
def cache_gets(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.unix_seconds(F.lit(NOW).cast("timestamp"))
    return cache_get(cache_puts(spark, sf_dir), "click", now, TTL)


# --- Report -------------------------------------------------------------------------------------------------------


@query("snapshot_dates", "SELECT count(DISTINCT o_orderdate::DATE) AS snapshot_dates FROM orders")
def snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_dates(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("snapshot_date")))


@query(
    "is_stale",
    """
SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS latest_date, strftime(max(o_orderdate), '%d/%m/%Y') AS shown,
       max(o_orderdate) < TIMESTAMP '2001-09-01' AS stale FROM orders
""",
)
def is_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("snapshot_date"))
    row = staleness(dates, F.lit("2001-09-01").cast("date"))
    day = F.col("latest_date")
    return row.select(F.date_format(day, "yyyy-MM-dd").alias("latest_date"), display_date(day).alias("shown"), "stale")


@query(
    "coverage",
    """
WITH d AS (SELECT doc_id, quality, toxic, nullif(quality, 0) AS good FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'quality' AS field, round(100.0 * avg((quality IS NOT NULL)::INT))::BIGINT AS populated FROM d
UNION ALL SELECT 'good', round(100.0 * avg((good IS NOT NULL)::INT))::BIGINT FROM d
UNION ALL SELECT 'doc_id', round(100.0 * avg((doc_id IS NOT NULL)::INT))::BIGINT FROM d
""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.nullif("quality", F.lit(0)).alias("good"))
    docs = table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left")
    return report.coverage(docs, ["quality", "good", "doc_id"])


@query(
    "coverage_table",
    """
SELECT field, populated FROM (VALUES ('name', 100::BIGINT), ('symbol', 100), ('share class figi', 100)) v(field, populated)
UNION ALL SELECT 'isin', round(100.0 * avg((c_acctbal > 0)::INT))::BIGINT FROM customer
UNION ALL SELECT 'cusip', round(100.0 * avg((c_acctbal > 5000)::INT))::BIGINT FROM customer
UNION ALL SELECT 'cik', round(100.0 * avg((c_nationkey < 9)::INT))::BIGINT FROM customer
UNION ALL SELECT 'lei', 0 FROM (SELECT count(*) FROM customer)
""",
)
def coverage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("isin"),
        F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("cusip"),
        F.when(F.col("c_nationkey") < 9, F.col("c_name")).alias("cik"),
        F.lit(None).cast("string").alias("lei"),
    )
    return report.coverage_table(rows)


@query(
    "distinct_values",
    """
SELECT count(DISTINCT o_orderpriority) AS o_orderpriority, count(DISTINCT o_orderstatus) AS o_orderstatus,
       count(DISTINCT o_custkey) AS o_custkey FROM orders
""",
)
def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.distinct_values(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus", "o_custkey"])


@query(
    "distinct_elements",
    """
SELECT count(DISTINCT e) AS elements FROM (
  SELECT unnest(string_split(regexp_replace(props, '[{}" ]', '', 'g'), ':')) AS e FROM events)
""",
)
def distinct_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.split(F.regexp_replace("props", '[{}" ]', ""), ":")
    return report.distinct_elements(table(spark, sf_dir, "events").select(cells.alias("cells")), "cells")


@query(
    "cap_totals",
    "SELECT sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total, max(o_totalprice) AS largest FROM orders",
)
def cap_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = table(spark, sf_dir, "orders").select(amount("o_totalprice").alias("cap"))
    return doubles(report.cap_totals(caps, "cap"), "total", "largest")


@query(
    "upper_median",
    "SELECT list_sort(list(l_extendedprice))[count(*) // 2 + 1] AS median FROM lineitem",
)
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    caps = table(spark, sf_dir, "lineitem").select(amount("l_extendedprice").alias("cap"))
    return doubles(report.cap_median(caps, "cap"), "median")


@query(
    "coherence_range",
    """
SELECT round(100.0 * avg((l_discount <= l_tax AND l_tax <= 0.05)::INT))::BIGINT AS in_range_pct
FROM lineitem WHERE l_returnflag <> 'R'
""",
)
def coherence_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("price"),
        F.col("l_discount").alias("low"),
        F.lit(0.05).alias("high"),
    )
    inside = report.in_range(F.col("price"), F.col("low"), F.col("high"))
    return lines.agg(report.ratio_percent(lines, inside, ["price", "low", "high"]).alias("in_range_pct"))


@query(
    "coherence_product",
    """
SELECT round(100.0 * avg((abs(l_extendedprice - p_retailprice * l_quantity) <= 0.25 * l_extendedprice)::INT))::BIGINT AS cap_agrees_pct
FROM lineitem JOIN part ON l_partkey = p_partkey
""",
)
def coherence_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    both = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    fields = ["l_extendedprice", "p_retailprice", "l_quantity"]
    agrees = report.cap_agrees(*[F.col(f) for f in fields])
    return both.agg(report.ratio_percent(both, agrees, fields).alias("cap_agrees_pct"))


PRICE_TIERS = (
    ("top", 1e6, None),
    ("large", 400000.0, 1e6),
    ("mid", 200000.0, 400000.0),
    ("small", 50000.0, 200000.0),
    ("micro", 0.0, 50000.0),
)


@query(
    "tier_histogram",
    """
WITH t(tier_no, tier, lo, hi) AS (
  VALUES (0, 'top', 1e6, NULL), (1, 'large', 4e5, 1e6), (2, 'mid', 2e5, 4e5), (3, 'small', 5e4, 2e5), (4, 'micro', 0, 5e4))
SELECT tier_no, tier, count(o_orderkey) AS n
FROM t LEFT JOIN orders ON o_totalprice >= lo AND (hi IS NULL OR o_totalprice < hi) GROUP BY ALL
""",
)
def tier_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.tier_histogram(table(spark, sf_dir, "orders"), F.col("o_totalprice"), PRICE_TIERS)


@query(
    "display_forms",
    """
WITH v AS (
  SELECT o_orderkey, o_orderdate, CASE o_orderstatus WHEN 'F' THEN o_totalprice * 1e8 WHEN 'O' THEN o_totalprice * 1e6
         ELSE round(o_totalprice) END::DOUBLE AS v FROM orders
)
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS day,
       CASE WHEN v >= 1e12 THEN format('${:.2f}T', v / 1e12) WHEN v >= 1e9 THEN format('${:.2f}B', v / 1e9)
            WHEN v >= 1e6 THEN format('${:.0f}M', v / 1e6) ELSE format('${:,}', round(v)::BIGINT) END AS usd
FROM v
""",
)
def display_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    value = F.when(status == "F", price * 1e8).when(status == "O", price * 1e6).otherwise(F.round(price))
    day = display_date(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), display_usd(value).alias("usd"))


FIGURE_COLUMNS = {
    "sector": "o_orderpriority",
    "industry": "o_orderstatus",
    "mics": "tags",
    "cap": "cap",
    "price": "price",
    "low": "low",
    "high": "high",
    "shares": "shares",
}


@query(
    "key_figures",
    """
WITH snap AS (
  SELECT *, date_trunc('year', o_orderdate)::DATE AS d, o_totalprice::DECIMAL(18,2) AS cap FROM orders
),
now AS (SELECT * FROM snap WHERE d = (SELECT max(d) FROM snap)),
s AS (
  SELECT count(DISTINCT o_orderpriority) AS sectors, count(DISTINCT o_orderstatus) AS industries,
         count(DISTINCT o_orderpriority) + count(DISTINCT o_orderstatus) AS venues,
         sum(cap)::DOUBLE AS total, max(cap)::DOUBLE AS largest, list_sort(list(cap))[count(*) // 2 + 1]::DOUBLE AS median,
         round(100.0 * avg((o_totalprice BETWEEN 100000 AND 300000)::INT))::BIGINT AS in_range_pct,
         round(100.0 * avg((abs(o_totalprice - o_totalprice * (1 + (o_orderkey % 50) / 100.0)) <= 0.25 * o_totalprice)::INT))::BIGINT AS cap_agrees_pct
  FROM now
)
SELECT (SELECT count(*) FROM customer) AS equities, sectors, industries, venues,
       (SELECT count(DISTINCT d) FROM snap) AS snapshot_dates,
       (SELECT strftime(min(d), '%d/%m/%Y') FROM snap) AS history_since,
       CASE WHEN total >= 1e9 THEN format('${:.2f}B', total / 1e9) WHEN total >= 1e6 THEN format('${:.0f}M', total / 1e6) ELSE format('${:,}', round(total)::BIGINT) END AS aggregate_cap,
       CASE WHEN largest >= 1e6 THEN format('${:.0f}M', largest / 1e6) ELSE format('${:,}', round(largest)::BIGINT) END AS largest_cap,
       CASE WHEN median >= 1e6 THEN format('${:.0f}M', median / 1e6) ELSE format('${:,}', round(median)::BIGINT) END AS median_cap,
       in_range_pct, cap_agrees_pct
FROM s
""",
)
def key_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        "o_orderstatus",
        F.to_date(F.trunc("o_orderdate", "year")).alias("snapshot_date"),
        F.array("o_orderpriority", "o_orderstatus").alias("tags"),
        amount("o_totalprice").alias("cap"),
        F.col("o_totalprice").alias("price"),
        F.lit(100000.0).alias("low"),
        F.lit(300000.0).alias("high"),
        (1 + (F.col("o_orderkey") % 50) / 100.0).alias("shares"),
    )
    return report.key_figures(table(spark, sf_dir, "customer"), orders, FIGURE_COLUMNS)


# --- Streaming twins -------------------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    rows = streams.landed_stream(spark, sf_dir, schema, glob="events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def run_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/concord/stream-{uuid.uuid4().hex}"


@query("stream_first_seen", "SELECT DISTINCT event_type, user_id FROM events")
def stream_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming dedup by key within a horizon longer than the data."""
    kept = streams.first_seen(event_stream(spark, sf_dir), ["event_type", "user_id"], "ts", "60 days")
    folder = run_folder(spark)
    streams.run_available(kept.select("event_type", "user_id"), f"{folder}/state", f"{folder}/rows")
    return spark.read.schema("event_type string, user_id bigint").parquet(f"{folder}/rows")


STREAM_FX_SQL = f"""
WITH {FX_SQL},
e AS (
  SELECT event_id, currency, rate, value::DECIMAL(18,2) AS price FROM events JOIN fx ON user_id % 25 = n_nationkey
)
SELECT event_id, {usd_sql("price")} AS price FROM e WHERE currency = 'USD' OR rate > 0
"""


@query("stream_convert", STREAM_FX_SQL)
def stream_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream joined with the static rates table; same result as the batch conversion."""
    events = event_stream(spark, sf_dir).select(
        "event_id", nation_currency((F.col("user_id") % 25).cast("int")).alias("currency"), amount("value").alias("price")
    )
    usd = to_usd(events, nation_rates(spark, sf_dir), ["price"], "currency")
    folder = run_folder(spark)
    streams.run_available(usd.select("event_id", F.col("price").cast("double").alias("price")), f"{folder}/state", f"{folder}/rows")
    return spark.read.schema("event_id bigint, price double").parquet(f"{folder}/rows")


@query(
    "stream_fan_in",
    """
SELECT 'events' AS feed, event_type AS name, count(*) AS n FROM events GROUP BY ALL
UNION ALL SELECT 'orders', o_orderpriority, count(*) FROM orders GROUP BY ALL
""",
)
def stream_fan_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing folders as one stream, tagged by feed."""
    events = streams.landed_stream(spark, sf_dir, table(spark, sf_dir, "events").schema, glob="events.parquet")
    orders = streams.landed_stream(spark, sf_dir, table(spark, sf_dir, "orders").schema, glob="orders.parquet")
    union = streams.fan_in(
        [
            events.select(F.lit("events").alias("feed"), F.col("event_type").alias("name")),
            orders.select(F.lit("orders").alias("feed"), F.col("o_orderpriority").alias("name")),
        ]
    )
    folder = run_folder(spark)
    streams.run_available(union, f"{folder}/state", f"{folder}/rows")
    rows = spark.read.schema("feed string, name string").parquet(f"{folder}/rows")
    return rows.groupBy("feed", "name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stream_merge",
    """
WITH mid AS (SELECT user_id, list_sort(list(value::DECIMAL(28,10))) AS s FROM events GROUP BY user_id),
near AS (
  SELECT user_id, list_filter(s, lambda v: abs(2 * v - (s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1]))
             < 0.2 * abs(s[(len(s) - 1) // 2 + 1] + s[len(s) // 2 + 1])) AS k FROM mid
),
kinds AS (
  SELECT user_id, first(event_type ORDER BY c DESC, o) AS status FROM (
    SELECT user_id, event_type, count(*) AS c, min(event_id) AS o FROM events GROUP BY ALL) GROUP BY user_id
)
SELECT user_id AS customer, status, '2024-02-01' AS snapshot_date, CASE WHEN len(k) >= 2 THEN k[(len(k) - 1) // 2 + 1] END::DOUBLE AS price
FROM near JOIN kinds USING (user_id)
""",
)
def stream_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports land in several files that split every key, one file per micro-batch; each batch
    merges all reports so far of its keys. The last batch is then replayed, which changes nothing."""
    store = order_store(spark)
    rules = {"status": MODE, "price": TIGHT_PAIR}

    def merge_batch(batch: DataFrame) -> DataFrame:
        return doubles(golden.merge(batch, "customer", rules, ("event_id",), None), "price")

    landed = f"{run_folder(spark)}/reports"
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("customer"), F.col("event_type").alias("status"), amount("value").alias("price"), "event_id"
    )
    for part in range(3):  # each file has a third of every key's reports
        rows.filter(F.pmod("event_id", F.lit(3)) == part).write.parquet(f"{landed}/part={part}")
    stream = streams.landed_stream(spark, f"{landed}/part=*", rows.schema, files_per_batch=1)
    seen: list[int] = []
    sink = streams.merge_batches(store, f"{run_folder(spark)}/kept", merge_batch, "2024-02-01")

    def twice(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        sink(batch, batch_id)
        if batch_id == 2:
            sink(batch, batch_id)

    streams.run_available(stream, f"{run_folder(spark)}/state", each_batch=twice)
    if len(seen) < 3:
        raise RuntimeError("the reports were to come in three batches or more")
    return shown(store.latest())
