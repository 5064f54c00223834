"""The whole job on made-up feeds, and the store behind it."""

import datetime
import json
import os
from decimal import Decimal as D

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.operators import fx
from concord.operators.identify import identify, no_lookup
from concord.operators.validate import accepted, error_counts, quarantined, revalidated, validate
from concord.plans import build, report
from concord.plans.lookup import CachedLookup
from concord.plans.store import Store, ttl_seconds
from concord.schema import AMOUNT, CANONICAL_SCHEMA, RAW_SCHEMA
from concord.sources import reference
from concord.streaming import streams
from tests.test_sources import FRESH, land, now, seconds

FIGI = "BBG000000AAA"


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    quote = {"lastPrice": 10.0, "dateTimeLastPrice": FRESH}
    land(
        root / "feeds" / "xetra",
        {"data": [{"name": {"originalValue": "Acme Holdings Inc."}, "wkn": "ACM", "isin": "US0000000019", "overview": quote, "performance": {"weeks52Low": 5, "weeks52High": 12}}]},
    )
    land(
        root / "feeds" / "screener",
        {"data": {"data": [{"s": "ACME", "n": "Acme Holdings", "isin": "US0000000019", "price": 11.0, "marketCap": 1000, "sector": "Tech"}, {"s": "LOST", "n": "Unknown", "price": 1}]}},
    )
    land(root / "feeds" / "sec", {"data": [[42, "ACME HOLDINGS INC", "ACME", "NYSE"], [43, "Other Corp", "OTHR", "NYSE"]]})
    land(root / "rates", {"result": "success", "conversion_rates": {"EUR": 0.8, "USD": 1}})
    land(root / "search", {"query": "US0000000019", "quotes": [{"symbol": "ACME.X", "longname": "Acme Holdings", "quoteType": "EQUITY"}]})
    module = {"symbol": "ACME.X", "longName": "Acme Holdings", "quoteType": "EQUITY", "currency": "EUR", "regularMarketPrice": 9.2, "fiftyTwoWeekLow": 4, "fiftyTwoWeekHigh": 9.6, "marketCap": 880, "regularMarketTime": seconds(FRESH), "52WeekChange": 0.5, "sharesOutstanding": 100, "sector": "TECH", "recommendationKey": "buy"}
    land(root / "quotes", {"symbol": "ACME.X", "modules": {"price": module}})
    (root / "lei").mkdir()
    (root / "lei" / "a.csv").write_text("LEI,ISIN\n" + "A" * 18 + "42,us0000000019\n")
    return root


@pytest.fixture(scope="module")
def inputs(spark, landed):
    lookup = spark.createDataFrame(
        [
            ("ID_ISIN", "US0000000019", "Acme Holdings Inc", "ACME", FIGI),
            ("TICKER", "ACME", "", None, FIGI),
            ("TICKER", "OTHR", None, "OTH/R", "BBG000000BBB"),
            ("TICKER", "LOST", None, None, None),
        ],
        "id_type string, id_value string, found_name string, found_symbol string, found_figi string",
    )
    return build.Inputs(
        raw=build.read_inputs(spark, str(landed / "feeds"), now()),
        rates=reference.read_rates(spark, str(landed / "rates")),
        lookup=lookup,
        enrichment=(
            build.quote_feed(
                reference.read_search(spark, str(landed / "search")),
                reference.read_quotes(spark, str(landed / "quotes")),
            ),
            build.lei_feed(reference.read_isin_lei(spark, str(landed / "lei"))),
        ),
    )


@pytest.fixture(scope="module")
def canonical(inputs):
    return build.build(inputs, now())


def test_build_makes_golden_records(canonical):
    assert canonical.schema["identity"].dataType.names == CANONICAL_SCHEMA["identity"].dataType.names
    rows = {r["share_class_figi"]: r for r in build.flattened(canonical).collect()}
    assert set(rows) == {FIGI, "BBG000000BBB"}
    a = rows[FIGI]
    # xetra 12.5 / 6.25-15, screener 11 without a range, quote 11.5 / 5-12, all in dollars
    assert (a["name"], a["symbol"], a["isin"], a["cik"]) == ("ACME HOLDINGS INC", "ACME", "US0000000019", "0000000042")
    assert (a["lei"], a["currency"], a["mics"]) == ("A" * 18 + "42", "USD", ["XETR", "XNYS"])
    assert (a["last_price"], a["fifty_two_week_min"], a["fifty_two_week_max"]) == (D("11.5"), 5, 12)
    assert (a["market_cap"], a["shares_outstanding"], a["performance_1_year"]) == (1000, 100, None)
    assert (a["sector"], a["analyst_rating"]) == ("TECH", "BUY")
    b = rows["BBG000000BBB"]
    assert (b["name"], b["symbol"], b["currency"], b["last_price"]) == ("OTHER CORP", "OTH/R", None, None)


def test_build_without_enrichment_or_lookup(inputs):
    bare = build.Inputs(inputs.raw, inputs.rates)
    assert build.build(bare, now()).count() == 0


def test_only_unknown_keys_are_asked_for(spark, inputs, canonical, tmp_path):
    asked = []

    def ask(queries):
        asked.append(sorted((r["id_type"], r["id_value"]) for r in queries.collect()))
        return queries.join(inputs.lookup.union(inputs.lookup), ["id_type", "id_value"]).drop("security_type")

    cached = CachedLookup(spark, str(tmp_path / "ids"), ask, ttl=3600)
    with_cache = build.Inputs(inputs.raw, inputs.rates, cached, inputs.enrichment)
    for _ in range(2):
        assert sorted(map(str, build.build(with_cache, now()).collect())) == sorted(map(str, canonical.collect()))
    assert asked == [[("ID_ISIN", "US0000000019"), ("TICKER", "ACME"), ("TICKER", "LOST"), ("TICKER", "OTHR")], [("TICKER", "LOST")]]
    assert cached.entries().count() == 3
    build.build(with_cache, F.lit("2026-03-10 14:00:00").cast("timestamp")).collect()
    assert len(asked[2]) == 4  # two hours later all have expired


def test_nothing_found_is_not_kept(spark, tmp_path):
    queries = spark.createDataFrame([("TICKER", "A", "Common Stock")], "id_type string, id_value string, security_type string")
    down = CachedLookup(spark, str(tmp_path / "ids"), lambda q: no_lookup(q))
    assert down.resolve(queries, now()).count() == 0 and down.entries().isEmpty()


def test_repeated_lookup_keys_multiply_nothing(spark):
    lookup = spark.createDataFrame([("TICKER", "A", "n", "s", None), ("TICKER", "A", "n", "s", FIGI), ("TICKER", "A", "n", "s", FIGI)], "id_type string, id_value string, found_name string, found_symbol string, found_figi string")
    rows = spark.createDataFrame([(None, None, "A", "name", None)], "isin string, cusip string, symbol string, name string, share_class_figi string")
    assert [r["share_class_figi"] for r in identify(rows, lookup).collect()] == [FIGI]


def test_stage_counters(spark, inputs):
    converted, identified = Observation("c"), Observation("i")
    usd = fx.to_usd(accepted(inputs.raw), inputs.rates, counters=converted)
    identify(usd, inputs.lookup, counters=identified).collect()
    assert converted.get == {"converted": 5, "skipped": 0}
    assert identified.get == {"identified": 4, "failed": 1}


def test_payload_round_trip(canonical):
    back = build.from_payloads(build.payloads(canonical))
    assert sorted(map(str, back.collect())) == sorted(map(str, canonical.collect()))


def test_seed_and_retrieve(spark, inputs, canonical, tmp_path):
    store = build.record_store(spark, str(tmp_path / "store"))
    assert store.is_stale() and not store.has_rows("identities")
    ran = []
    assert store.ensure_fresh(lambda: ran.append(build.seed(spark, inputs, store, now())))
    assert ran == [None] and not store.is_stale() and store.has_rows("snapshots")
    assert not store.ensure_fresh(lambda: ran.append(1))
    latest = store.latest().drop("snapshot_date").select(*build.flattened(canonical).columns)
    assert sorted(map(str, latest.collect())) == sorted(map(str, build.flattened(canonical).collect()))
    figures = report.key_figures(store.identities(), store.snapshots()).first()
    assert (figures["equities"], figures["venues"], figures["aggregate_cap"]) == (2, 2, "$1,000")
    assert report.key_figures(store.identities(), store.snapshots(), dates=store.dates()).first() == figures
    covered = {r["field"]: r["populated"] for r in report.coverage_table(store.identities()).collect()}
    assert covered == {"name": 100, "symbol": 100, "share class figi": 100, "isin": 50, "cusip": 0, "cik": 100, "lei": 50}


@pytest.fixture
def prices(spark, tmp_path):
    key = T.StructField("k", T.StringType())
    facts = T.StructType([key, T.StructField("p", T.IntegerType()), T.StructField("snapshot_date", T.DateType())])
    return Store(spark, str(tmp_path / "s"), T.StructType([key, T.StructField("n", T.StringType())]), facts, key="k", buckets=4)


def rows_of(df):
    return sorted((r["k"], r["n"], r["p"], str(r["snapshot_date"])) for r in df.collect())


def test_store_upserts_and_keeps_what_a_batch_leaves_out(spark, prices):
    def batch(*rows):
        return spark.createDataFrame(rows, "k string, n string, p int")

    prices.save(batch(("a", "A", 1), ("b", "B", 2)), "2026-01-01")
    prices.save(batch(("a", "A2", 3)), "2026-01-02")
    prices.save(batch(("a", "A3", 4)), "2026-01-02")
    prices.save(batch(("a", "A3", 4)), "2026-01-02")
    prices.save(batch(("c", "C", 9)), "2026-01-01")
    assert rows_of(prices.latest()) == [("a", "A3", 4, "2026-01-02"), ("b", "B", 2, "2026-01-01"), ("c", "C", 9, "2026-01-01")]
    assert rows_of(prices.by_key("a")) == [("a", "A3", 4, "2026-01-02")]
    assert prices.by_key("zz").isEmpty()
    for read in (prices.by_key, prices.history):
        with pytest.raises(LookupError, match="zz"):
            read("zz", required=True)
    assert rows_of(prices.history("a")) == [("a", "A3", 1, "2026-01-01"), ("a", "A3", 4, "2026-01-02")]
    assert rows_of(prices.history("a", "2026-01-02")) == rows_of(prices.history("a", to_date="2026-01-02"))[1:]
    assert prices.history("a", "2026-01-03").isEmpty()
    assert prices.count_snapshots() == 2
    prices.save(batch(("a", "A4", 7)), "2025-12-31")  # an older date renames, the newest facts stay
    assert rows_of(prices.by_key("a")) == [("a", "A4", 4, "2026-01-02")]


def test_reads_open_only_their_folders(spark, prices):
    rows = [(f"k{i:03d}", f"n{i}", i, datetime.date(2026, 1, 1 + i % 5)) for i in range(200)]
    prices.save(spark.createDataFrame(rows, "k string, n string, p int, snapshot_date date"))
    own = prices.bucket_of("k007")

    def folders(df):
        return {tuple(f.split("/")[-4:-1]) for f in df.inputFiles()}

    assert {f[-1] for f in folders(prices.by_key("k007"))} == {f"key_bucket={own}"}
    history = prices.view().snapshots("2026-01-02", "2026-01-04", [own])
    assert {f[-2:] for f in folders(history)} == {(f"snapshot_date=2026-01-0{d}", f"key_bucket={own}") for d in (2, 3, 4)}
    assert rows_of(prices.history("k007")) == [("k007", "n7", 7, "2026-01-03")]
    plan = prices.latest()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and prices.latest().count() == 200
    assert [r[0] for r in prices.dates().collect()] == [datetime.date(2026, 1, d) for d in range(1, 6)]


def test_both_tables_change_together(spark, prices, monkeypatch):
    def batch(*rows):
        return spark.createDataFrame(rows, "k string, n string, p int")

    prices.save(batch(("a", "A", 1), ("b", "B", 2)), "2026-01-01")
    before = prices.view()
    whole = Store._write

    def broken(self, table, *rest):
        if table == "current":
            raise OSError("no space left")
        whole(self, table, *rest)

    monkeypatch.setattr(Store, "_write", broken)
    with pytest.raises(OSError, match="no space"):
        prices.save(batch(("a", "A2", 5), ("c", "C", 3)), "2026-01-02")
    monkeypatch.setattr(Store, "_write", whole)
    assert rows_of(prices.latest()) == [("a", "A", 1, "2026-01-01"), ("b", "B", 2, "2026-01-01")]
    assert prices.view().dates() == ["2026-01-01"] and prices.versions() == [1]
    prices.save(batch(("a", "A2", 5), ("c", "C", 3)), "2026-01-02")
    assert rows_of(prices.latest()) == [("a", "A2", 5, "2026-01-02"), ("b", "B", 2, "2026-01-01"), ("c", "C", 3, "2026-01-02")]
    assert rows_of(before.latest()) == [("a", "A", 1, "2026-01-01"), ("b", "B", 2, "2026-01-01")]  # a reader keeps its pair
    assert before.snapshots().count() == 2 and prices.view(1).snapshots().count() == 2


def test_a_second_writer_is_told(spark, prices, monkeypatch):
    rows = spark.createDataFrame([("a", "A", 1)], "k string, n string, p int")
    empty = prices.view()
    prices.save(rows, "2026-01-01")
    monkeypatch.setattr(Store, "view", lambda self, version=None: empty)
    with pytest.raises(FileExistsError, match="another writer"):
        prices.save(rows.withColumn("p", F.lit(2)), "2026-01-01")
    monkeypatch.undo()
    assert rows_of(prices.latest()) == [("a", "A", 1, "2026-01-01")]


def test_vacuum_keeps_what_is_named(spark, prices):
    def batch(*rows):
        return spark.createDataFrame(rows, "k string, n string, p int")

    for i in range(4):
        prices.save(batch(("a", "A", i), ("b", "B", 9)) if i == 0 else batch(("a", "A", i)), "2026-01-01")
    want = rows_of(prices.latest()), prices.snapshots().count()
    assert prices.vacuum(keep=1) and prices.versions() == [4]
    assert (rows_of(prices.latest()), prices.snapshots().count()) == want and prices.vacuum(keep=1) == []


def test_a_save_evaluates_its_batch_once_and_needs_dates(spark, prices):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(p):
        calls.add(1)
        return p

    rows = spark.createDataFrame([(f"k{i}", "N", i) for i in range(100)], "k string, n string, p int")
    prices.save(rows.withColumn("p", counted("p")), "2026-01-01")
    assert calls.value == 100 and prices.latest().count() == 100
    with pytest.raises(ValueError, match="no snapshot date"):
        prices.save(rows.withColumn("snapshot_date", F.lit(None).cast("date")))


def test_two_rates_for_a_currency_are_an_error(spark):
    rows = spark.createDataFrame([("EUR", D(9))], "currency string, p decimal(28,10)")
    rates = spark.createDataFrame([("EUR", D("0.9")), ("EUR", D("0.9"))], "currency string, rate decimal(18,8)")
    assert fx.to_usd(rows, rates, ["p"]).count() == 1
    clash = rates.union(spark.createDataFrame([("EUR", D("0.8"))], rates.schema))
    with pytest.raises(Exception, match="two rates for currency EUR"):
        fx.to_usd(rows, clash, ["p"]).collect()


def test_failed_save_changes_nothing(spark, prices):
    good = spark.createDataFrame([("a", "A", 1)], "k string, n string, p int")
    prices.save(good, "2026-01-01")
    bad = good.withColumn("p", F.raise_error(F.lit("broken row")).cast("int"))
    with pytest.raises(Exception, match="broken row"):
        prices.save(bad, "2026-01-01")
    assert rows_of(prices.latest()) == [("a", "A", 1, "2026-01-01")]


def test_ttl_setting():
    assert (ttl_seconds(), ttl_seconds(0)) == (86400, 0)
    with pytest.raises(ValueError):
        ttl_seconds(-1)


def test_ttl_zero_switches_staleness_off(prices):
    assert prices.is_stale() and not prices.is_stale(ttl_minutes=0)


def test_dollar_amounts(spark):
    rates = spark.createDataFrame([("EUR", D("0.8999")), ("ZZZ", D("0")), ("NEG", D("-1"))], f"currency string, rate decimal(18,8)")
    rows = [("a", "EUR", D("6.47")), ("b", "USD", D("1.23456")), ("c", None, None), ("d", "QQQ", None), ("e", "ZZZ", D(1)), ("f", "ZZZ", None), ("g", "NEG", D(5))]
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("currency", T.StringType()), T.StructField("p", AMOUNT)])
    df = spark.createDataFrame(rows, schema)
    kept = {r["id"]: (r["currency"], r["p"]) for r in fx.to_usd(df, rates, ["p"]).collect()}
    assert kept == {"a": ("USD", D("7.1897")), "b": ("USD", D("1.23456")), "c": (None, None), "f": ("USD", None)}
    assert {r["id"] for r in fx.without_rate(df, rates, ["p"]).collect()} == {"d", "e", "g"}


def test_validation_tells_null_from_rejection(spark):
    row = {f: None for f in RAW_SCHEMA.names}
    rows = [
        row | {"row_no": (0, 1, 0), "name": "u.s. Steel-Co", "symbol": " x  y.b ", "analyst_rating": "Strong_Sell", "mics": []},
        row | {"row_no": (0, 2, 0), "name": "A", "symbol": "B", "last_price": D(1)},
        row | {"row_no": (0, 3, 0), "name": "...", "symbol": "B"},
        row | {"row_no": (0, 4, 0), "name": "A", "symbol": "B", "currency": "GBp", "market_cap": D(-1)},
        row | {"row_no": (0, 5, 0), "name": "A", "symbol": "B", "isin": "US1", "cik": "..", "mics": ["XNYS", "bad mic"]},
        row | {"row_no": (0, 6, 0), "name": "A", "symbol": "B", "share_class_figi": FIGI.lower(), "cik": "7", "ebitda": D(-3), "currency": "eur"},
    ]
    df = validate(spark.createDataFrame([[r[f] for f in RAW_SCHEMA.names] for r in rows], RAW_SCHEMA))
    got = {r["row_no"]["position"]: r for r in df.collect()}
    assert {k: r["errors"] for k, r in got.items()} == {
        1: [],
        2: ["currency"],
        3: ["name"],
        4: ["currency", "market_cap"],
        5: ["isin", "cik", "mics"],
        6: [],
    }
    assert (got[1]["name"], got[1]["symbol"], got[1]["analyst_rating"], got[1]["mics"]) == ("US STEEL CO", "X Y.B", "SELL", None)
    assert (got[6]["cik"], got[6]["currency"], got[6]["share_class_figi"]) == ("0000000007", "EUR", FIGI)
    assert accepted(df).count() == 2 and quarantined(df).count() == 4
    assert {r["field"]: r["n"] for r in error_counts(df).collect()} == {"currency": 2, "name": 1, "market_cap": 1, "isin": 1, "cik": 1, "mics": 1}
    assert [r["row_no"]["position"] for r in revalidated(df.drop("errors")).collect()] == [6]


def test_stream_replays_change_nothing(spark, prices, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i, rows in enumerate([[("a", "A", 1), ("a", "A", 1)], [("a", "A9", 5), ("b", "B", 2)]]):
        text = "\n".join(json.dumps(dict(zip("knp", r))) for r in rows)
        (folder / f"{i}.json").write_text(text)
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    rows = streams.landed_stream(spark, str(folder), "k string, n string, p int", "json", files_per_batch=1)
    def newest(reports):  # a key's reports come in two batches; both must be seen
        return reports.groupBy("k").agg(F.max_by("n", "p").alias("n"), F.sum("p").cast("int").alias("p"))

    sink = streams.merge_batches(prices, str(tmp_path / "reports"), newest, "2026-01-05")
    streams.run_available(rows, str(tmp_path / "state"), each_batch=sink)
    expected = [("a", "A9", 7, "2026-01-05"), ("b", "B", 2, "2026-01-05")]
    assert rows_of(prices.latest()) == expected
    streams.run_available(rows, str(tmp_path / "state"), each_batch=sink)
    assert rows_of(prices.latest()) == expected
