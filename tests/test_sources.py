"""Landed documents of every feed, from made-up files to checked records."""

import dataclasses
import json
import os
from datetime import datetime, timezone
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from concord.operators.identify import any_identified, no_lookup, responses_to_lookup
from concord.sources import feeds, gates, reference
from concord.sources.landed import merge_maps_last_wins



def now():
    return F.lit("2026-03-10 12:00:00").cast("timestamp")


FRESH, OLD = "2026-03-10T09:00:00Z", "2026-03-01T09:00:00+00:00"


def seconds(text):
    return int(datetime.fromisoformat(text).astimezone(timezone.utc).timestamp())


def land(folder, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "part.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(folder)


def checked(spark, name, path):
    feed = next(f for f in feeds.DISCOVERY_FEEDS if f.name == name)
    rows = feeds.checked_feed(spark, feed, 3, path, now()).orderBy("row_no").collect()
    return rows, {r["symbol"]: r for r in rows if not r["errors"]}


def xetra_row(name, wkn, isin, price, **more):
    row = {
        "name": {"originalValue": name},
        "wkn": wkn,
        "isin": isin,
        "overview": {"lastPrice": price, "dateTimeLastPrice": FRESH},
        "performance": {"weeks52Low": 5, "weeks52High": "20.5", "performance1Year": 12.5},
        "keyData": {"marketCapitalisation": 1e9, "dividendYield": "2.5", "priceBookRatio": None},
        "sustainability": {"x": 1},
    }
    return row | more


def test_xetra(spark, tmp_path):
    stale = {"lastPrice": 9.5, "dateTimeLastPrice": OLD}
    path = land(
        tmp_path / "xetra",
        {
            "page_no": 0,
            "recordsTotal": 6,
            "data": [
                xetra_row("Alpha a.g.", "A1", "DE0000000017", 10.25),
                xetra_row("Alpha copy", "A2", "DE0000000017", 11),
                xetra_row("Beta", "B1", "DE0000000025", "1,5"),
                xetra_row("No isin one", "N1", None, 1),
            ],
        },
        {
            "page_no": 1,
            "data": [
                xetra_row("No isin two", "N2", "", 2),
                xetra_row("Gamma", "G1", "DE0000000033", 0, overview=stale),
                xetra_row("Delta", "D1", "DE00", 3),
            ],
        },
    )
    rows, good = checked(spark, "xetra", path)
    assert [r["symbol"] for r in rows] == ["A1", "B1", "N1", "G1", "D1"]
    assert rows[-1]["errors"] == ["isin"] and rows[-1]["isin"] == "DE00"
    a = good["A1"]
    assert (a["name"], a["mics"], a["currency"], a["feed_rank"]) == ("ALPHA AG", ["XETR"], "EUR", 3)
    assert (a["last_price"], a["market_cap"]) == (D("10.25"), D("1000000000"))
    assert (a["performance_1_year"], a["dividend_yield"]) == (D("0.125"), D("0.025"))
    assert (a["fifty_two_week_max"], a["price_to_book"]) == (D("20.5"), None)
    assert good["B1"]["last_price"] is None and good["B1"]["fifty_two_week_min"] == 5
    g = good["G1"]
    assert (g["last_price"], g["market_cap"], g["fifty_two_week_min"]) == (None, None, None)
    assert g["dividend_yield"] == D("0.025")


def test_lseg(spark, tmp_path):
    def page(no, rows, pages=2):
        search = {"name": "priceexplorersearch", "value": {"totalPages": pages, "content": rows}}
        other = {"name": "else", "value": None}
        parts = [{"type": "banner", "content": []}, {"type": "price-explorer", "content": [other, search]}]
        return {"page_no": no, "components": parts}

    def row(tidm, isin, currency, last, cap=100, low=1, high=3):
        return {
            "issuername": f"{tidm} plc",
            "tidm": tidm,
            "isin": isin,
            "currency": currency,
            "lastprice": last,
            "marketcapitalization": cap,
            "fiftyTwoWeeksMin": low,
            "fiftyTwoWeeksMax": high,
            "other": 1,
        }

    path = land(
        tmp_path / "lseg",
        page(
            0,
            [
                row("PNCE", "GB0000000017", "GBX", "150,5", cap=2000, low=100, high=0),
                row("ZERO", "GB0000000025", "USD", 0, cap=0),
                row("NONE", None, "GBP", 1),
                row("SUBU", "GB0000000033", "GBp", 5),
            ],
        ),
        page(1, [row("PNCE", "GB0000000017", "GBP", 9), row("BARE", "GB0000000041", None, 4)]),
        {"page_no": 2, "components": [{"type": "banner", "content": None}]},
    )
    rows, good = checked(spark, "lseg", path)
    assert {r["symbol"]: r["errors"] for r in rows} == {
        "PNCE": [],
        "ZERO": [],
        "SUBU": ["currency"],
        "BARE": ["currency"],
    }
    p = good["PNCE"]
    assert (p["currency"], p["last_price"], p["market_cap"]) == ("GBP", D("1.505"), 2000)
    assert (p["fifty_two_week_min"], p["fifty_two_week_max"]) == (1, None)
    z = good["ZERO"]
    assert (z["last_price"], z["market_cap"], z["fifty_two_week_max"]) == (None, None, 3)


def test_screener(spark, tmp_path):
    rows = [
        {"s": "brk.b", "n": "Berk Inc", "isin": "US0000000010", "marketCap": "5e3", "price": 4.5, "roe": 20.6, "roa": "n/a"},
        {"s": "AAA", "n": "Triple", "isin": "", "price": 1},
        {"s": "BBB", "n": "Bee", "isin": None, "price": "12 USD"},
        {"s": "AAA", "n": "Triple again", "isin": None, "price": 2},
        {"s": "NEG", "n": "Below", "volume": -1, "revenue": -7},
        None,
        {"s": "", "n": "No symbol"},
    ]
    got, good = checked(spark, "screener", land(tmp_path / "screener", {"data": {"data": rows}}))
    assert {r["name"]: r["errors"] for r in got} == {
        "BERK INC": [],
        "TRIPLE": [],
        "BEE": ["last_price"],
        "BELOW": ["market_volume"],
        "NO SYMBOL": ["symbol"],
    }
    b = good["BRK.B"]
    assert (b["currency"], b["market_cap"], b["last_price"]) == ("USD", 5000, D("4.5"))
    assert (b["return_on_equity"], b["return_on_assets"]) == (D("0.206"), None)


def test_scanner(spark, tmp_path):
    def row(symbol, name, stamp, price=10, **at):
        d = [symbol, name, "NYSE", "USD", price, 1e12, 500, 1.5, None, 100, -5, 3, 9.5, 2, 1, 30, 10, "Tech", "Chips", stamp]
        for k, v in at.items():
            d[int(k[1:])] = v
        return {"s": f"NYSE:{symbol}", "d": d}

    rows = [
        row("ONE", "One Inc", seconds(FRESH)),
        row("OLD", "Old Inc", seconds(OLD), price="oops"),
        row("BAD", "Bad Inc", None, price="oops"),
        row("TXT", "Text time", str(seconds(OLD))),
        row("ONE", "One copy", None),
        {"s": "X", "d": ["X", "short"]},
        row("", "No symbol", None),
        None,
    ]
    got, good = checked(spark, "scanner", land(tmp_path / "scanner", {"totalCount": 8, "data": rows}))
    assert {r["symbol"]: r["errors"] for r in got} == {"ONE": [], "OLD": [], "BAD": ["last_price"], "TXT": []}
    one, old = good["ONE"], good["OLD"]
    assert (one["name"], one["dividend_yield"], one["market_cap"]) == ("ONE INC", D("0.015"), 10**12)
    assert (one["revenue"], one["return_on_equity"], one["industry"]) == (-5, D("0.3"), "CHIPS")
    assert (old["last_price"], old["market_volume"], old["shares_outstanding"]) == (None, None, 100)
    assert good["TXT"]["last_price"] == 10


def test_sec(spark, tmp_path):
    rows = [
        [1234, "First Corp", "FST", "Nasdaq"],
        [1234, "First Corp", "FST-B", "Nasdaq"],
        [99, "Other", "OTH", "Moon"],
        [98, "Nameless", "", "NYSE"],
        [97, "Short", "SHT"],
        [None, "No cik", "NCK", "NYSE"],
        None,
    ]
    got, good = checked(spark, "sec", land(tmp_path / "sec", {"fields": [], "data": rows}))
    assert set(good) == {"FST", "OTH"} and len(got) == 2
    assert (good["FST"]["cik"], good["FST"]["mics"]) == ("0000001234", ["XNAS"])
    assert good["OTH"]["mics"] is None


def test_intrinio(spark, tmp_path):
    root = tmp_path / "intrinio"
    land(
        root / "companies",
        {"page_no": 0, "companies": [{"ticker": "AA", "name": "Aa"}, {"ticker": None, "name": "None"}]},
        {"page_no": 1, "companies": [{"ticker": "BB", "name": "Bb"}, {"ticker": "CC", "name": "Cc"}]},
    )
    company = {"ticker": "AX", "name": "Aa Renamed", "lei": "L" * 18 + "42", "cik": "77"}
    figis = ["BBG000000AA1", "BBG000000AA2", ""]
    land(
        root / "securities",
        {
            "company_ticker": "AA",
            "company": company,
            "securities": [
                {"ticker": f"AA{i}", "share_class_figi": f, "currency": "USD", "exchange_mic": "XNYS" if i else ""}
                for i, f in enumerate(figis)
            ],
        },
        {"company_ticker": "BB", "company": company, "securities": [{"ticker": "BB", "share_class_figi": figis[0]}]},
    )
    land(root / "quotes", {"share_class_figi": figis[0], "quote": {"last": 7.5, "change_percent_365_days": 14.6572, "last_time": FRESH}})
    got, good = checked(spark, "intrinio", str(root))
    assert set(good) == {"AA0", "AA1"} and len(got) == 2
    a = good["AA0"]
    assert (a["name"], a["cik"], a["mics"], a["last_price"]) == ("AA RENAMED", "0000000077", None, D("7.5"))
    assert a["performance_1_year"] == D("0.146572")
    assert (good["AA1"]["mics"], good["AA1"]["last_price"]) == (["XNYS"], None)


def test_one_missing_feed_does_not_stop_the_rest(spark, tmp_path):
    land(tmp_path / "sec", {"data": [[5, "Only", "ONL", "NYSE"]]})
    rows = feeds.read_discovery(spark, str(tmp_path), now()).collect()
    assert [(r["feed"], r["feed_rank"]) for r in rows] == [("sec", 4)]


def test_faulty_pages_are_seen(spark, tmp_path):
    """A truncated page, a gap, a missing first page and a missing page number."""

    def scan(no, *symbols, total=3000):
        rows = [{"s": x, "d": [x, f"{x} corp", None, "USD", *[None] * 16]} for x in symbols]
        return json.dumps({"page_no": no, "totalCount": total, "data": rows})

    def search(no, *rows):
        listed = [{"issuername": f"{r} plc", "tidm": r, "isin": f"GB{i:010d}", "currency": "USD"} for i, r in enumerate(rows, 10 * no)]
        part = {"name": "priceexplorersearch", "value": {"totalPages": 4, "content": listed}}
        return json.dumps({"page_no": no, "components": [{"type": "price-explorer", "content": [part]}]})

    def put(name, *lines):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.json").write_text("\n".join(lines))

    put("scanner", scan(0, "AAA"), scan(1, "BBB")[:-9], scan(2, "CCC"))
    put("lseg", search(0, "ONE"), search(1, "TWO"), search(3, "FOUR"))
    put("xetra", json.dumps({"page_no": 1, "recordsTotal": 150, "data": [xetra_row("N", "WKN", "DE0000000001", 5)]}))
    put("screener", json.dumps({"page_no": 0, "data": {"data": [{"s": "S", "n": "S corp"}]}}), json.dumps({"data": {"data": []}}))
    put("sec", json.dumps({"data": [[5, "Only", "ONL", "NYSE"]]}))
    status = {
        f.name: f.status(f.documents(spark, str(tmp_path / f.name))).first().asDict()
        for f in feeds.DISCOVERY_FEEDS
        if (tmp_path / f.name).exists()
    }
    assert {n: (r["pages"], r["total_pages"], r["unreadable"], r["unnumbered"]) for n, r in status.items()} == {
        "scanner": (2, 3, 1, 0),
        "lseg": (3, 4, 0, 0),
        "xetra": (1, 2, 0, 0),
        "screener": (1, 1, 0, 1),
        "sec": (1, 1, 0, 0),
    }
    assert [n for n, r in status.items() if r["complete"]] == ["sec"]
    rows = feeds.read_discovery(spark, str(tmp_path), now(), keep=str(tmp_path / "kept")).collect()
    assert sorted((r["feed"], r["symbol"]) for r in rows) == [
        ("lseg", "ONE"), ("lseg", "TWO"), ("scanner", "AAA"), ("scanner", "CCC"), ("screener", "S"), ("sec", "ONL"),
    ]
    assert [p.name for p in (tmp_path / "kept").iterdir()] == ["sec"]


def lseg_page(rows, **more):
    part = {"name": "priceexplorersearch", "value": {"totalPages": 1, "content": rows}}
    return {"components": [{"type": "price-explorer", "content": [part]}], **more}


def test_a_single_document_needs_no_page_number(spark, tmp_path):
    rows = [{"issuername": "One plc", "tidm": "ONE", "isin": "GB0000000017", "currency": "USD"}]
    got, good = checked(spark, "lseg", land(tmp_path / "lseg", lseg_page(rows)))
    assert set(good) == {"ONE"}
    two = land(tmp_path / "two", lseg_page(rows), lseg_page(rows, page_no=0))
    feed = next(f for f in feeds.DISCOVERY_FEEDS if f.name == "lseg")
    assert feed.status(feed.documents(spark, two)).first()["unnumbered"] == 1
    assert len(checked(spark, "lseg", two)[0]) == 1


def intrinio(root, securities, quotes):
    land(root / "companies", {"page_no": 0, "companies": [{"ticker": "AA", "name": "Aa"}, {"ticker": "BB", "name": "Bb"}, {"ticker": "AA", "name": "Again"}]})
    land(root / "securities", *securities)
    land(root / "quotes", *quotes)
    return str(root)


def securities_document(ticker, n, currency="USD", symbol="S"):
    listed = [{"ticker": f"{symbol}{i}", "share_class_figi": f"BBG{ticker}{i:07d}", "currency": currency} for i in range(n)]
    return {"company_ticker": ticker, "company": {"ticker": ticker, "name": f"{ticker} corp"}, "securities": listed}


def test_positions_have_no_bounds(spark, tmp_path):
    n = 16_500  # more than once fitted beside the next company's
    path = intrinio(tmp_path / "i", [securities_document("AA", n), securities_document("BB", 2, symbol="T")], [])
    rows, _ = checked(spark, "intrinio", path)
    places = [tuple(r["row_no"]) for r in rows]
    assert len(rows) == n + 2 and len(set(places)) == n + 2 and places == sorted(places)
    assert places[n - 1 :] == [(0, 0, n - 1), (0, 1, 0), (0, 1, 1)]


def test_repeated_documents_multiply_nothing(spark, tmp_path):
    quote = {"share_class_figi": "BBGAA0000000", "quote": {"last": 5, "last_time": "2026-03-10T08:00:00Z"}}
    newer = {"share_class_figi": "BBGAA0000000", "quote": {"last": 7, "last_time": FRESH}}
    path = intrinio(tmp_path / "i", [securities_document("AA", 2)] * 3, [newer, quote, newer, {"share_class_figi": None, "quote": None}])
    rows, good = checked(spark, "intrinio", path)
    assert len(rows) == 2 and good["S0"]["last_price"] == 7 and good["S1"]["last_price"] is None


@pytest.mark.parametrize("part", ["securities", "quotes"])
def test_every_folder_is_gated(spark, tmp_path, part):
    path = intrinio(tmp_path / "in" / "intrinio", [securities_document("AA", 1)], [{"share_class_figi": "BBGAA0000000", "quote": {"last": 5, "last_time": FRESH}}])
    with (tmp_path / "in" / "intrinio" / part / "part.json").open("a") as f:
        f.write('\n{"company_ticker": "BB", "share_cl')
    feed = feeds.DISCOVERY_FEEDS[-1]
    status = feed.status(feed.documents(spark, path)).first()
    assert (status["unreadable"], status["started"], status["complete"]) == (1, True, False)
    rows = feeds.read_discovery(spark, str(tmp_path / "in"), now(), keep=str(tmp_path / "kept"))
    assert rows.count() == 1 and not (tmp_path / "kept").exists()


def test_a_feed_that_fails_while_it_is_read_stops_no_other(spark, tmp_path, caplog):
    land(tmp_path / "sec", {"data": [[5, "Only", "ONL", "NYSE"]]})
    land(tmp_path / "screener", {"data": {"data": [{"s": "S", "n": "S corp"}]}})
    sound = {f.name: f for f in feeds.DISCOVERY_FEEDS}

    def failing(at):
        return {"name": F.raise_error(F.lit("a task broke")).cast("string"), "symbol": F.col("r.s")}

    broken = dataclasses.replace(sound["screener"], fields=failing)
    rows = feeds.read_discovery(spark, str(tmp_path), now(), [broken, sound["sec"]]).collect()
    assert [r["feed"] for r in rows] == ["sec"]
    assert "feed screener skipped" in caplog.text and "a task broke" in caplog.text


def test_newest_rates_document_wins(spark, tmp_path):
    for i, rate in enumerate(("0.9", "0.8")):
        path = tmp_path / "rates" / f"{1 - i}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps({"result": "success", "conversion_rates": {"EUR": float(rate)}}))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    assert [tuple(r) for r in reference.read_rates(spark, str(tmp_path / "rates")).collect()] == [("EUR", D("0.8"))]


def test_empty_feeds_abort(spark):
    counts = spark.createDataFrame([("a", 0), ("b", 0)], "feed string, n bigint")
    with pytest.raises(RuntimeError):
        gates.require_rows(counts)
    gates.require_rows(spark.createDataFrame([("a", 0), ("b", 2)], "feed string, n bigint"))


def test_rates(spark, tmp_path):
    path = land(tmp_path / "fx", {"result": "success", "conversion_rates": {"USD": 1, "EUR": 0.8999, "GBP": 0.1}})
    assert {r["currency"]: r["rate"] for r in reference.read_rates(spark, path).collect()} == {
        "USD": 1,
        "EUR": D("0.8999"),
        "GBP": D("0.1"),
    }
    bad = land(tmp_path / "bad", {"result": "error", "conversion_rates": {"USD": 1}})
    with pytest.raises(Exception, match="does not report success"):
        reference.read_rates(spark, bad).collect()


def test_isin_lei_last_row_wins(spark, tmp_path):
    (tmp_path / "lei").mkdir()
    rows = ["LEI,ISIN", "l1,us1", "L2, US2 ", ",US3", "L4,", "L9,US1"]
    (tmp_path / "lei" / "map.csv").write_text("\n".join(rows))
    table = reference.read_isin_lei(spark, str(tmp_path / "lei"))
    assert sorted((r["isin"], r["lei"]) for r in table.collect()) == [("US1", "L9"), ("US2", "L2")]


def test_quotes_primary_fallback_and_projection(spark, tmp_path):
    primary = land(
        tmp_path / "primary",
        {
            "symbol": "AAA",
            "modules": {
                "price": {"longName": "Aaa Inc", "quoteType": "EQUITY", "currency": "USD", "regularMarketPrice": 9, "regularMarketTime": seconds(FRESH)},
                "summaryDetail": {"dividendYield": 0.01, "volume": 0, "regularMarketVolume": 5},
                "defaultKeyStatistics": {"52WeekChange": None, "trailingEps": 0, "sharesOutstanding": 1e16},
                "financialData": {"currentPrice": 9.5, "recommendationKey": "strong_buy"},
                "esgScores": "not an object",
            },
        },
    )
    fallback = land(
        tmp_path / "fallback",
        {"symbol": "AAA", "results": [{"longName": "Ignored"}]},
        {"symbol": "BBB", "results": [{"shortName": "Bee", "quoteType": "EQUITY", "symbol": "BBB", "dividendYield": 18.62, "fiftyTwoWeekChangePercent": -50, "marketCap": 5, "currency": "EUR", "regularMarketTime": seconds(OLD)}]},
        {"symbol": "CCC", "results": []},
    )
    quotes = reference.read_quotes(spark, primary, fallback)
    assert {r["quote_symbol"] for r in quotes.collect()} == {"AAA", "BBB"}
    ids = reference.with_quote_keys(quotes.select(F.lit("BBG000000001").alias("share_class_figi"), "quote_symbol", "q"))
    rows = reference.enrichment_rows(ids, reference.quote_fields(now()), "quotes", 100).collect()
    by_name = {r["name"]: r for r in rows}
    assert set(by_name) == {"BEE"}  # the primary document carries no symbol
    b = by_name["BEE"]
    assert (b["dividend_yield"], b["performance_1_year"], b["market_cap"]) == (D("0.1862"), D("-0.5"), None)
    flat = ids.filter("quote_symbol = 'AAA'").select(*[c.alias(f) for f, c in reference.quote_fields(now()).items()]).first()
    assert (flat["last_price"], flat["market_volume"], flat["trailing_eps"]) == (D("9.5"), 0, 0)
    assert (flat["dividend_yield"], flat["performance_1_year"]) == (D("0.01"), None)
    assert flat["shares_outstanding"] == 10**16 and flat["analyst_rating"] == "strong_buy"


def test_later_module_wins_even_with_null(spark):
    maps = F.array(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.create_map(F.lit("a"), F.lit(None).cast("string")))
    assert spark.range(1).select(merge_maps_last_wins(maps).alias("m")).first()["m"] == {"a": None, "b": "2"}


def test_search_results(spark, tmp_path):
    path = land(tmp_path / "search", {"query": "US1", "quotes": [{"symbol": "A", "longname": "Aa", "quoteType": "EQUITY"}, {"symbol": "B", "quoteType": "ETF"}]})
    rows = reference.read_search(spark, path).orderBy("pos").collect()
    assert [(r["term"], r["pos"], r["candidate"], r["quote_type"]) for r in rows] == [("US1", 0, "A", "EQUITY"), ("US1", 1, "B", "ETF")]


def test_responses(spark, tmp_path):
    path = land(
        tmp_path / "responses",
        {"batch": "x", "row_no": 1, "query_number": 0, "shareClassFIGI": "BBG000000001", "ticker": "OLD", "name": "Old"},
        {"batch": "x", "row_no": 2, "queryId": 0, "shareClassFIGI": "BBG000000002", "ticker": "NEW", "name": "", "securityName": "New sec"},
        {"batch": "x", "row_no": 3, "query_number": 0, "shareClassFIGI": "bbg000000003", "ticker": "BAD"},
        {"batch": "x", "row_no": 4, "query_number": 9, "shareClassFIGI": "BBG000000004", "ticker": "OUT"},
        {"batch": "y", "row_no": 5, "query_number": 0, "shareClassFIGI": "BBG000000005", "ticker": "TCK"},
        {"batch": "y", "row_no": 6, "query_number": 1, "shareClassFIGI": None, "ticker": "NUL"},
    )
    queries = spark.createDataFrame(
        [("x", 0, "ID_ISIN", "US1"), ("y", 0, "TICKER", "T"), ("y", 1, "TICKER", "N")], reference.QUERY_SCHEMA
    )
    lookup = responses_to_lookup(queries, reference.read_responses(spark, path), ("batch",))
    got = {r["id_value"]: (r["found_name"], r["found_symbol"], r["found_figi"]) for r in lookup.collect()}
    assert got == {"US1": ("New sec", "NEW", "BBG000000002"), "T": ("TCK", "TCK", "BBG000000005")}
    assert any_identified(lookup) and not any_identified(no_lookup(lookup))


def test_page_gate(spark):
    pages = spark.createDataFrame([("a", 0, 3), ("a", 1, 3), ("a", 2, 3), ("b", 0, 3), ("b", 2, 3), ("c", 0, None)], "feed string, page int, total int")
    status = {r["feed"]: (r["pages"], r["complete"]) for r in gates.page_status(pages, ["feed"], "page", "total").collect()}
    assert status == {"a": (3, True), "b": (2, False), "c": (1, True)}
    kept = gates.before_gap(pages, ["feed"], "page")
    assert sorted((r["feed"], r["page"]) for r in kept.collect()) == [("a", 0), ("a", 1), ("a", 2), ("b", 0), ("c", 0)]
    late = pages.filter("page > 0")
    assert gates.before_gap(late, ["feed"], "page").isEmpty()


def test_only_whole_feeds_are_kept(spark, tmp_path):
    pages = spark.createDataFrame([("a", 0, 2), ("a", 1, 2)], "feed string, page int, total int")

    def kept(rows, name):
        status = gates.page_status(rows, ["feed"], "page", "total")
        return gates.keep_if_whole(rows, status, str(tmp_path / name))

    assert kept(pages, "whole") and spark.read.parquet(str(tmp_path / "whole")).count() == 2
    assert not kept(pages.filter("page = 0"), "part") and not (tmp_path / "part").exists()
    assert not kept(pages.filter("page = 9"), "none") and not (tmp_path / "none").exists()
