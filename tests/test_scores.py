"""Similarity scores on worked examples, and the search cascade."""

import pytest
from pyspark.sql import functions as F

from concord.functions import similarity as sim
from concord.functions.fuzzy import candidate_score, symbol_score
from concord.functions.text import root_symbol
from concord.operators import enrich


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("a,b", [("META", "MET"), ("kitten", "sitting"), ("", "x"), ("", ""), ("abcabc", "cbacba"), ("ß" * 70, "ßa" * 40)])
def test_ratio_counts_the_common_subsequence(a, b):
    total = len(a) + len(b)
    assert sim.ratio(a, b) == pytest.approx(100 * 2 * lcs(a, b) / total if total else 100)


def test_worked_scores():
    assert sim.ratio("META", "MET") == pytest.approx(85.714, abs=1e-3)
    assert sim.token_set_ratio("ACME HOLDINGS", "HOLDINGS ACME INC") == 100
    assert sim.token_set_ratio("", "ACME") == 0
    assert sim.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert sim.token_sort_ratio("new york mets", "mets york new") == 100
    assert sim.partial_ratio("yankees", "new york yankees") == 100
    assert sim.partial_ratio("ab", "ba") == pytest.approx(66.667, abs=1e-3)
    assert sim.weighted_ratio("apple inc", "apple inc") == 100
    assert sim.weighted_ratio("apple", "apple incorporated company") == 90
    assert sim.weighted_ratio("", "apple") == 0
    assert sim.folded(" Melexis N.V.! ") == "melexis n v"


def scores(spark, *pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, s string, n string, es string, en string")
    out = df.select("i", symbol_score(F.col("s"), F.col("es")).alias("s"), candidate_score(F.col("s"), F.col("n"), F.col("es"), F.col("en")).alias("t"))
    return [(r["s"], r["t"]) for r in out.orderBy("i").collect()]


def test_candidate_scores(spark):
    got = scores(
        spark,
        ("MELE.BR", "Melexis NV", "2MELE", "MELEXIS NV"),
        ("MELE.BR", "Unrelated Corp", "2MELE", "MELEXIS NV"),
        ("META", "Meta Platforms Inc", "MET", "MetLife Inc"),
        ("AAP", "Apple Inc", "AAPL", "Apple Inc"),
        ("XYZ", "Apple Inc", "AAPL", "Apple Inc"),
    )
    assert got[0] == (100, 200) and got[1] == (100, 0)
    assert got[2][0] == pytest.approx(85.714, abs=1e-3) and got[2][1] > 155
    assert got[3][1] == pytest.approx(185.714, abs=1e-3) and got[4] == (0, 0)


def ranked(spark, ids, search, **options):
    ids = spark.createDataFrame(ids, "share_class_figi string, symbol string, name string, isin string, cusip string")
    table = spark.createDataFrame(search, "term string, pos int, candidate string, longname string, shortname string, quote_type string")
    rows = enrich.rank_candidates(enrich.search_hits(enrich.with_lookup(ids), table), **options).collect()
    return sorted((r["lookup"], r["level"], r["rank"], r["candidate"]) for r in rows)


def test_first_accepted_level_wins_and_single_hits_need_less(spark):
    ids = [("f1", "AAPL", "Apple Inc", "US1", "C1"), ("f2", "ZZZ", "Zenith", None, "C2"), ("f3", "SOLO", "Solo Ltd", None, None)]
    search = [
        ("US1", 0, "AAP", "Apple Inc", None, "EQUITY"),
        ("US1", 1, "AAPL", "Apple Inc", None, "EQUITY"),
        ("US1", 2, "AAPL.X", "Apple Inc", None, "ETF"),
        ("C1", 0, "AAPL", "Apple Inc", None, "EQUITY"),
        ("C2", 0, "ZZZ.L", None, "Zenit", "EQUITY"),
        ("Zenith", 0, "ZZZ", "Zenith", None, "EQUITY"),
        ("SOLO", 0, "SOLO", "Solo Limited", "Solo Ltd", "EQUITY"),
        ("SOLO", 1, "OTHER", "Solo Ltd", None, "EQUITY"),
    ]
    assert ranked(spark, ids, search) == [
        ("AAPL|US1", 1, 1, "AAPL"),
        ("AAPL|US1", 1, 2, "AAP"),
        ("SOLO|Solo Ltd", 4, 1, "SOLO"),
        ("ZZZ|Zenith", 2, 1, "ZZZ.L"),
    ]


def test_levels_are_not_reconsidered_when_their_quotes_are_invalid(spark):
    ids = spark.createDataFrame([("f1", "AA", "Aa Inc", "US1", None), ("f2", "AA", "Aa Inc", "US1", None)], "share_class_figi string, symbol string, name string, isin string, cusip string")
    search = spark.createDataFrame([("US1", 0, "AA", "Aa Inc", None, "EQUITY"), ("Aa Inc", 0, "AA.B", "Aa Inc", None, "EQUITY")], "term string, pos int, candidate string, longname string, shortname string, quote_type string")
    schema = "quote_symbol string, quote_type string, long_name string, short_name string"
    bad = spark.createDataFrame([("AA", "ETF", "Aa Inc", None), ("AA.B", "EQUITY", "Aa Inc", None)], schema)
    assert enrich.find_quotes(ids, search, bad).isEmpty()
    good = spark.createDataFrame([("AA", "EQUITY", None, "Aa")], schema)
    assert {r["share_class_figi"] for r in enrich.find_quotes(ids, search, good).collect()} == {"f1", "f2"}


def test_injected_key_only_fills_gaps(spark):
    rows = spark.createDataFrame([(None, "g"), ("x", "g")], "share_class_figi string, g string")
    assert [r["share_class_figi"] for r in enrich.inject_key(rows, F.col("g")).collect()] == ["g", "x"]


@pytest.mark.parametrize("symbol, root", [("12AB34", "AB"), ("ab1.2", "AB"), ("77", ""), ("A1\n", "A\n"), ("1A2\u2028", "A\u2028"), ("", ""), (None, None)])
def test_roots(spark, symbol, root):
    assert spark.createDataFrame([(symbol,)], "s string").select(root_symbol(F.col("s"))).first()[0] == root


def test_common_ends_do_not_change_a_score():
    assert (sim.ratio("abcd", "abxcd"), sim.ratio("aa", "aaa"), sim.ratio("abab", "ab")) == (800 / 9, 80.0, 400 / 6)
    assert sim.weighted_ratio("customer 1", "customer 2") == 90.0 and sim.weighted_ratio("b a", "a b") == 95.0
