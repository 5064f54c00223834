"""Merge rules against brute force in plain Python, array and distributed forms."""

import random
import re
from collections import Counter
from decimal import Decimal
from statistics import median, median_low

import pytest
from pyspark.sql import types as T

from concord.functions.fuzzy import heaviest_leader
from concord.functions.similarity import token_set_ratio
from concord.operators import votes, clusters, golden, ranks, wide
from concord.operators.golden import FUZZY, MODE, PAIR, SINGLE, TIGHT_PAIR, UNION, PriceRange
from concord.schema import AMOUNT
from concord.session import stage

RULES = {
    "name": FUZZY,
    "code": MODE,
    "mics": UNION,
    "last": TIGHT_PAIR,
    "low": TIGHT_PAIR,
    "high": TIGHT_PAIR,
    "margin": SINGLE,
    "volume": PAIR,
}
RANGE = PriceRange("last", "low", "high")
SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("code", T.StringType()),
        T.StructField("mics", T.ArrayType(T.StringType())),
        *[T.StructField(f, AMOUNT) for f in ("last", "low", "high", "margin", "volume")],
    ]
)


def expected_median(values, spec):
    if spec.max_deviation is not None and len(values) >= 2:
        band, mid = Decimal(spec.max_deviation), median(values)
        if mid != 0:
            values = [v for v in values if abs(v - mid) < band * abs(mid)]
        else:
            scale = median([abs(v) for v in values])
            values = [v for v in values if scale == 0 or abs(v) < band * scale]
    return median_low(values) if values and len(values) >= spec.min_sources else None


def expected_group(rows):
    out = {}
    for field in ("last", "low", "high", "margin", "volume"):
        out[field] = expected_median([r[field] for r in rows if r[field] is not None], RULES[field])
    codes = [r["code"] for r in rows if r["code"] is not None]
    top = max(Counter(codes).values(), default=0)
    out["code"] = next((c for c in codes if Counter(codes)[c] == top), None)
    mics = [m for r in rows for m in r["mics"] or [] if m and m.strip()]
    out["mics"] = list(dict.fromkeys(mics)) or None
    out["name"] = heaviest_leader([r["name"] for r in rows if r["name"] is not None], 90)
    full = [r for r in rows if None not in (r["last"], r["low"], r["high"])]
    good = [
        r
        for r in full
        if r["low"] <= r["high"]
        and r["low"] * Decimal("0.9") <= r["last"] <= r["high"] * Decimal("1.1")
    ]
    if len(good) >= 2:
        out |= {f: median_low([r[f] for r in good]) for f in ("last", "low", "high")}
    elif out["low"] is not None and out["high"] is not None and out["low"] > out["high"]:
        out["low"] = out["high"] = None
    return out


def make_rows(seed, sizes):
    rng = random.Random(seed)
    names = ["ACME HOLDINGS", "ACME HOLDINGS INC", "ACME HOLDING", "ZENITH GROUP", "ZENITH", "", None]

    def number(lo, hi):
        return None if rng.random() < 0.2 else Decimal(rng.randint(lo, hi)) / 4

    rows = []
    for k, size in enumerate(sizes):
        for i in range(size):
            low = number(30, 60)
            rows.append(
                {
                    "key": f"k{k}",
                    "ord": i,
                    "name": rng.choice(names),
                    "code": rng.choice(["A", "B", "C", None]),
                    "mics": rng.choice([None, [], ["XNAS"], ["XLON", " ", "XNAS"], ["XETR", None]]),
                    "last": number(35, 80),
                    "low": low,
                    "high": number(30, 90),
                    "margin": number(-8, 8),
                    "volume": number(0, 40),
                }
            )
    rng.shuffle(rows)
    return rows


def collected(df):
    return {r["key"]: {f: r[f] for f in RULES} for r in df.collect()}


@pytest.fixture(scope="module")
def data(spark):
    rows = make_rows(5, [1, 1, 2, 2, 3, 3, 4, 5, 6, 7, 8, 9, 12, 40, 90])
    df = spark.createDataFrame([[r[f] for f in SCHEMA.names] for r in rows], SCHEMA)
    groups = {}
    for r in sorted(rows, key=lambda r: r["ord"]):
        groups.setdefault(r["key"], []).append(r)
    return df, {k: expected_group(g) for k, g in groups.items()}


def test_array_merge_equals_brute_force(data):
    df, expected = data
    assert collected(golden.merge(df, "key", RULES, ["ord"], RANGE)) == expected


def test_distributed_merge_equals_brute_force(data):
    df, expected = data
    assert collected(wide.merge_wide(df, "key", RULES, ["ord"], RANGE)) == expected


def test_merge_sends_only_oversize_groups_to_the_distributed_form(data):
    df, expected = data
    ordinary, oversize = golden.split_by_size(df, "key", 20)
    assert {r["key"] for r in oversize.select("key").distinct().collect()} == {"k13", "k14"}
    assert ordinary.count() + oversize.count() == df.count()
    assert collected(golden.merge(df, "key", RULES, ["ord"], RANGE, group_limit=20)) == expected


@pytest.mark.parametrize("parts", [1, 7])
def test_ranks_of_heavy_values_and_null_groups(spark, parts):
    rng = random.Random(3)
    groups = {
        "hot": [rng.choice([rng.randint(0, 50), rng.randint(0, 10**6)]) for _ in range(5000)],
        "heavy": [5] * 3000 + [1] * 3 + [9] * 3,
        None: [4, 2, 8],
        "cold": [7],
    }
    rows = [(g, Decimal(v)) for g, values in groups.items() for v in values] + [("none", None), (None, None)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("g", T.StringType()), T.StructField("v", AMOUNT)]))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    wanted = {"a": "0", "b": "(n - 1) div 2", "c": "n div 2", "d": "n - 1"}
    try:
        picked = ranks.pick_ranks(df, ["g"], "v", wanted).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = {r["g"]: (r["n"], int(r["a"]), int(r["b"]), int(r["c"]), int(r["d"])) for r in picked}
    want = {}
    for g, values in groups.items():
        s, n = sorted(values), len(values)
        want[g] = (n, s[0], s[(n - 1) // 2], s[n // 2], s[-1])
    assert got == want


@pytest.mark.parametrize("limit", [1, 3, 10**9])
def test_merge_is_the_same_at_every_group_size(spark, limit):
    """Two types per rule, repeated order values, groups on both sides of the limit."""
    schema = "key string, ord int, a string, b bigint, c array<string>, d string, m decimal(18,2), w decimal(28,10)"
    rng = random.Random(11)
    rows = [
        (
            f"k{k}",
            rng.randint(0, 2),
            rng.choice(["x", "y", None]),
            rng.choice([1, 2, 3, None]),
            rng.choice([None, ["p", "q"], ["q", "r"]]),
            rng.choice(["ACME", "ZENITH", "ORBIT LTD"]),
            Decimal(rng.randint(0, 9)),
            Decimal(rng.randint(0, 9)),
        )
        for k in range(8)
        for _ in range(k + 1)
    ]
    df = spark.createDataFrame(rows, schema)
    rules = {"a": MODE, "b": MODE, "c": UNION, "d": FUZZY, "m": SINGLE, "w": PAIR}
    got = golden.merge(df, "key", rules, ["ord"], None, group_limit=limit)
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        (n, df.schema[n].dataType.simpleString()) for n in ("key", *rules)
    ]
    for r in got.collect():
        mine = [dict(zip(["key", "ord", "a", "b", "c", "d", "m", "w"], x)) for x in rows if x[0] == r["key"]]
        for f in ("a", "b"):
            have = [x[f] for x in mine if x[f] is not None]
            best = min(
                set(have), key=lambda v: (-have.count(v), min(x["ord"] for x in mine if x[f] == v), v), default=None
            )
            assert r[f] == best
        lists = [x["c"] for x in sorted((x for x in mine if x["c"]), key=lambda x: (x["ord"], x["c"]))]
        assert r["c"] == (list(dict.fromkeys(e for c in lists for e in c)) or None)
        assert r["d"] == heaviest_leader([x["d"] for x in sorted(mine, key=lambda x: (x["ord"], x["d"]))], 90)
        assert r["m"] == expected_median([x["m"] for x in mine], SINGLE)
        assert r["w"] == expected_median([x["w"] for x in mine], PAIR)


def made_up_names(rng, n):
    words = ["alpha", "beta", "gamma", "delta", "omega", "sigma", "kappa", "inc", "corp", "of", "the", "a", "international", "holdings"]
    out = []
    for _ in range(n):
        chosen = [rng.choice(words) for _ in range(rng.randint(1, 5))]
        text = list(" ".join(chosen))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):  # slips of the pen, within and between words
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "e", " ", "é"])
        out.append("".join(text))
    return out + ["", " ", "  ", "", "x\u00a0y", "y x", "a\x1cb", "b a"]


def test_clusters_equal_the_leader_rule(spark):
    rng = random.Random(9)
    rows = [(g, i, t) for g, n in (("g", 700), (None, 60), ("h", 1)) for i, t in enumerate(made_up_names(rng, n))]
    df = spark.createDataFrame(rows + [("z", 1, None)], "g string, o int, t string")
    want = {g: [t for h, _, t in rows if h == g] for g in ("g", None, "h")}
    for heads in (1, 64):
        got = {r["g"]: (r["chosen"], r["sources"]) for r in clusters.fuzzy_wide(df, ["g"], "t", ["o"], heads=heads).collect()}
        assert got == {g: (heaviest_leader(texts, 90), len(texts)) for g, texts in want.items()}


def test_all_names_in_one_group(spark):
    from concord.queries import REGISTRY
    from concord.queries.merging import all_names

    sf = "/root/testdata/sf0.001"
    names = [r["name"] for r in all_names(spark, sf).orderBy("kind", "key").collect()]
    got = REGISTRY["fuzzy_names_one_group"].build(spark, sf).first()
    assert (got["name"], got["sources"]) == (heaviest_leader(names, 90), len(names))


@pytest.mark.parametrize("threshold", [70, 80, 90, 97])
def test_no_match_is_missed(spark, threshold):
    texts = sorted(set(made_up_names(random.Random(threshold), 250)))
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "g string, id long, text string")
    nodes = df.withColumn("p", clusters._parts("text")).select("g", "id", "text", "p.*")
    pairs = {(r["a"], r["b"]) for r in clusters.candidates(nodes, threshold).select("a", "b").collect()}
    want = {(i, j) for j, t in enumerate(texts) for i in range(j) if token_set_ratio(texts[i], t) >= threshold}
    assert want <= pairs and len(want) > 20
    assert len(pairs) < len(texts) ** 2 / (4 if threshold >= 90 else 2)


def test_numbered_names_meet_only_where_they_match(spark):
    texts = [f"Customer#{i:09d}" for i in (*range(0, 900, 3), 1000, 12345, 21345)] + ["Customer#0000012", "Customer# 000000012", "Customer#0000000123"]
    df = spark.createDataFrame([("g", i, t) for i, t in enumerate(texts)], "g string, id long, text string")
    nodes = df.withColumn("p", clusters._parts("text")).select("g", "id", "text", "p.*")
    pairs = {(r["a"], r["b"]) for r in clusters.candidates(nodes, 90).collect()}
    want = {(i, j) for j, t in enumerate(texts) for i in range(j) if token_set_ratio(texts[i], t) >= 90}
    assert want <= pairs and len(pairs - want) < 10 and len(want) < len(texts) ** 2 / 4


def test_leaders_are_peeled_in_order(spark):
    edges = [(i, i + 1) for i in range(9)] + [(20, 21), (20, 22), (21, 22), (30, 32), (31, 32)]
    frame = spark.createDataFrame(edges, "early long, late long")
    for most in (0, 8, 100):
        led = clusters.peeled(frame, most).collect()
        assert {r["late"]: r["leader"] for r in led} == {1: 0, 3: 2, 5: 4, 7: 6, 9: 8, 21: 20, 22: 20, 32: 30}


def numbered_nodes(spark, texts):
    """Staged nodes of groups ``g``; ids rise with the place in ``texts``."""
    df = spark.createDataFrame([(g, i, t) for i, (g, t) in enumerate(texts)], "g string, id long, text string")
    return stage(df.withColumn("p", clusters._parts("text")).select("g", "id", "text", "p.*"))


@pytest.mark.parametrize("limits", [{}, {"nodes_in_one_task": 150, "in_one_task": 60, "most_kept": 1200, "tried_in_one_task": 30, "block_bits": 1}])
def test_numbered_names_are_decided_in_order(spark, limits):
    """Leaders of each group by visiting one by one, whatever a round takes."""
    rng = random.Random(4)
    names = [f"Customer#{i:09d}" for i in rng.sample(range(3000), 260)] + [f"old {rng.choice('abc')}{i % 7}x" for i in range(40)]
    names += ["Customer# 000000012", "Customer#0000012", "old", "oldax", "Customer#000000012 ltd"]
    rng.shuffle(names)
    texts = [(g, t) for g, some in (("a", names), (None, names[:80]), ("b", ["lone"])) for t in dict.fromkeys(some)]
    partners = clusters.with_partners(numbered_nodes(spark, texts))
    partners = partners.withColumn("g", partners["gid"])
    near = clusters.compared(partners, 90).filter(clusters._matches(90)("a_text", "b_text"))
    edges = stage(near.selectExpr("g", "a AS early", "b AS late").distinct())
    nodes = stage(partners.selectExpr("g", "id", "array_join(tokens, ' ') AS text", "single", "others"))
    got = {r["id"]: r["leader"] for r in clusters.decided(nodes, edges, 90, **limits).collect()}
    want, leads = {}, []
    for i, (g, t) in enumerate(texts):
        want[i] = next((j for j in leads if texts[j][0] == g and token_set_ratio(t, texts[j][1]) >= 90), i)
        leads += [i] if want[i] == i else []
    assert got == want and len(leads) < len(texts) / 2


def test_numbered_names_list_no_matches_and_broadcast_no_names(spark, monkeypatch):
    """Files of numbered names are a hundredth of their rows, so their size must not decide on a broadcast."""
    counts, plans = {}, []

    def watched(df, label="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = stage(df, label)
        counts.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(clusters, "stage", watched)
    limit = "spark.sql.autoBroadcastJoinThreshold"
    held = spark.conf.get(limit)
    spark.conf.set(limit, "64k")
    try:
        names = [f"Customer#{i:09d}" for i in range(1500)]
        df = spark.createDataFrame([(1, t) for t in names], "g int, t string")
        got = clusters.fuzzy_wide(df, ["g"], "t", ["t"], heads=1)
        plans.append(got._jdf.queryExecution().executedPlan().toString())
        row = got.first()
    finally:
        spark.conf.set(limit, held)
    assert (row["chosen"], row["sources"]) == (heaviest_leader(names, 90), len(names))
    assert max(counts["cluster-edges"]) < len(names)
    joins = [line for plan in plans for line in plan.splitlines() if "Join [" in line]
    assert [line for line in joins if re.search(r"[\[ ](id|item|early|late)#", line.split("], [")[0])]
    assert not [line for line in joins if "BroadcastHashJoin" in line and re.search(r"[\[ ](id|item|early|late)#", line.split("], [")[0])]


def test_name_vote_weighs_copies_by_their_square():
    assert heaviest_leader(["A B", "C", "D", "D", "A B C", "A B D"], 90) == "D"
    assert heaviest_leader(["X", "Y"], 90) == "X"
    assert heaviest_leader([], 90) is None


@pytest.mark.parametrize("values, want", [("bab", "b"), ("aba", "a"), ("ab", "a"), ("ba", "b"), ("cc", "c"), ("", None)])
def test_mode_takes_cells_in_any_order(spark, values, want):
    rows = [(i, v) for i, v in enumerate(values)][::-1]
    df = spark.createDataFrame([(rows,)], "_rows array<struct<o: int, f: string>>")
    assert "sort_array" not in votes.cells("_rows", "f", ["o"])
    cells = df.selectExpr(f"{votes.cells('_rows', 'f', ['o'])} AS cells")
    assert cells.selectExpr(f"{votes.mode_first('cells')} AS f").first()["f"] == want


def test_group_counts(data):
    df, expected = data
    row = golden.group_counts(df, "key").first()
    assert (row["total"], row["unique_keys"], row["duplicates"]) == (193, 15, 178)
