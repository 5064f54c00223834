"""Conversation repair against brute force over all edits, and both forms against each other."""

import hashlib
import itertools
import random

import pytest

from concord.llm import conversations as c
from concord.llm.derivation import lightest

SCHEMA = "conv_id long, turn long, role string, text string, kind int, present string, at string, pos int"


def brute(turns):
    """Cheapest (cost, audit, repaired) over all keeps, reroles, deletes and up to three inserts at a place."""
    seen, options = set(), []
    for _, role, text in turns:
        body = text.strip(c.BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        extra = 5 if fault == "truncated" else 0
        ways = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            ways += [(extra, "K", [(role, text)])] + [(1 + extra, "R", [(r, text)]) for r in ("user", "assistant")]
        options.append(ways)
    inserts = [(5 * n, "I" * n, [(r, "") for r in rs]) for n in range(3) for rs in itertools.product(("user", "assistant"), repeat=n)]
    steps = [inserts]
    for ways in options:
        steps += [ways, inserts]
    best = None
    for chosen in itertools.product(*steps):
        made = [t for w in chosen for t in w[2]]
        roles = "".join(r[:1] for r, _ in made)
        body = roles[1:] if roles.startswith("s") else roles
        if roles and (not body or body != "ua" * (len(body) // 2)) or any(not r for r, _ in made):
            continue
        value = (sum(w[0] for w in chosen), "".join(w[1] for w in chosen), made)
        if best is None or value[:2] < best[:2]:
            best = value
    return best


def test_cheapest_edits_equal_brute_force():
    draw = random.Random(5)
    for _ in range(60):
        turns = [
            (draw.choice([None, 1, 2, 5]), draw.choice(["user", "assistant", "system", "", "tool"]), draw.choice(["Hi.", "what", " ", "", "So!", "é"]))
            for _ in range(draw.randint(0, 3))
        ]
        want = brute(turns)
        got = c.repair(turns)
        assert got[5:7] == want[:2], turns
        assert got[7] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in want[2]).encode()).hexdigest()


def test_agenda_stops_at_the_goal():
    def rule(item, value, final):
        yield item + 1, (value[0] + 1, value[1] + "x")

    assert max(lightest([(0, (0, ""))], rule, goal=7)) == 7


def rows():
    draw = random.Random(9)
    out = []
    for conv in [None, *range(12)]:
        for t in range(draw.choice([1, 3, 9, 40])):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", None, ""])
            out.append((conv, draw.choice([t, t, t, None, t - 1]), role, draw.choice(["Yes.", "a line", None, "", "x" * 5000 + ".", f"turn {t}!"]), 1, "p", "q", 2))
    out += [out[0], out[0], out[-1]]
    return out


@pytest.fixture(scope="module")
def turns(spark):
    return c.damaged(spark.createDataFrame(rows(), SCHEMA).repartition(3))


def test_damage_is_by_hash_of_the_place(spark):
    import zlib

    want = []
    for conv, turn, role, text, *_ in rows():
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else text.translate(dict.fromkeys(map(ord, ".!?"))) if k == 2 else text
        want += [(conv, turn, "user" if k == 4 else role, text, k != 0)] * (2 if k == 3 else 1)
    got = c.damaged(spark.createDataFrame(rows(), SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_long_conversations_give_the_same(turns):
    plain = {r.conv_id: tuple(r) for r in c.repair_all(turns).collect()}
    assert len(plain) == 13 and any("I" in r[7] or "R" in r[7] for r in plain.values())
    for segment in (4,):
        assert {r.conv_id: tuple(r) for r in c.repair_all(turns, segment).collect()} == plain
    cut = {r.conv_id: tuple(r) for r in c.repair_long(turns, 3, joined=2).collect()}
    assert cut == plain


def test_nothing_present_and_no_rows(spark):
    none = spark.createDataFrame([(7, 1, "user", "Hi.", False)], "conv_id long, turn long, role string, text string, present boolean")
    want = (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert [tuple(r) for r in c.repair_all(none).collect()] == [want]
    assert [tuple(r) for r in c.repair_long(none).collect()] == [want]
    assert c.repair_all(none.where("false")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    from types import SimpleNamespace

    from concord.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare, duck

    for name in ("op11_conversations", "op12_spelling"):
        assert compare(spark, duck(sf_dir), name, SimpleNamespace(build=QUERIES[name], sql=ORACLES[name]), sf_dir) == ""
