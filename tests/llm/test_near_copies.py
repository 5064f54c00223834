"""The pipeline's near-copy stage against exact similarity."""

import random

import numpy as np
import pytest

from concord.llm import nearcopies, simhash
from tests.llm.test_texts import _components

SCHEMA = "doc_id long, text string"


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def _alike(a, b):
    x, y = _shingles(a), _shingles(b)
    return len(x & y) >= 0.8 * len(x | y)


def _edited(draw, words, edits):
    out = list(words)
    for at in draw.sample(range(5, len(out) - 5), edits):
        out[at] = f"new{draw.randint(0, 10**9)}"
    return " ".join(out)


def _pairs(n):
    """Pairs of texts of 150 words with one to six words changed: similarity 0.97 to 0.66."""
    draw = random.Random(11)
    for _ in range(n):
        words = [f"w{draw.randint(0, 10**9)}" for _ in range(150)]
        yield " ".join(words), _edited(draw, words, draw.randint(1, 6))


@pytest.mark.parametrize("chunk", [250, 2])
def test_exactly_the_pairs_at_the_threshold_go(spark, chunk):
    pairs = list(_pairs(120))
    rows = [(2 * i + k, t) for i, pair in enumerate(pairs) for k, t in enumerate(pair)]
    draw = random.Random(12)
    base = [f"b{i}" for i in range(150)]  # many near copies of one text, linked over others
    rows += [(1000 + i, _edited(draw, base, draw.randint(0, 3))) for i in range(25)]
    near = [_alike(*p) for p in pairs]
    assert 20 < sum(near) < 100
    names = _components([r[0] for r in rows], lambda i, j: _alike(rows[i][1], rows[j][1]))
    kept = sorted(r.doc_id for r in nearcopies.first_of_each(spark.createDataFrame(rows, SCHEMA).repartition(3), chunk).collect())
    assert kept == sorted(set(names))


def test_close_prints_are_proposed_as_well(spark, monkeypatch):
    """Where no band is shared, the prints of op10 still bring the pair together, and its shingles decide."""
    monkeypatch.setattr(nearcopies, "shared_buckets", lambda nodes, known=nearcopies.shared_buckets: known(nodes).where("false"))
    draw = random.Random(13)
    words = [f"w{draw.randint(0, 10**9)}" for _ in range(900)]
    rows = [(1, " ".join(words)), (2, _edited(draw, words, 1)), (3, " ".join(words[:700])), (None, "one text alone"), (4, "")]
    kept = [r.doc_id for r in nearcopies.first_of_each(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(kept, key=str) == [1, 3, 4, None]


def test_pairs_of_close_prints_are_all_listed_and_decided(spark):
    draw = random.Random(14)
    base = [draw.getrandbits(64) for _ in range(3)]
    prints = sorted({b ^ sum(1 << k for k in draw.sample(range(64), draw.randint(0, 5))) for b in base for _ in range(12)})
    nodes = [(i, i % 4, int(np.uint64(p).view(np.int64))) for i, p in enumerate(prints)]
    frame = spark.createDataFrame(nodes, "node long, root long, fp long")
    want = {(i, j) for j in range(len(prints)) for i in range(j) if i % 4 != j % 4 and (prints[i] ^ prints[j]).bit_count() <= 4}
    for chunk in (4000, 5):
        got = [tuple(r) for r in simhash.pairs_apart(simhash.pivot_table(frame), chunk=chunk).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    sets = [(0, range(10)), (1, range(8)), (2, range(7)), (3, range(2, 12)), (4, [])]
    sets = spark.createDataFrame([(n, np.array(list(s), np.uint64).tobytes()) for n, s in sets], "node long, shingles binary")
    pairs = spark.createDataFrame([(i, j) for j in range(5) for i in range(j)], "a long, b long")
    assert sorted(map(tuple, nearcopies.confirmed(pairs, sets).collect())) == [(0, 1), (1, 2)]


def test_rows_that_share_an_id_are_judged_one_by_one(spark):
    first, copy = next(p for p in _pairs(20) if _alike(*p))
    rows = [(1, first), (2, copy), (2, "something else that has nothing to do with it at all")]
    kept = {(r.doc_id, r.text) for r in simhash.first_of_each(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert kept == {rows[0], rows[2]}
