"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from concord.llm import spelling

SCHEMA = "doc_id long, text string, word string, n string, m int, key int"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def best(words):
    out = {}
    for a in words:
        others = [b for b in words if near(a, b)]
        if others:
            first = min(others, key=lambda b: (-words[b], b))
            out[a] = (len(others), words[first], first)
    return out


def rows():
    draw = random.Random(3)
    syllables = ["ab", "é", "ba", "a", "Öl", "x"]
    pool = ["".join(draw.choices(syllables, k=draw.randint(3, 5))) for _ in range(60)]
    out = [(i, " ".join(draw.choices(pool, k=120)) + draw.choice([". Über2x", "×÷×÷×", "\n"]), "w", None, 1, 2) for i in range(40)]
    out += [(None, out[0][1], "w", None, None, None), (0, out[0][1], "w", None, None, None), (90, None, None, None, None, None), (91, "", None, None, None, None)]
    return out + [(92, "a" * 3_000 + " " + "a" * 3_000 + " " + "a" * 3_000 + " " + ("a" * 2_999 + "b ") * 9, "w", None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def counted():
    words = Counter()
    for doc_id, text, *_ in rows():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def test_variants_equal_brute_force(docs):
    words = counted()
    found = best(words)
    form = {w: b for w, (_, n, b) in found.items() if n >= 2 * words[w]}
    want = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        want.add((w, form.get(w), root, n, found.get(w, (0,))[0], words[form[w]] if w in form else None))
    assert {tuple(r) for r in spelling.variants(docs).collect()} == want
    assert any(r[1] for r in want) and max(len(r[0]) for r in want) == 3_000


@pytest.mark.parametrize("block", [3, 25])
def test_near_words_at_every_block_size(spark, block):
    draw = random.Random(1)
    words = {"".join(draw.choice("abé") for _ in range(draw.randint(5, 8))) for _ in range(300)}
    words = {w: draw.randint(3, 60) for w in sorted(words)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(frame, block).collect()} == best(words)


def test_composition_gives_each_pair_once():
    draw = random.Random(2)
    for _ in range(60):
        words = sorted({"".join(draw.choice("ab") for _ in range(draw.choice([5, 6]))) for _ in range(draw.randint(1, 40))})
        got = list(spelling.near_in_cell(words, 5, 0))
        want = {(a, b) for a in words for b in words if a < b and near(a, b) and min(len(a), len(b)) == 5}
        assert len(got) == len(want) and {tuple(sorted((words[i], words[j]))) for i, j in got} == want


def test_long_chains_of_forms(spark):
    forms = [(f"w{i}", f"w{i + 1}") for i in range(37)]
    got = {r.word: r.root for r in spelling.roots(spark.createDataFrame(forms, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in forms}


def test_empty_table(docs):
    assert spelling.variants(docs.where("false")).count() == 0
