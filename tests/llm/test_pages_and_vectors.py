"""Pages, vectors, the shared numbering, and the pipeline as a whole."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from concord.llm import common, embeddings, pages
from concord.llm.queries import ORACLES, QUERIES
from concord.queries.base import Query
from tests.oracle import compare, duck

MENU = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>'
SIDE = '<div class="sidebar"><p>Popular: a story about stones that is quite long</p></div>'
PAGES = [
    ("<html><head><title>T</title><style>p{}</style></head><body>" + MENU + '<div id="c1" class="post-12"><h1>Head</h1><p>One &amp; two<br>three <b>bo</b>ld.</p><p>Four\n  five &lt;six&gt;</p></div>' + SIDE + '<div class="comments"><p>nice</p></div><footer>&copy; x</footer></body></html>', "Head One & two three bold. Four five <six>"),
    ('<body><div class="cookie-notice">We use cookies</div><div class="post-7"><p>Short.</p></div><div class="x"><ul><li><a href=1>' + "very long link text " * 9 + "</a></ul></div>", "Short."),
    ('<div class=post-9><script>var t="<p>no</p>";</script><p>Open paragraph<p>another<form>name <input></form><!-- <p>gone</p> --></div>' + MENU, "Open paragraph another"),
    ("<article><header><h1>Title</h1></header><p>Body text &#233;&nbsp;x</p><aside>ad</aside></article>", "Title Body text é x"),
    ('<body class="has-sidebar"><div class="wrap with-sidebar"><div class="text"><p class="byline">By A</p><p>Long text of the page</p></div><div class="side sidebar">x</div></div>', "By A Long text of the page"),
    (None, ""),
    ("", ""),
    ("just text < 5 and > 3", "just text < 5 and > 3"),
]


def test_main_text(spark):
    rows = [(i, "http://h.example/p" if i < 3 else (None if i == 5 else f"https://o{i}.example/"), h, "x") for i, (h, _) in enumerate(PAGES)]
    rows += [(0, "http://h.example/p", PAGES[0][0], "again"), (None, "http://h.example/q", PAGES[1][0], "n")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in pages.main_text(frame).collect()), key=repr)
    want = [(i, t) for i, (_, t) in enumerate(PAGES)] + [(0, PAGES[0][1]), (None, PAGES[1][1])]
    assert got == sorted(((i, t, len(t)) for i, t in want), key=repr)
    assert pages.main_text(frame.limit(0)).count() == 0


def test_the_host_decides_where_a_page_alone_would_err(spark):
    usual = '<div class="story"><p>' + "plain words of the story " * 20 + '</p></div><div class="extra"><p>less</p></div>'
    odd = '<div class="story"><p>tiny</p></div><div class="extra"><p>' + "a very long list of other things " * 20 + "</p></div>"
    rows = [(i, f"http://one.example/{i}", usual) for i in range(5)] + [(9, "http://one.example/9", odd), (10, "http://two.example/", odd)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "tiny" and got[10].startswith("a very long")


def _linked(vectors, cosine=0.9):
    ok = [v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors]
    def near(i, j):
        if not (ok[i] and ok[j] and len(vectors[i]) == len(vectors[j])):
            return False
        a, b = np.array(vectors[i], float), np.array(vectors[j], float)
        return a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine
    return near


@pytest.mark.parametrize("chunk", [1500, 5])
def test_vectors_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(embeddings, "CHUNK", chunk)
    draw = np.random.default_rng(4)
    centres = draw.standard_normal((12, 16))
    vectors = [(c + s * draw.standard_normal(16)).astype(np.float32).tolist() for c in centres for s in (0.05, 0.1, 0.2, 0.25, 0.3)]
    vectors += [vectors[0]] * 9 + [[2 * x for x in vectors[0]], None, [0.0] * 16, [None] + [1.0] * 15, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.1], []]
    ids = [*range(len(vectors) - 1), None]
    frame = spark.createDataFrame(list(zip(ids, vectors, [0] * len(ids), [1] * len(ids), strict=True)), "vec_id long, embedding array<float>, n long, cid long")
    near = _linked(vectors)
    n = [sum(near(i, j) for j in range(len(vectors)) if j != i) for i in range(len(vectors))]
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    assert len(got) == len(vectors)
    found = sum(got[i].n_links for i in ids)
    assert found >= 0.99 * sum(n) and all(got[i].n_links <= n[k] for k, i in enumerate(ids))
    from tests.llm.test_texts import _components

    if found == sum(n):
        assert [got[i].component_id for i in ids] == _components(ids, near)
    assert all(got[i].kept == (i == got[i].component_id) for i in ids)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_numbers_are_gapless_in_order(spark):
    draw = random.Random(1)
    rows = [(draw.choice([1, 1, 1, 2, None]), draw.randint(0, 50)) for _ in range(500)]
    frame = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = sorted((r.pos, r.a, r.b) for r in common.numbered(frame, F.asc_nulls_first("a"), "b").select("pos", F.coalesce("a", F.lit(0)).alias("a"), "b").collect())
    assert [p for p, *_ in got] == list(range(500)) and [x[1:] for x in got] == sorted((a or 0, b) for a, b in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, duck(sf_dir), name, Query(QUERIES[name], ORACLES[name]), sf_dir) == ""


def test_pipeline_stage_by_stage(spark, sf_dir):
    from tests.llm.test_texts import ROWS, _base

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert labels.count() > 0
    base = spark.read.parquet(f"{sf_dir}/documents.parquet")
    odd = spark.createDataFrame([(None if r[0] is None else 10_000 + r[0], r[1], None, r[2], None) for r in ROWS], base.schema)
    docs, columns = base.union(odd), base.columns
    ids = {r.doc_id for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(step(spark, docs, sf_dir), f"test-{name}")
        if name == "packing":
            assert {r.doc_id for r in out.collect()} == ids
            break
        assert out.columns == columns
        rows = out.collect()
        kept = {r.doc_id for r in rows}
        assert kept <= ids
        if name in ("toxicity", "personal_data"):
            assert len(rows) >= 0.8 * len(ids)
        if name == "near_duplicates":
            texts = [r.text for r in rows if r.doc_id is not None and r.text]
            assert len(texts) == len(set(texts))
        if name == "personal_data":
            assert not any(_base(r.text) for r in rows if r.doc_id is not None and r.doc_id < 10_000)
        docs, ids = out, kept
    empty = base.limit(0)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, sf_dir).count() == 0
