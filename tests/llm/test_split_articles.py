"""Main text that stands in several containers is kept whole."""

from concord.llm import pages

SCHEMA = "page_id long, url string, html string"


def _texts(spark, rows):
    frame = spark.createDataFrame([(i, f"http://{host}.example/{i}", h) for i, host, h in rows], SCHEMA)
    return {r.page_id: r.text for r in pages.main_text(frame).collect()}


def _p(word, n):
    return f"<p>{' '.join([word] * n)}</p>"


def test_split_articles_are_kept_whole(spark):
    nav = '<nav><a href="/">Home</a></nav>'
    lead = f'<body>{nav}<article><div class="lead">{_p("lead", 30)}</div><div class="body">{_p("body", 70)}</div></article>'
    loose = f'<body>{nav}<article><p>first</p><div class="body">{_p("body", 99)}</div></article>'
    usual = f'<body>{nav}<div class="page"><div class="body">{_p("body", 90)}</div><div class="related">{_p("junk", 50)}</div></div>'
    chapters = f'<body>{nav}<div class="page"><div class="body">{_p("body", 10)}</div><div class="chapter">{_p("chapter", 90)}</div></div>'
    rows = [(0, "one", lead), (1, "two", loose), *[(10 + i, "three", usual) for i in range(5)], (3, "three", chapters)]
    got = _texts(spark, rows)
    assert got[0] == " ".join(["lead"] * 30 + ["body"] * 70)
    assert got[1] == " ".join(["first"] + ["body"] * 99)
    assert got[3] == " ".join(["body"] * 10 + ["chapter"] * 90)
    assert all(got[10 + i] == " ".join(["body"] * 90) for i in range(5))


def test_text_in_links_alone_is_not_cut(spark):
    linked = '<body><div class="a"><a href="/1">one</a></div><div class="b"><a href="/2">two</a></div>'
    assert _texts(spark, [(0, "one", linked)]) == {0: "one two"}
