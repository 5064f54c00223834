"""Main text of web pages by consensus on container paths per host.

Every page is parsed once into text blocks with the path of containers they stand in (tags with
generalised classes). A page votes for the deepest container that holds nearly all of its running
text, and so for every path in it and against its other paths; the votes are counted per host and
path. Each page is then extracted again without the paths that most pages of its host which have
them leave out. Paths that only this page has stay as it votes itself.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import query, table
from concord.session import stage

#: Share of a page's running text that the container it votes for holds at least.
SHARE = 0.95

# What never holds main text, by element and by word in class, id or role.
DROPPED_TAGS = frozenset("nav aside footer form button select option menu dialog iframe object svg canvas audio video map head label fieldset".split())
DROPPED_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising advertorial banner banners breadcrumb breadcrumbs comment"
    " commentlist comments complementary consent contentinfo cookie cookies copyright disclaimer discussion disqus footer"
    " footnav gdpr header hidden infobar legal login masthead menu menus modal nav navbar navigation newsletter notice"
    " notices notification overlay pagination pager popup promo promoted promotion recommended related replies reply"
    " respond responses search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription"
    " toolbar topbar widget widgets".split()
)
#: Words that make a name speak of other elements, as in ``with-sidebar``.
ABOUT_OTHERS = frozenset("has with without no".split())
CONTAINERS = frozenset("html body main article section div td center header details".split())
#: Elements that part words (inline elements do not).
BREAKS = CONTAINERS | DROPPED_TAGS | frozenset(
    "p br hr h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr th blockquote pre figure figcaption address summary caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
_NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _described(attributes: str) -> tuple[str, bool]:
    """Generalised class of an element, and whether its names mark it as boilerplate."""
    if not attributes or attributes.isspace():
        return "", False
    kinds, drop = "", False
    for name, *values in _NAMED.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            drop = True
        elif name != "aria-hidden":
            for one in value.split():
                words = {w.lower() for w in _PARTS.findall(_CAMEL.sub(" ", one))}
                drop |= bool(words & DROPPED_WORDS) and not words & ABOUT_OTHERS
            if name == "class":
                kinds = "".join(sorted("." + re.sub(r"\d+", "#", k.lower()) for k in value.split()))
    return kinds, drop


def blocks(page: str) -> list[tuple[str, str, int]]:
    """Text blocks in page order: container path, text, characters outside links.

    Blocks inside boilerplate are left out. Elements that are never closed end with their container.
    """
    out: list[tuple[str, str, int]] = []
    stack: list[tuple[str, str, bool]] = [("", "", False)]  # tag, path, dropped
    parts: list[str] = []
    linked, inside_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            _, path, dropped = stack[-1]
            if not dropped and (text := " ".join(html.unescape("".join(parts)).split())):
                out.append((path, text, max(0, len(text) - linked)))
            parts, linked = [], 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if inside_link:
                linked += len(text)

    for m in _MARKUP.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        tag = (m["tag"] or m["raw"] or "").lower()
        if tag == "a":
            inside_link = 0 if m["close"] else 1
        if tag not in BREAKS or m["raw"]:
            continue
        flush()
        if tag not in CONTAINERS and tag not in DROPPED_TAGS and not m["attributes"]:
            if m["close"]:
                for k in range(len(stack) - 1, 0, -1):  # an element with a class may be open
                    if stack[k][0] in CONTAINERS:
                        break
                    if stack[k][0] == tag:
                        del stack[k:]
                        break
            continue
        if m["close"]:
            inside_link = 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID and not (m["attributes"] or "").endswith("/"):
            if tag not in CONTAINERS and stack[-1][0] == tag and tag in ("p", "li", "td", "tr", "dt", "dd"):
                del stack[-1]  # a paragraph or item ends the one before
            kinds, drop = _described(m["attributes"])
            _, path, dropped = stack[-1]
            within = "article" in path or "main" in path
            drop = drop and tag not in ("html", "body", "main", "article") or tag in DROPPED_TAGS or (tag == "header" and not within)
            own = f"{path}>{tag}{kinds}" if tag in CONTAINERS else path
            stack.append((tag, own, dropped or drop))
    take(page[at:])
    flush()
    return out


def own_vote(found: list[tuple[str, str, int]], share: float = SHARE) -> str:
    """The deepest container path that holds at least ``share`` of the text outside links.

    Where all text is in links, links count. A container inside an article stands for the
    article, whose parts need no names. Without a common container the whole page is meant ('').
    """
    if not any(n for *_, n in found):
        found = [(p, t, len(t)) for p, t, _ in found]
    held: dict[str, int] = {}
    for path, _, n in found:
        steps = path.split(">")
        for k in range(2, len(steps) + 1):
            prefix = ">".join(steps[:k])
            held[prefix] = held.get(prefix, 0) + n
    total = sum(n for *_, n in found)
    good = [p for p, n in held.items() if n >= share * total]
    steps = max(good, key=lambda p: (p.count(">"), p), default="").split(">")
    articles = [k for k, step in enumerate(steps) if step.split(".")[0] == "article"]
    return ">".join(steps[: articles[-1] + 1] if articles else steps)


PARSED = "page_id long, digest long, url string, host string, vote string, paths array<string>, texts array<string>"


def parse(pages: DataFrame) -> DataFrame:
    """Blocks of every page and its own vote. Null html is empty; a null url has the host ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, paths, contents = [], [], []
            for page in batch["html"].to_pylist():
                found = blocks(page)
                votes.append(own_vote(found))
                paths.append([p for p, *_ in found])
                contents.append([t for _, t, _ in found])
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["digest"], batch["url"], batch["host"], pa.array(votes, pa.string()), pa.array(paths, strings), pa.array(contents, strings)],
                names=["page_id", "digest", "url", "host", "vote", "paths", "texts"],
            )

    host = F.lower(F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")
    )
    return rows.withColumn("digest", F.xxhash64("html", "url")).mapInArrow(run, PARSED)


def _within(path: Column, container: Column) -> Column:
    return (container == "") | (path == container) | F.startswith(path, F.concat(container, F.lit(">")))


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Rows with equal or null ids are pages of their own. Votes of a host are counted before they
    are shuffled, so a host with a third of the pages is one row per path; a page asks for the
    votes on its own few paths. A path stays in a tie. A page of which the host would leave
    nothing is extracted by its own vote.
    """
    # first pass: votes and paths, one narrow row per page id and content
    first = parse(pages).select("page_id", "digest", "host", "vote", F.array_distinct("paths").alias("paths"))
    asked = stage(first, "pages-votes").select("page_id", "digest", "host", "vote", F.explode("paths").alias("path"))
    for_it = _within(F.col("path"), F.col("vote")).cast("long")
    votes = asked.groupBy("host", "path").agg(F.sum(for_it).alias("ins"), F.count(F.lit(1)).alias("pages"))
    outside = votes.where("2 * ins < pages").select("host", "path")
    left_out = asked.join(outside, ["host", "path"], "left_semi").groupBy("page_id", "digest").agg(F.collect_set("path").alias("outside"))
    chosen = left_out.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "outside")
    # second pass: the texts in the other containers; they are parsed again rather than kept
    parsed = parse(pages)
    same = F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    joined = parsed.join(chosen, same, "left").withColumn("outside", F.coalesce("outside", F.array().cast("array<string>")))
    nothing = F.size(F.array_except("paths", "outside")) == 0
    pairs = F.filter(
        F.arrays_zip("paths", "texts"),
        lambda b: F.when(nothing, _within(b["paths"], F.col("vote"))).otherwise(~F.array_contains("outside", b["paths"])),
    )
    text = F.array_join(F.transform(pairs, lambda b: b["texts"]), " ")
    return joined.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


@query("op6_main_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
