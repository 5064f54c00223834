"""Benchmark decontamination through a positional inverted index, in DataFrame functions only.

The index holds a posting (term, document row, position) for every document word that is a term
of the test set. Test items are cut into windows of consecutive words. Windows in a row share
the words they all contain; the two rarest of those, by the index's own counts, are the probe
of the run. The lists of the rarest terms are shifted by their offsets and intersected, which
gives the few alignments of an item with a document that are worth a full look; those are
intersected with the lists of all other terms, again by position. A window occurs where all
its words do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import ascii_lower, query, table
from concord.session import stage

WINDOW = 10
#: What is not part of a word: ASCII other than digits, small letters (after lower-casing).
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in order. The first or last entry is empty where the text begins or ends between words."""
    return F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN)


def test_words(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``seq, word, at`` of the distinct word sequences, and ``item_id`` for each item that has it."""
    kept = F.filter(words_of(F.col(text_col)), lambda w: w != "")
    rows = items.select(F.col(item_col).cast("string").alias("item_id"), kept.alias("words"))
    return rows.where(F.size("words") > 0).withColumn("seq", F.xxhash64("words"))


def build_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Postings ``term, row, at`` of the terms' occurrences; ``row`` numbers the documents.

    Each document with words also has one posting with term null that holds its ``doc_id`` and number of
    words (``n_words``); one without has just that, with ``n_words`` 0.
    """
    split = words_of(F.col(text_col))
    rows = (
        docs.select(F.col(id_col).alias("doc_id"), split.alias("words"))
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", F.posexplode("words").alias("at", "word"), F.size("words").alias("n"),
                F.element_at("words", 1).alias("head"), F.element_at("words", -1).alias("tail"))
    )
    last = F.col("at") == F.col("n") - 1
    empties = (F.col("head") == "").cast("int") + ((F.col("n") > 1) & (F.col("tail") == "")).cast("int")
    known = terms.select("word", "term")
    return (
        rows.join(known, "word", "left")
        .where(F.col("term").isNotNull() | last)
        .select(
            "row",
            "at",
            "term",
            F.when(last, F.col("doc_id")).alias("doc_id"),
            F.when(last, F.col("n") - empties).cast("long").alias("n_words"),
        )
    )


def window_runs(words: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """Probes: ``seq, first, last`` (starts of the windows), ``width`` and the two rarest shared words.

    Runs are half a window of starts long at most, so their windows share at least half a window of words.
    """
    n = F.size("words")
    width = F.least(n, F.lit(window))
    half = max(1, window // 2)
    starts = F.explode(F.sequence(F.lit(0), n - width, F.lit(half))).alias("first")
    runs = words.select("seq", "words", width.alias("width"), starts).withColumn(
        "last", F.least(F.col("first") + half - 1, F.size("words") - F.col("width"))
    )
    shared = F.expr("transform(sequence(last, first + width - 1), i -> struct(i AS at, words[i] AS word))")
    spread = runs.select("seq", "first", "last", "width", F.explode(shared).alias("s")).select("*", "s.*")
    rated = spread.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = F.slice(F.array_sort(F.collect_list(F.struct("n", "at", "term"))), 1, 2)
    return (
        rated.groupBy("seq", "first", "last", "width")
        .agg(rarest.alias("rare"))
        .where(F.col("rare")[0]["n"] > 0)
        .select("seq", "first", "last", "width", F.col("rare")[0].alias("r1"), F.get("rare", F.lit(1)).alias("r2"))
    )


def occurrences(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, hits, items_hit)``: ``row, doc_id, n_words``; ``row, at`` of hit words;
    ``row, item_id`` of items with an occurring window."""
    words = stage(test_words(items), "decon-items")
    sequences = words.select("seq", "words").dropDuplicates(["seq"])
    spread = sequences.select("seq", F.posexplode("words").alias("at", "word"))
    vocabulary = stage(spread.select("word").distinct().withColumn("term", F.xxhash64("word")), "decon-terms")
    index = stage(build_index(docs, vocabulary), "decon-index")
    postings = index.where("term IS NOT NULL").select("row", "at", "term")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    counts = stage(vocabulary.join(counts, "term", "left"), "decon-counts")
    probes = stage(window_runs(sequences, counts, window), "decon-probes")

    def aligned(rare: str) -> DataFrame:
        """Alignments (item word 0 on document position ``shift``) that put the probe's word right."""
        p = probes.where(f"{rare} IS NOT NULL").select("seq", "first", "last", "width", f"{rare}.*")
        p = p.withColumnRenamed("at", "offset").drop("n")
        return p.join(postings, "term").select(
            "seq", "first", "last", "width", "row", (F.col("at") - F.col("offset")).alias("shift")
        )

    key = ["seq", "first", "last", "width", "row", "shift"]
    single = aligned("r1").join(probes.where("r2 IS NULL").select("seq", "first"), ["seq", "first"], "left_semi")
    likely = aligned("r1").join(aligned("r2"), key, "left_semi").unionByName(single)
    likely = stage(likely.select("seq", "row", "shift", "first", "last", "width").distinct(), "decon-likely")
    # each word that a likely run of windows needs, looked up in the index by position
    covers = F.explode(F.sequence(F.col("first"), F.col("last") + F.col("width") - 1)).alias("offset")
    needed = likely.select("seq", "row", "shift", covers).distinct()
    places = spread.select("seq", F.col("at").alias("offset"), F.xxhash64("word").alias("term"))
    wanted = needed.join(places, ["seq", "offset"]).withColumn("at", F.col("shift") + F.col("offset"))
    touched = postings.join(likely.select("row").distinct(), "row", "left_semi")
    matched = wanted.join(touched, ["row", "at", "term"], "left_semi").select("seq", "row", "shift", "offset")
    # stretches of matched words that are as long as a window (or the whole item)
    line = Window.partitionBy("seq", "row", "shift").orderBy("offset")
    island = matched.withColumn("island", F.col("offset") - F.row_number().over(line))
    widths = sequences.select("seq", F.least(F.size("words"), F.lit(window)).alias("width"))
    whole = (
        island.groupBy("seq", "row", "shift", "island")
        .agg(F.min("offset").alias("from"), F.max("offset").alias("to"))
        .join(widths, "seq")
        .where("to - from + 1 >= width")
    )
    found = stage(whole.select("seq", "row", (F.col("shift") + F.col("from")).alias("from"), (F.col("shift") + F.col("to")).alias("to")), "decon-found")
    hits = found.select("row", F.explode(F.sequence("from", "to")).alias("at")).distinct()
    items_hit = found.select("seq", "row").distinct().join(words.select("seq", "item_id"), "seq").select("row", "item_id")
    documents = index.where("n_words IS NOT NULL").select("row", "doc_id", "n_words")
    return documents, hits, items_hit.distinct()


def overlap(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words; items without words have no window. Rows with equal or null
    ids are documents of their own; an item id that occurs twice counts once per document. Only
    ``doc_id``/``text`` and ``item_id``/``text`` are read. No list of postings is gathered
    anywhere: a frequent term is many rows of a join, which adaptive execution splits.
    """
    documents, hits, items_hit = occurrences(docs, items, window)
    n_hit = hits.groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    listed = items_hit.groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return (
        documents.join(n_hit, "row", "left")
        .join(listed, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def phrase(index: DataFrame, words: list[str], slop: int = 0) -> DataFrame:
    """``row, at`` where ``words`` (two or more) stand in order with at most ``slop`` other words
    between neighbours: 0 is the exact phrase, more is proximity."""
    spark = index.sparkSession
    query_terms = spark.range(1).select(F.array(*(F.xxhash64(F.lit(w)) for w in words)).alias("t"))
    found = None
    for i in range(len(words)):
        term = query_terms.select(F.col("t")[i].alias("term"))
        here = index.join(term, "term", "left_semi").select("row", F.col("at").alias(f"at{i}"))
        if found is None:
            found = here
        else:
            gap = F.col(f"at{i}") - F.col(f"at{i - 1}")
            found = found.join(here, "row").where(gap.between(1, 1 + slop))
    return found.select("row", F.col("at0").alias("at")).distinct()


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
     i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark),
     win AS (
       SELECT DISTINCT item_id, least(len(w), 10) AS k, list_slice(w, s, s + least(len(w), 10) - 1) AS t
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)
     ),
     widths AS (SELECT DISTINCT k FROM win),
     pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
     cut AS (SELECT doc_id, p, k, list_slice(w, p, p + k - 1) AS t FROM pos, widths WHERE p + k - 1 <= len(w)),
     occ AS (SELECT doc_id, p, win.k, item_id FROM cut JOIN win ON cut.k = win.k AND cut.t = win.t),
     hit AS (
       SELECT doc_id, count(DISTINCT q) AS n_hit
       FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT doc_id, p, k FROM occ)) GROUP BY 1
     ),
     items AS (
       SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
       FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY 1
     )
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_decontaminate", ORACLE)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
