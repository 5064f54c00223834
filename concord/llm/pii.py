"""Personal data by candidate generation and boosted trees, in DataFrame functions only.

Generators with high recall propose spans that may overlap; the validated patterns are among
them. Each candidate is described by its format and by what stands around it. Trees are boosted
on the whole corpus, counted by feature row, with validated spans (and what overlaps them) as
positives, and applied as column expressions. The threshold per kind is calibrated on held-out
documents. Validated spans always stay; the trees add others where no validated one lies.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm import boosting
from concord.llm.common import free_name, query, table, texts
from concord.session import stage

# Kinds in their listed order and the patterns that define them. A local part, a
# number or a run of digits is taken from its beginning (or from the end of the match before), so
# no text is scanned twice, and nothing repeats a group without bound, so long runs are safe.
KINDS = ("email", "ip", "card", "phone")
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]++"
    r"[A-Za-z0-9.-]*?(?=\.(?![A-Za-z0-9-])|[^A-Za-z0-9.-]|\z)"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: Wider patterns: anything around an at sign; digit groups as in numbers of accounts or phones.
WIDE_MAIL = r"(?<![^\s@])[^\s@]++@[^\s@]++"
WIDE_CARD = r"(?<![0-9.])[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{1,7}(?![0-9])"
WIDE_PHONE = r"(?<![0-9(])(?:\([0-9]{2,4}\)[\x20]?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9])"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

#: generator: (kind, validated pattern?, pattern, what a text must contain)
GENERATORS = (
    ("email", True, EMAIL, "@"),
    ("ip", True, IP, "digit"),
    ("card", True, CARD, "digit"),
    ("phone", True, PHONE, "+"),
    ("email", False, WIDE_MAIL, "@"),
    ("card", False, WIDE_CARD, "digit"),
    ("phone", False, WIDE_PHONE, "digit"),
)
CUES = (
    r"(?i)(?:e-?mail|mail|contact|tel|phone|fon|call|fax|mobile|card|visa|account|iban|ip|addr|host)[\w]*\W*$",
    r"(?i)(?:token|key|hash|sha|uuid|version|isbn|order|ticket|page)[\w]*\W*$",
)
FEATURES = ["kind_no", "digits", "separators", "luhn", "octets", "plus", "before", "after", "cue", "dots"]
#: Characters kept on either side of a candidate for its context.
CONTEXT = 24
#: Held-out precision that a kind's threshold must reach; without it the kind adds nothing.
PRECISION = 0.98


def _side(c: Column) -> Column:
    """Class of a neighbouring character: none or blank, letter, digit, other."""
    return F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2).otherwise(3)


def _matches(number: int, kind: str, pattern: str, needs: str) -> Column:
    """All matches of a generator with what stands before each, as an array of structs; the last
    one, without a match, has the text behind them."""
    text = F.col("text")
    present = text.rlike("[0-9]") if needs == "digit" else text.contains(needs)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("m"), between.alias("g")),
        lambda x: F.struct(
            F.lit(number).alias("generator"),
            x["m"].alias("match"),
            F.length(x["g"]).alias("gap"),
            F.right(x["g"], F.lit(CONTEXT)).alias("left"),
            F.left(x["g"], F.lit(1)).alias("head"),
        ),
    )
    return F.when(present, rows)


def candidates(docs: DataFrame) -> DataFrame:
    """One row per candidate with its span (code points), validity and features.

    Every document also has a row without a span, so none is lost. ``row`` numbers the documents:
    equal or null ids stay documents of their own. Matches of one text are summed up to
    positions by a window over that text's own matches.
    """
    nothing = F.array(
        F.struct(
            F.lit(-1).alias("generator"),
            F.lit("").alias("match"),
            F.lit(0).alias("gap"),
            F.lit("").alias("left"),
            F.lit("").alias("head"),
        )
    )
    arrays = [_matches(i, kind, pattern, needs) for i, (kind, _, pattern, needs) in enumerate(GENERATORS)]
    found = F.concat(nothing, *(F.coalesce(a, F.slice(nothing, 1, 0)) for a in arrays))
    rows = (
        texts(docs)
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", F.xxhash64("text").alias("digest"), F.posexplode(found).alias("n", "c"))
        .select("row", "doc_id", "digest", "n", "c.*")
    )
    own = Window.partitionBy("row", "generator").orderBy("n")
    so_far = F.sum(F.col("gap") + F.length("match")).over(own)
    digits = F.regexp_replace("match", "[^0-9]", "")
    number = F.length(digits)
    kind = F.element_at(F.array(*(F.lit(k) for k, *_ in GENERATORS)), F.col("generator") + 1)
    checked = F.element_at(F.array(*(F.lit(v) for _, v, *_ in GENERATORS)), F.col("generator") + 1)
    octets = F.col("match").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    luhn = number.between(14, 19) & F.call_function("luhn_check", digits)
    valid = (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", octets)
        .when(F.col("kind") == "card", luhn)
        .otherwise(number.between(10, 15))
    )
    placed = rows.where("generator >= 0").withColumns({"end": so_far, "next": F.lead("head").over(own)})
    known = placed.where("match IS NOT NULL")
    described = known.withColumns({"kind": kind, "start": F.col("end") - F.length("match")}).select(
        "row",
        "doc_id",
        "digest",
        "kind",
        "start",
        "end",
        (checked & valid).alias("base"),
        (F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind")) - 1).cast("int").alias("kind_no"),
        F.least(number, F.lit(24)).alias("digits"),
        F.least(F.length(F.regexp_replace("match", r"[^\x20().-]", "")), F.lit(8)).alias("separators"),
        luhn.cast("int").alias("luhn"),
        octets.cast("int").alias("octets"),
        F.col("match").startswith("+").cast("int").alias("plus"),
        _side(F.right("left", F.lit(1))).alias("before"),
        _side(F.col("next")).alias("after"),
        F.when(F.col("left").rlike(CUES[0]), 1).when(F.col("left").rlike(CUES[1]), 2).otherwise(0).alias("cue"),
        F.least(F.length(F.regexp_replace("match", r"[^.]", "")), F.lit(5)).alias("dots"),
    )
    absent = rows.where("generator < 0").select("row", "doc_id", "digest")
    return absent.unionByName(described, allowMissingColumns=True)


def clustered(found: DataFrame) -> DataFrame:
    """Candidates with ``cluster``, the overlapping stretch they lie in, and ``covered``: does a
    validated span lie in it?"""
    order = Window.partitionBy("row").orderBy("start", "end", "kind_no")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") < reach, 0).otherwise(1)
    numbered = found.withColumn("fresh", fresh).withColumn("cluster", F.sum("fresh").over(order))
    together = Window.partitionBy("row", "cluster")
    return numbered.withColumn("covered", F.max("base").over(together)).drop("fresh")


def learn(found: DataFrame) -> tuple[tuple, dict[str, float]]:
    """The boosted trees and a threshold per kind.

    To the driver come counts by feature row; the features are bins, so their number is bounded
    by the bins and not by the corpus. Documents whose hash is 0 mod 4 only calibrate.
    """
    spans = found.where("kind IS NOT NULL")
    held = (F.pmod(F.xxhash64("row"), F.lit(4)) == 0).alias("held")
    rows = (
        spans.groupBy(*FEATURES, held)
        .agg(F.count_if("covered").alias("pos"), F.count_if(~F.col("covered")).alias("neg"))
        .collect()
    )
    if not rows:
        return (0.0, []), dict.fromkeys(KINDS, 2.0)
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    counts = np.array([[r["pos"], r["neg"]] for r in rows], float)
    calibrates = np.array([r["held"] for r in rows])
    order = np.lexsort(x.T)
    x, counts, calibrates = x[order], counts[order], calibrates[order]
    used = ~calibrates if (~calibrates).any() else calibrates
    model = boosting.fit(x[used], counts[used, 0], counts[used, 1])
    score = boosting.predict(model, x)
    thresholds = {}
    for number, kind in enumerate(KINDS):
        mine = calibrates & (x[:, 0] == number)
        best = 2.0  # above any score
        for t in np.unique(score[mine])[::-1]:
            pos, neg = counts[mine & (score >= t)].sum(axis=0)
            if pos < PRECISION * (pos + neg):
                break
            best = max(0.5, float(t))
        thresholds[kind] = best
    return model, thresholds


def spans(docs: DataFrame) -> DataFrame:
    """All accepted spans: ``row, doc_id, kind, start, end, base, score``.

    Documents without any have one row with nulls. Accepted are validated spans, and in each
    overlapping stretch without one the best candidate that reaches its kind's threshold.
    """
    found = stage(candidates(docs), "pii-candidates")
    marked = stage(clustered(found.where("kind IS NOT NULL")), "pii-clusters")
    model, thresholds = learn(marked)
    score = boosting.expression(model, FEATURES)
    least = F.lit(2.0)
    for kind, t in thresholds.items():
        least = F.when(F.col("kind") == kind, t).otherwise(least)
    together = Window.partitionBy("row", "cluster").orderBy(F.desc("score"), "start", F.desc("end"), "kind_no")
    ranked = marked.withColumn("score", score).withColumn("rank", F.row_number().over(together))
    # the validated patterns of one kind never overlap, so each stands
    kept = ranked.where(F.col("base") | (~F.col("covered") & (F.col("rank") == 1) & (F.col("score") >= least)))
    columns = ["row", "doc_id", "digest", "kind", "start", "end", "base", "score"]
    absent = found.where("kind IS NULL").select("row", "doc_id", "digest")
    return absent.unionByName(kept.select(columns), allowMissingColumns=True)


def _written(only_base: bool) -> Column:
    """Spans of a document as ``kind:start:end``, by start and then kind as listed."""
    number = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("kind"))
    wanted = F.col("base") if only_base else F.col("kind").isNotNull()
    row = F.when(wanted, F.struct("start", number.alias("number"), "end", "kind"))
    text = F.transform(
        F.array_sort(F.collect_list(row)), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])
    )
    return F.array_join(text, ",")


def report(found: DataFrame) -> DataFrame:
    """Counts and spans per document (a text's own spans at most are gathered in one row)."""
    counts = [F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{k}") for k in KINDS]
    return (
        found.groupBy("row")
        .agg(F.first("doc_id").alias("doc_id"), *counts, _written(True).alias("written"), _written(False).alias("spans"))
        .select("doc_id", *(f"n_{k}" for k in KINDS), F.sha2("written", 256).alias("base_sha256"), "spans")
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every accepted span replaced by its kind, such as ``[EMAIL]``.

    Overlapping spans become one, named after the first. ``n_chars``, if there, follows the text.
    Texts are found again by id and content, so rows with equal ids do not mix.
    """
    found = spans(docs).where("kind IS NOT NULL").select("doc_id", "digest", "start", "end", "kind").distinct()
    line = Window.partitionBy("doc_id", "digest").orderBy("start", "end", "kind")
    reach = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    fresh = found.withColumn("fresh", F.when(F.col("start") < reach, 0).otherwise(1))
    islands = fresh.withColumn("island", F.sum("fresh").over(line)).groupBy("doc_id", "digest", "island")
    merged = islands.agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind")
    )
    before = F.coalesce(F.lag("end").over(Window.partitionBy("doc_id", "digest").orderBy("start")), F.lit(0))
    piece = F.struct("start", before.alias("before"), "end", "kind")
    edits = merged.select("doc_id", "digest", piece.alias("piece")).groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_list("piece")).alias("edits")
    )
    own_id, own_digest, own_edits = (free_name(docs, n) for n in ("_id", "_digest", "_edits"))
    edits = edits.select(F.col("doc_id").alias(own_id), F.col("digest").alias(own_digest), F.col("edits").alias(own_edits))
    text = F.col("text")
    parts = F.transform(
        own_edits,
        lambda x: F.concat(
            F.substring(text, x["before"] + 1, x["start"] - x["before"]), F.lit("["), F.upper(x["kind"]), F.lit("]")
        ),
    )
    tail = F.substring(text, F.element_at(own_edits, -1)["end"] + 1, F.length(text))
    changed = F.when(F.col(own_edits).isNull(), text).otherwise(F.concat(F.array_join(parts, ""), tail))
    same = F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(own_digest))
    out = docs.join(edits, same, "left").withColumn("text", changed)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


@query("op7_pii")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(spans(table(spark, sf_dir, "documents")))
