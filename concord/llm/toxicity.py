"""Toxic passages as maximum-scoring segments of token log-odds.

Units are words and word beginnings (inflected languages repeat a stem with many endings). A
unit scores the log of its odds in toxic against clean documents, smoothed by a Dirichlet prior
that follows the unit's overall frequency; only units that are significantly toxic score above
zero, any other token costs a little. A linear scan finds all maximal scoring segments of a
text. Under clean text the best segment follows an extreme-value law, which turns scores into
expected numbers by chance whatever the length of the text; a logistic curve over these gives
the probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import query, table, texts
from concord.session import stage

#: Lengths of the word beginnings that are units besides the word.
STEMS = (4, 5, 6, 7)
#: Pseudo-documents of the prior, and its least share per unit.
PRIOR, LEAST = 100.0, 0.25
#: Standard errors above zero that a unit's log-odds must have at least, and the share of the
#: model's units that may be there by chance; the more units are tested, the higher the level.
SIGNIFICANT, BY_CHANCE = 3.0, 0.05
#: Units that a task counts before it passes the counts on (memory only).
COUNTED = 1_000_000
#: Cost of a token that is not toxic.
DRIFT = 0.25
#: Labelled rows that the final curve is fitted on (by hash), at most.
FIT_ROWS = 20_000
#: A segment expected less often than this by chance in its text is significant.
E_VALUE = 0.05
THRESHOLD = 0.7
#: Words whose scores a task remembers.
REMEMBERED = 500_000

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Model:
    units: dict[str, tuple[float, int, int]]  # log-odds, toxic texts, clean texts
    toxic: int
    clean: int
    rate: float  # of the extreme-value law
    scale: float
    weights: tuple[float, ...]
    level: float = SIGNIFICANT  # standard errors that a unit of this model has at least


def held_out(doc_id: Column | str) -> Column:
    """Rows that nothing is learned from; a null id is one of them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def log_odds(t, c, toxic, clean, log=math.log):
    """Log-odds and its standard error, for numbers or columns."""
    a = PRIOR * (t + c) / (toxic + clean) + LEAST
    return (
        log((t + a) / (toxic + PRIOR - t + 1)) - log((c + a) / (clean + PRIOR - c + 1)),
        1 / (t + a) + 1 / (c + a),
    )


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, as (first, last, score), of a sequence in which the
    positions given have these positive scores and every other one has ``-drift``.

    A segment to the left is merged with a new one when the running total before it is lower and
    the total at its end is not higher than the new total. Each held segment knows the nearest one to
    its left with a lower total before it, so no step is taken twice: work is linear in the positions.
    """
    held: list[tuple[int, int, float, float, int]] = []  # first, last, total before, total after, nearest lower
    total, at = 0.0, 0
    for place, score in scores:
        total -= drift * (place - at)
        first, before = place, total
        total += score
        at = place + 1
        k = len(held) - 1
        while k >= 0 and held[k][2] >= before:
            k = held[k][4]
        while k >= 0 and held[k][3] < total:
            first, before, lower = held[k][0], held[k][2], held[k][4]
            del held[k:]
            k = lower
        held.append((first, place, before, total, k))
    return [(a, b, after - before) for a, b, before, after, _ in held]


def _units(word: str) -> list[str]:
    return [word, *(word[:n] for n in STEMS if n < len(word))]


class WordScores(dict):
    """Scores of words, worked out once per word; at most ``REMEMBERED`` are kept (speed only).

    ``reach`` holds the first four letters of all units; other words score nothing.
    """

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model
        self.reach = {u[:4] for u in model.units}

    def __missing__(self, word: str) -> float:
        score = 0.0
        for u in _units(word):
            if u in self.model.units:
                score = max(score, self.model.units[u][0])
        if len(self) < REMEMBERED:
            self[word] = score
        return score


def token_scores(words: list[str], scores: WordScores, own: int | None = None) -> list[tuple[int, float]]:
    """Positive tokens with their scores. ``own``: the label of this text, if the model has
    learned from it; its own part is then taken out."""
    reach = scores.reach
    found = [(i, s) for i, w in enumerate(words) if w[:4] in reach and (s := scores[w]) > 0]
    if own is None:
        return found
    model, left = scores.model, []
    for i, _ in found:
        best = 0.0
        for u in _units(words[i]):
            if u in model.units:
                _, t, c = model.units[u]
                score, variance = log_odds(t - (own == 1), c - (own == 0), model.toxic, model.clean)
                if score >= model.level * math.sqrt(variance):
                    best = max(best, score)
        if best > 0:
            left.append((i, best))
    return left


def _features(found: list[tuple[int, int, float]], length: int, model: Model) -> list[float]:
    """What the curve sees: surprise of the best segment and of all significant ones, length."""
    space = math.log(max(1.0, model.scale * length))
    surprise = sorted((model.rate * s - space for _, _, s in found), reverse=True)
    best = max(0.0, surprise[0]) if surprise else 0.0
    rest = sum(x for x in surprise[1:] if x > -math.log(E_VALUE))
    return [1.0, min(best, 40.0), math.sqrt(best), math.log1p(rest), math.log1p(length)]


def unit_counts(labelled: DataFrame) -> DataFrame:
    """``unit, t, c``: toxic and clean texts that have a word or word beginning.

    Every distinct text counts once for a unit, whatever the number of its words that share the
    beginning, so neither copies nor endings make a unit look toxic. Counts are added up per
    task before they are shuffled.
    """

    def counted(counts: tuple[Counter, Counter]) -> pa.RecordBatch:
        units = list(counts[0] | counts[1])
        t, c = ([counts[k][u] for u in units] for k in (1, 0))
        return pa.RecordBatch.from_arrays([pa.array(units, pa.string()), pa.array(t, pa.int64()), pa.array(c, pa.int64())], names=["unit", "t", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                words = set(_WORD.findall(text.lower()))
                counts[toxic].update({u for w in words for u in _units(w)})
                if len(counts[0]) + len(counts[1]) > COUNTED:
                    yield counted(counts)
                    counts = (Counter(), Counter())
        yield counted(counts)

    units = labelled.select("text", "toxic").mapInArrow(run, "unit string, t long, c long")
    return units.groupBy("unit").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def level_of(rated: DataFrame) -> float:
    """The least ``z`` from which on at most ``BY_CHANCE`` of the units can be there by chance,
    given how many ``rated`` units there are (Benjamini and Hochberg, in steps of 0.01)."""
    step = F.when(F.col("z") >= SIGNIFICANT, F.floor(F.least("z", F.lit(40.0)) * 100))
    found = {r[0]: r[1] for r in rated.groupBy(step.alias("step")).agg(F.count(F.lit(1))).collect()}
    tested, held, level = sum(found.values()), 0, math.inf
    for k in sorted((k for k in found if k is not None), reverse=True):
        held += found[k]
        if tested * 0.5 * math.erfc(k / 100 / math.sqrt(2)) <= BY_CHANCE * held:
            level = k / 100
    return level


def _law(units: dict[str, tuple[float, int, int]], clean_tokens: float) -> tuple[float, float]:
    """Rate and scale of the extreme-value law of the best segment in clean text.

    The rate solves ``sum p e^(rate s) = 1`` over the token scores of clean text; every place can
    begin a segment, which sets the scale.
    """
    rates = [(s, (c + LEAST) / clean_tokens) for s, _, c in units.values()]
    if not rates:
        return 1.0, 1.0
    positive = min(0.5, sum(p for _, p in rates))

    def excess(x: float) -> float:
        return sum(p * math.exp(x * s) for s, p in rates) + (1 - positive) * math.exp(-x * DRIFT) - 1

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high, max(1e-6, positive)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        g = x.T @ (y - p) - ridge * w
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from labelled rows that are not held out.

    Counts cover all of them. Null labels and labels without a document teach nothing; a
    document labelled twice is toxic if one of its labels is. Without labels every text
    scores alike. To the driver come the significant units, and the scored features of at most
    ``fit_rows`` rows, chosen by hash.
    """
    marks = labels.where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = stage(marks, "toxic-marks")  # its size is known to the join, which moves texts only if it must
    known = texts(docs).where(~held_out("doc_id")).join(marks, "doc_id")
    by_text = known.groupBy(F.xxhash64("text").alias("h"), "text").agg(F.max("toxic").cast("int").alias("toxic"))
    labelled = stage(by_text, "toxic-labelled")
    sums = labelled.agg(
        F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.size(F.split("text", " "))), F.lit(0))
    ).first()
    toxic, clean, tokens = int(sums[0]), int(sums[1] - sums[0]), float(sums[2])
    if not toxic or not clean:
        return Model({}, toxic, clean, 1.0, 1.0, (math.log((toxic + 0.5) / (clean + 0.5)), 0.0, 0.0, 0.0, 0.0))
    score, variance = log_odds(F.col("t"), F.col("c"), toxic, clean, F.log)
    rated = unit_counts(labelled).where("t >= 2").withColumns({"score": score, "z": score / F.sqrt(variance)})
    rated = stage(rated, "toxic-units")
    level = level_of(rated)
    best = rated.where(F.col("z") >= level).orderBy(F.desc("z"), "unit").collect()
    units = {r["unit"]: (r["score"], int(r["t"]), int(r["c"])) for r in best}
    rate, scale = _law(units, max(1.0, tokens * clean / (toxic + clean)))
    model = Model(units, toxic, clean, rate, scale, (0.0,) * 5, level)
    share = min(1.0, 0.9 * fit_rows / (toxic + clean))
    chosen = labelled.where(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = scored(chosen.select(F.col("h").alias("doc_id"), "text", "toxic"), model, own=True)
    # by hash, so that every task keeps its own first rows; a bare limit would scan task after task
    rows = rows.orderBy("doc_id").limit(fit_rows).select("toxic", "features").collect()
    if not rows:
        return model
    x, y = np.array([r["features"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    return replace(model, weights=tuple(_logistic(x, y).tolist()))


def probability(features: list[float], weights: tuple[float, ...]) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, sum(a * b for a, b in zip(features, weights, strict=True))))))


def scored(docs: DataFrame, model: Model, own: bool = False) -> DataFrame:
    """``doc_id, score, features`` of every row (and ``toxic``, if ``own`` labels are left out)."""
    schema = "doc_id long, score double, features array<double>" + (", toxic int" if own else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model)
        for batch in batches:
            labels = batch["toxic"].to_pylist() if own else [None] * batch.num_rows
            out = []
            for text, label in zip(batch["text"].to_pylist(), labels, strict=True):
                words = _WORD.findall(text.lower())
                found = segments(token_scores(words, known, label))
                out.append(_features(found, len(words), model))
            columns = [
                batch["doc_id"],
                pa.array([probability(f, model.weights) for f in out], pa.float64()),
                pa.array(out, pa.list_(pa.float64())),
            ]
            names = ["doc_id", "score", "features"]
            if own:
                columns, names = [*columns, batch["toxic"]], [*names, "toxic"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text", *(["toxic"] if own else [])).mapInArrow(run, schema)


def score_of(text: Column, model: Model) -> Column:
    """The score as a column, for filters on rows that keep all their columns."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = WordScores(model)
        for content in batches:
            out = []
            for t in content:
                words = _WORD.findall((t or "").lower())
                found = segments(token_scores(words, known))
                out.append(probability(_features(found, len(words), model), model.weights))
            yield pd.Series(out, dtype="float64")

    return score(text)


def passages(docs: DataFrame, model: Model, e_value: float = E_VALUE) -> DataFrame:
    """Every significant passage: ``doc_id, first_word, last_word, score, e_value, passage``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordScores(model)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = _WORD.findall(text.lower())
                for a, b, s in segments(token_scores(words, known)):
                    e = model.scale * len(words) * math.exp(-min(700.0, model.rate * s))
                    if e < e_value:
                        rows.append((doc_id, a, b, s, e, " ".join(words[a : b + 1])))
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.string())
            names = ["doc_id", "first_word", "last_word", "score", "e_value", "passage"]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, first_word int, last_word int, score double, e_value double, passage string"
    return texts(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; null and empty texts have no tokens and
    get the score of an empty text; rows with equal or null ids are scored one by one."""
    rows = scored(texts(docs), model)
    return rows.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, train(docs, table(spark, sf_dir, "labels")))
