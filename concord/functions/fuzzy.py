"""Arrow UDFs over the similarity scores.

Only the scores run in Python. Grouping, ordering and counting stay in Spark, and
callers pass nulls for every row that can be decided without a score.
"""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions.similarity import (
    folded,
    ratio,
    token_set_ratio,
    weighted_ratio,
)
from concord.functions.text import root_symbol

# Score limits.
NAME_THRESHOLD = 90
SCORE_CUTOFF = 70.0
SAME_ROOT_SCORE = 100.0


def leaders_of(values, threshold: float) -> list[int]:
    """Places of the first-come leaders: a value that matches no earlier leader becomes one."""
    places: list[int] = []
    for place, value in enumerate(values):
        if leader_index(value, [values[k] for k in places], threshold) is None:
            places.append(place)
    return places


def leader_index(value: str, leaders, threshold: float) -> int | None:
    for at, leader in enumerate(leaders):
        if leader == value or token_set_ratio(value, leader) >= threshold:
            return at
    return None


def heaviest_leader(values, threshold: float) -> str | None:
    """Leader of the heaviest cluster; a spelling seen n times weighs n squared.

    Equal weights go to the cluster that started first. Text without a word matches
    nothing, not even its own copies, so it weighs n.
    """
    counts = Counter(values)
    weights: dict[str, int] = {}
    for value, n in counts.items():
        at = leader_index(value, weights, threshold)
        leader = value if at is None else list(weights)[at]
        weights[leader] = weights.get(leader, 0) + (n * n if value.split() else n)
    return max(weights, key=weights.get, default=None)


def vote_udf(thresholds: dict[str, float]):
    """UDF: one ordered array of spellings per field -> struct of chosen spellings."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in thresholds])
    limits = list(thresholds.values())

    @F.pandas_udf(schema)
    def votes(*columns: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            {
                field: [None if v is None else heaviest_leader(v, limit) for v in column]
                for field, limit, column in zip(thresholds, limits, columns)
            }
        )

    return votes


def fuzzy_votes(arrays: dict[str, Column], thresholds: dict[str, float]) -> Column:
    """Struct of voted spellings for ordered arrays (nulls already removed).

    An array with one distinct spelling never reaches Python: its answer is added
    back by :func:`settled_or_voted`.
    """
    contested = [F.when(F.size(F.array_distinct(a)) > 1, a) for a in arrays.values()]
    return vote_udf(thresholds)(*contested)


def settled_or_voted(array: str, voted: str) -> str:
    """SQL text: the only spelling of an array, or the vote where there are several."""
    return f"CASE WHEN size(array_distinct({array})) <= 1 THEN get({array}, 0) ELSE {voted} END"


# A candidate comes up at several levels of a search, one near the other.


@lru_cache(maxsize=200_000)
def _folded_ratio(actual: str, expected: str) -> float:
    return ratio(folded(actual), folded(expected))


@lru_cache(maxsize=200_000)
def _folded_weighted(actual: str, expected: str) -> float:
    return weighted_ratio(folded(actual), folded(expected))


@F.pandas_udf(T.DoubleType())
def _symbol_ratio(actual: pd.Series, expected: pd.Series) -> pd.Series:
    pairs = zip(actual, expected)
    scores = [
        None if a is None or e is None else _folded_ratio(a, e) for a, e in pairs
    ]
    return pd.Series(scores, dtype="float64")


@F.pandas_udf(T.DoubleType())
def _name_ratio(actual: pd.Series, expected: pd.Series) -> pd.Series:
    pairs = zip(actual, expected)
    scores = [
        None if a is None or e is None else _folded_weighted(a, e) for a, e in pairs
    ]
    return pd.Series(scores, dtype="float64")


def symbol_score(actual: Column, expected: Column) -> Column:
    """100 for equal roots, else the full-text ratio, zero below the cut-off."""
    same = root_symbol(actual) == root_symbol(expected)
    scored = _symbol_ratio(F.when(~same, actual), F.when(~same, expected))
    return F.when(same, SAME_ROOT_SCORE).when(scored >= SCORE_CUTOFF, scored).otherwise(0.0)


def name_score(actual: Column, expected: Column) -> Column:
    """Weighted ratio of the folded names, zero below the cut-off."""
    same = F.lower(actual) == F.lower(expected)
    worded = same & expected.rlike(r"[\p{L}\p{N}_]")
    scored = _name_ratio(F.when(~worded, actual), F.when(~worded, expected))
    return F.when(worded, 100.0).when(scored >= SCORE_CUTOFF, scored).otherwise(0.0)


def candidate_score(
    actual_symbol: Column, actual_name: Column, symbol: Column, name: Column
) -> Column:
    """Symbol score plus name score, or zero when either is below its cut-off."""
    by_symbol, by_name = symbol_score(actual_symbol, symbol), name_score(actual_name, name)
    return F.when((by_symbol > 0) & (by_name > 0), by_symbol + by_name).otherwise(0.0)
