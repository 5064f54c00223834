"""Golden-record merge: one row per key, one rule per field.

Groups up to ``group_limit`` rows take one shuffle and are voted on as arrays. Larger
groups are never collected: they go to the distributed rules of
:mod:`concord.operators.wide`, which give the same result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.functions.fuzzy import NAME_THRESHOLD, fuzzy_votes, settled_or_voted
from concord.operators import votes
from concord.schema import ORDER_FIELDS
from concord.session import stage

#: Largest group that is voted on as an array inside one row.
GROUP_LIMIT = 1_000


class Strategy(Enum):
    MODE = "mode"
    MEDIAN = "median"
    FUZZY = "fuzzy"
    UNION = "union"


@dataclass(frozen=True)
class Rule:
    strategy: Strategy
    min_sources: int = 1
    max_deviation: str | None = votes.DEFAULT_MAX_DEVIATION
    threshold: float = NAME_THRESHOLD


MODE, FUZZY, UNION = Rule(Strategy.MODE), Rule(Strategy.FUZZY), Rule(Strategy.UNION)
#: One report is enough / two agreeing reports needed / two within a tighter band.
SINGLE = Rule(Strategy.MEDIAN)
PAIR = Rule(Strategy.MEDIAN, min_sources=2)
TIGHT_PAIR = Rule(Strategy.MEDIAN, min_sources=2, max_deviation="0.2")

# The rule of every record field but the key.
RECORD_RULES: dict[str, Rule] = {
    "name": FUZZY,
    "symbol": MODE,
    "isin": MODE,
    "cusip": MODE,
    "cik": MODE,
    "lei": MODE,
    "mics": UNION,
    "currency": MODE,
    "last_price": TIGHT_PAIR,
    "market_cap": TIGHT_PAIR,
    "fifty_two_week_min": TIGHT_PAIR,
    "fifty_two_week_max": TIGHT_PAIR,
    "dividend_yield": PAIR,
    "market_volume": PAIR,
    "held_insiders": SINGLE,
    "held_institutions": SINGLE,
    "short_interest": SINGLE,
    "share_float": SINGLE,
    "shares_outstanding": SINGLE,
    "total_debt": SINGLE,
    "revenue_per_share": SINGLE,
    "profit_margin": SINGLE,
    "gross_margin": SINGLE,
    "operating_margin": SINGLE,
    "free_cash_flow": SINGLE,
    "operating_cash_flow": SINGLE,
    "return_on_equity": PAIR,
    "return_on_assets": PAIR,
    "performance_1_year": PAIR,
    "revenue": PAIR,
    "ebitda": PAIR,
    "trailing_pe": PAIR,
    "price_to_book": PAIR,
    "trailing_eps": PAIR,
    "analyst_rating": MODE,
    "industry": FUZZY,
    "sector": FUZZY,
}
# Fixed value: how many consistent price records make the joint price vote valid.
MIN_CONSISTENT = 2

IDENTIFIER_RULES: dict[str, Rule] = {
    f: RECORD_RULES[f] for f in ("symbol", "name", "isin", "cusip", "cik", "lei")
}


@dataclass(frozen=True)
class PriceRange:
    """Three columns voted on together when enough rows agree with themselves."""

    last: str
    low: str
    high: str

    @property
    def columns(self) -> tuple[str, str, str]:
        return self.last, self.low, self.high


RECORD_RANGE = PriceRange("last_price", "fifty_two_week_min", "fifty_two_week_max")


def split_by_size(
    df: DataFrame, key: str, limit: int = GROUP_LIMIT
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary groups, and rows of groups above ``limit`` (None if there are none).

    The counting job reads the key column alone and combines before its shuffle.
    """
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    oversize = sizes.filter(F.col("_n") > limit).select(key)
    if oversize.isEmpty():
        return df, None
    oversize = stage(oversize, "oversize-keys")
    return df.join(oversize, key, "left_anti"), df.join(oversize, key, "left_semi")


def merge(
    df: DataFrame,
    key: str = "share_class_figi",
    rules: Mapping[str, Rule] = RECORD_RULES,
    order: Sequence[str] = ORDER_FIELDS,
    price_range: PriceRange | None = RECORD_RANGE,
    group_limit: int = GROUP_LIMIT,
    bounded: bool = False,
) -> DataFrame:
    """One merged row per key: the key and every field of ``rules``.

    ``bounded=True`` skips the size check for inputs whose group size is bounded by
    construction (for example one row per key and feed).
    """
    from concord.operators.wide import merge_wide

    rows = df.filter(F.col(key).isNotNull())
    if bounded:
        return merge_arrays(rows, key, rules, order, price_range)
    ordinary, oversize = split_by_size(rows, key, group_limit)
    merged = merge_arrays(ordinary, key, rules, order, price_range)
    if oversize is None:
        return merged
    return merged.unionByName(merge_wide(oversize, key, rules, order, price_range))


def merge_arrays(
    df: DataFrame,
    key: str,
    rules: Mapping[str, Rule],
    order: Sequence[str],
    price_range: PriceRange | None,
) -> DataFrame:
    """Merge of bounded groups: one shuffle, then array expressions."""
    fields = list(rules)
    grouped = df.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*order, *fields))).alias("_rows")
    )
    return vote_rows(grouped, key, rules, order, price_range)


def vote_rows(
    grouped: DataFrame,
    key: str,
    rules: Mapping[str, Rule],
    order: Sequence[str],
    price_range: PriceRange | None,
) -> DataFrame:
    """Apply the rules to a frame of ``key, _rows`` (ordered array of structs).

    Each step is a projection of its own, so that what a filter compares with is worked
    out once per group and not once per element.
    """
    medians = {f: r for f, r in rules.items() if r.strategy is Strategy.MEDIAN}
    fuzzy = {f: r.threshold for f, r in rules.items() if r.strategy is Strategy.FUZZY}
    banded = {f: r.max_deviation for f, r in medians.items() if r.max_deviation is not None}
    plain = [f for f in rules if f not in banded]
    joint = price_range is not None

    def reported(field: str) -> str:
        if field in medians:
            return f"sort_array({votes.known(votes.reports('_rows', field))})"
        if rules[field].strategy is Strategy.MODE:
            return votes.cells("_rows", field, order)
        return votes.plain(votes.placed("_rows", field, order))

    first = ["size(_rows) AS _sources", *(f"{reported(f)} AS {f}" for f in rules)]
    if joint:
        agree = votes.is_consistent(*[f"r.{c}" for c in price_range.columns])
        first.append(f"filter(_rows, r -> {agree}) AS _agreeing")
    steps = grouped.selectExpr(key, *first)

    kept = ["_sources", *plain, *(["_agreeing"] if joint else [])]
    if banded:
        middles = [f"{votes.middle_sum(f)} AS _mid_{f}" for f in banded]
        steps = steps.selectExpr("*", *middles)
        scales = [f"{votes.zero_scale(f, f'_mid_{f}')} AS _abs_{f}" for f in banded]
        bounds = [f"{votes.deviation(f'_mid_{f}', share)} AS _far_{f}" for f, share in banded.items()]
        steps = steps.selectExpr("*", *scales, *bounds)
        near = [
            f"{votes.within_deviation(f, f'_mid_{f}', f'_abs_{f}', share, f'_far_{f}')} AS {f}"
            for f, share in banded.items()
        ]
        steps = steps.selectExpr(key, *kept, *near)
    if fuzzy:
        steps = steps.withColumn("_fuzzy", fuzzy_votes({f: F.col(f) for f in fuzzy}, fuzzy))

    def voted(field: str, rule: Rule) -> str:
        vote = {
            Strategy.MODE: votes.mode_first,
            Strategy.MEDIAN: votes.low_median,
            Strategy.UNION: votes.union_ordered,
            Strategy.FUZZY: lambda f: settled_or_voted(f, f"_fuzzy.{f}"),
        }[rule.strategy](field)
        size = "_sources" if rule.strategy is Strategy.UNION else f"size({field})"
        return f"{votes.with_quorum(size, vote, rule.min_sources)} AS {field}"

    results = [voted(f, r) for f, r in rules.items()]
    if not joint:
        return steps.selectExpr(key, *results)
    p = price_range
    ordered = [f"sort_array(transform(_agreeing, r -> r.{c})) AS _joint_{c}" for c in p.columns]
    single = steps.selectExpr(key, *results, *ordered)
    return single.selectExpr(key, *[_joint_price(f, p) for f in rules])


def _joint_price(field: str, p: PriceRange) -> str:
    """Joint vote over the agreeing rows, else the single vote, where an inverted pair
    of bounds is nulled."""
    if field not in p.columns:
        return field
    ordered = f"_joint_{field}"
    alone = field
    if field != p.last:
        alone = f"CASE WHEN NOT coalesce({p.low} > {p.high}, false) THEN {field} END"
    enough = f"size({ordered}) >= {MIN_CONSISTENT}"
    return f"CASE WHEN {enough} THEN {votes.low_median(ordered)} ELSE {alone} END AS {field}"


def identifiers(df: DataFrame, key: str = "share_class_figi", **options) -> DataFrame:
    """Representative ids of each group, before enrichment."""
    options.setdefault("rules", IDENTIFIER_RULES)
    return merge(df, key, price_range=None, **options)


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows in total, distinct keys, and the rows beyond the first of each key."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, unique = F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))
    return sizes.agg(
        total.alias("total"), unique.alias("unique_keys"), (total - unique).alias("duplicates")
    )
