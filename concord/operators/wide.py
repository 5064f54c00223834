"""The merge rules as distributed aggregations, for groups of any size.

No group is ever collected. Equal values are counted before the shuffle, so copies of a
hot key's values collapse where they lie; medians are picked from sorted ranges
(:mod:`concord.operators.ranks`); name clusters come from a similarity join
(:mod:`concord.operators.clusters`). Results equal those of the array rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.operators import ranks, votes
from concord.operators.clusters import fuzzy_wide
from concord.operators.golden import MIN_CONSISTENT, PriceRange, Rule, Strategy
from concord.session import stage


def mode_wide(df: DataFrame, group: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Mode with ties to the first seen (then to the smaller value), as column ``mode`` (and ``sources``)."""
    tally = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct(*order)).alias("first_seen"))
    )
    best = F.min(F.struct((-F.col("votes")).alias("votes"), "first_seen", F.col(value).alias("value")))
    return tally.groupBy(*group).agg(best["value"].alias("mode"), F.sum("votes").alias("sources"))


def deviation_wide(
    values: DataFrame, group: Sequence[str], value: str, max_deviation: Column, copies: str | None = None
) -> DataFrame:
    """Rows within the deviation band around the averaged median of their group.

    A null group is a group; null values are dropped. ``copies`` says how often a row counts.
    """
    group = list(group)
    rows = values.filter(F.col(value).isNotNull())
    middle = ranks.median_pair(rows, group, value, copies).select(
        *group, F.col("n").alias("_n"), (F.col("mid_lo") + F.col("mid_hi")).alias("_twice")
    )
    middle = stage(middle, "middles")
    joined = ranks.join_same(rows, middle, group)
    v, n, twice, spread = F.col(value), F.col("_n"), F.col("_twice"), F.col("_scale")
    near = F.abs(v * 2 - twice) < max_deviation * F.abs(twice)
    centred = middle.filter((F.col("_n") >= 2) & (F.col("_twice") == 0))
    if centred.isEmpty():
        return joined.filter((n < 2) | near).drop("_n", "_twice")
    sizes = ranks.join_same(rows, centred.select(*group), group, "left_semi").withColumn("_size", F.abs(value))
    scale = ranks.median_pair(sizes, group, "_size", copies).select(
        *group, (F.col("mid_lo") + F.col("mid_hi")).alias("_scale")
    )
    scale = stage(scale, "scales")
    both = ranks.join_same(joined, scale, group, "left")
    keep = (
        F.when((n < 2) | (spread == 0), True)
        .when(twice != 0, near)
        .otherwise(F.abs(v) * 2 < max_deviation * spread)
    )
    return both.filter(keep).drop("_n", "_twice", "_scale")


def union_wide(df: DataFrame, group: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Ordered set union of array cells as column ``merged``; the cell is the result."""
    place = F.struct(*order, F.col(value).alias("_cell")).alias("_ord")
    items = df.select(*group, place, F.posexplode(value).alias("_at", "_item"))
    kept = items.filter(F.col("_item").isNotNull() & (F.length(F.trim("_item")) > 0))
    first = kept.groupBy(*group, "_item").agg(F.min(F.struct("_ord", "_at")).alias("_seen"))
    ordered = F.sort_array(F.collect_list(F.struct("_seen", "_item")))
    return first.groupBy(*group).agg(F.transform(ordered, lambda s: s["_item"]).alias("merged"))


def _long(df: DataFrame, key: str, fields: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per non-null cell: ``key, field, order..., value``."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]))
    rows = df.select(key, *order, cells.alias("c")).select(key, *order, "c.field", "c.value")
    return rows.filter(F.col("value").isNotNull())


def _pivot(df: DataFrame, key: str, fields: Sequence[str], value: str) -> DataFrame:
    picks = [F.max(F.when(F.col("field") == f, F.col(value))).alias(f) for f in fields]
    return df.groupBy(key).agg(*picks)


def _per_field(values: dict[str, object], kind: str) -> Column:
    pairs = [x for f, v in values.items() for x in (F.lit(f), F.lit(v).cast(kind))]
    return F.try_element_at(F.create_map(*pairs), F.col("field"))


def _by_type(df: DataFrame, rules: Mapping[str, Rule]) -> list[dict[str, Rule]]:
    """Rules of fields that share a data type: only those may share a column of cells."""
    kinds: dict[str, dict[str, Rule]] = {}
    for f, r in rules.items():
        kinds.setdefault(df.schema[f].dataType.simpleString(), {})[f] = r
    return list(kinds.values())


def merge_wide(
    df: DataFrame,
    key: str,
    rules: Mapping[str, Rule],
    order: Sequence[str],
    price_range: PriceRange | None,
) -> DataFrame:
    """Distributed merge; same columns, types and values as the array merge.

    Medians need no order, so their cells are counted once and everything after works on counts.
    """
    rows = stage(df.select(key, *order, *rules), "oversize-rows")
    keys = rows.select(key).distinct()
    by_kind: dict[Strategy, dict[str, Rule]] = {}
    for f, r in rules.items():
        by_kind.setdefault(r.strategy, {})[f] = r
    parts: list[DataFrame] = []

    for modes in _by_type(rows, by_kind.get(Strategy.MODE, {})):
        tally = mode_wide(_long(rows, key, list(modes), order), [key, "field"], "value", order)
        quorum = _per_field({f: r.min_sources for f, r in modes.items()}, "int")
        parts.append(_pivot(tally.filter(F.col("sources") >= quorum), key, list(modes), "mode"))

    for medians in _by_type(rows, by_kind.get(Strategy.MEDIAN, {})):
        cells = ranks.counted(_long(rows, key, list(medians), []), [key, "field"], "value")
        banded = {f: r.max_deviation for f, r in medians.items() if r.max_deviation is not None}
        if banded:
            cells = stage(cells, "median-cells")
            inside = F.col("field").isin(*banded)
            share = _per_field(banded, "decimal(4,3)")
            near = deviation_wide(cells.filter(inside), [key, "field"], "value", share, "copies")
            cells = near.unionByName(cells.filter(~inside))
        middle = ranks.low_median(cells, [key, "field"], "value", "copies")
        quorum = _per_field({f: r.min_sources for f, r in medians.items()}, "int")
        parts.append(_pivot(middle.filter(F.col("n") >= quorum), key, list(medians), "low_median"))

    for f, r in by_kind.get(Strategy.UNION, {}).items():
        quorate = rows.groupBy(key).count().filter(F.col("count") >= r.min_sources).select(key)
        merged = union_wide(rows, [key], f, order).withColumnRenamed("merged", f)
        parts.append(merged.join(quorate, key, "left_semi"))

    for f, r in by_kind.get(Strategy.FUZZY, {}).items():
        chosen = fuzzy_wide(rows, [key], f, order, r.threshold).filter(F.col("sources") >= r.min_sources)
        parts.append(chosen.select(key, F.col("chosen").alias(f)))

    merged = reduce(lambda left, part: left.join(part, key, "left"), parts, keys)
    if price_range:
        merged = _joint_prices_wide(rows, merged, key, order, price_range)
    return merged.select(key, *rules)


def _joint_prices_wide(rows, merged, key, order, p: PriceRange) -> DataFrame:
    consistent = votes.is_consistent(*p.columns)
    cells = _long(rows.filter(consistent), key, p.columns, order)
    middle = ranks.low_median(cells, [key, "field"], "value")
    joint = _pivot(middle.filter(F.col("n") >= MIN_CONSISTENT), key, p.columns, "low_median")
    joint = joint.select(key, *[F.col(c).alias(f"_joint_{c}") for c in p.columns])
    both = merged.join(joint, key, "left")
    enough = F.col(f"_joint_{p.last}").isNotNull()
    upright = ~F.coalesce(F.col(p.low) > F.col(p.high), F.lit(False))
    return both.withColumns(
        {
            p.last: F.when(enough, F.col(f"_joint_{p.last}")).otherwise(F.col(p.last)),
            p.low: F.when(enough, F.col(f"_joint_{p.low}")).when(upright, F.col(p.low)),
            p.high: F.when(enough, F.col(f"_joint_{p.high}")).when(upright, F.col(p.high)),
        }
    )
