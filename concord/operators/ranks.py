"""Exact order statistics of groups of any size.

A group's values are never collected, and every size takes the same path. Equal values are
counted before the shuffle and dealt out by ranges of (group, value), so a group spreads over
as many tasks as its values need and a heavy value is one row. Each range is summed up; the
sums, one row per range and group, are added from the left, which tells the range that holds a
rank; within it the counts are added again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.session import stage


def counted(values: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Distinct non-null values per group with their ``copies``."""
    rows = values.filter(F.col(value).isNotNull())
    return rows.groupBy(*group, value).agg(F.count(F.lit(1)).alias("copies"))


def join_same(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of both sides in which null equals null; they appear once."""
    other = right.withColumnsRenamed({c: f"_same_{c}" for c in columns})
    alike = [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in columns]
    return left.join(other, reduce(Column.__and__, alike, F.lit(True)), how).drop(*[f"_same_{c}" for c in columns])


def pick_ranks(
    values: DataFrame, group: Sequence[str], value: str, ranks: dict[str, str], copies: str | None = None
) -> DataFrame:
    """For each group the value at each zero-based rank.

    ``ranks`` names the results; each expression is SQL over the group size ``n``, such
    as ``(n - 1) div 2``. Returns the group columns, ``n`` and one column per rank. Null
    values are ignored; a null group is a group. ``copies`` names a column that says how
    often a row's value counts.
    """
    group = list(group)
    if copies is None:
        counts = counted(values, group, value)
    else:
        known = values.filter(F.col(value).isNotNull())
        counts = known.groupBy(*group, value).agg(F.sum(copies).alias("copies"))
    # staged, because dealing by ranges reads its input twice
    ordered = stage(counts, "rank-values").repartitionByRange(*group, value).sortWithinPartitions(*group, value)
    counts = stage(ordered.withColumn("_part", F.spark_partition_id()), "rank-counts")

    sums = counts.groupBy("_part", *group).agg(F.sum("copies").alias("inside"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = sums.withColumns(
        {
            "n": F.sum("inside").over(whole),
            "before": F.coalesce(F.sum("inside").over(earlier), F.lit(0)),
        }
    )
    wanted = F.explode(
        F.array(*[F.struct(F.lit(k).alias("name"), F.expr(e).cast("bigint").alias("at")) for k, e in ranks.items()])
    )
    picks = placed.select("*", wanted.alias("w")).filter("w.at >= before AND w.at < before + inside")
    picks = picks.select(*group, "_part", "n", "before", "w.name", "w.at")

    held = join_same(counts, picks, [*group, "_part"]).withColumn("at", F.col("at") - F.col("before"))
    upto = F.sum("copies").over(Window.partitionBy(*group, "_part", "name").orderBy(value))
    hit = held.withColumn("upto", upto).filter("at < upto AND at >= upto - copies")
    chosen = [F.max(F.when(F.col("name") == k, F.col(value))).alias(k) for k in ranks]
    return hit.groupBy(*group, "n").agg(*chosen)


def low_median(values: DataFrame, group: Sequence[str], value: str, copies: str | None = None) -> DataFrame:
    """Low median per group as column ``low_median``: always a reported value."""
    return pick_ranks(values, group, value, {"low_median": "(n - 1) div 2"}, copies)


def upper_median(values: DataFrame, group: Sequence[str], value: str, copies: str | None = None) -> DataFrame:
    """Element at offset ``n div 2`` per group as column ``upper_median``."""
    return pick_ranks(values, group, value, {"upper_median": "n div 2"}, copies)


def median_pair(values: DataFrame, group: Sequence[str], value: str, copies: str | None = None) -> DataFrame:
    """Both middle values; the averaged median is half their sum."""
    return pick_ranks(values, group, value, {"mid_lo": "(n - 1) div 2", "mid_hi": "n div 2"}, copies)
