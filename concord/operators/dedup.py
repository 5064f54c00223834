"""First or last row per key.

``row_number() = 1`` lets Spark place a group limit before the shuffle, so each task
sends one row per key however many copies of a key it holds: a key that owns a third
of the table is reduced where it lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    spot = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_spot", spot).filter("_spot = 1").drop("_spot")


def first_per_key(df: DataFrame, key: Column | Sequence[Column], order) -> DataFrame:
    """First row per key in source order; null counts as one key value."""
    keys = [key] if isinstance(key, Column) else list(key)
    return _pick(df, keys, [F.col(o).asc() for o in order])


def last_per_key(df: DataFrame, key: Column | Sequence[Column], order) -> DataFrame:
    """Last row per key in source order: later rows win."""
    keys = [key] if isinstance(key, Column) else list(key)
    return _pick(df, keys, [F.col(o).desc() for o in order])


def first_per_present_key(df: DataFrame, key: Column, order) -> DataFrame:
    """First row per key; rows whose key is missing or empty are dropped."""
    return first_per_key(df.filter(key.isNotNull() & (key != "")), key, order)


def first_per_key_or_blank(df: DataFrame, key: Column, order) -> DataFrame:
    """First row per key, where all rows without a key share the empty one."""
    return first_per_key(df, F.coalesce(key, F.lit("")), order)


def key_or_alternative(key: Column, alternative: Column) -> Column:
    """The key, or another column where the key is missing or empty."""
    return F.coalesce(F.when(key.cast("string") != "", key), alternative)

