"""Display forms used by the report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def display_date(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "dd/MM/yyyy"), F.lit(""))


def _fixed(v: Column, places: int) -> Column:
    return F.regexp_replace(F.format_number(v, places), ",", "")


def display_usd(v: Column) -> Column:
    """``$1.23T``, ``$1.23B``, ``$123M`` or ``$1,234``, ties by the exact binary value."""
    v = v.cast("double")
    scaled = (
        F.when(v >= 1e12, F.concat(_fixed(v / 1e12, 2), F.lit("T")))
        .when(v >= 1e9, F.concat(_fixed(v / 1e9, 2), F.lit("B")))
        .when(v >= 1e6, F.concat(_fixed(v / 1e6, 0), F.lit("M")))
        .otherwise(F.format_number(v, 0))
    )
    return F.concat(F.lit("$"), scaled)
