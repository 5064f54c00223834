"""Cells that know whether they are wrong.

A cell is a value, a null, or a reason to reject its whole row; the three stay apart
until the row is split into good and quarantined.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Checked(NamedTuple):
    value: Column
    #: Boolean column, never null: true when the row must be rejected.
    wrong: Column


def clean(value: Column) -> Checked:
    return Checked(value, F.lit(False))


def matching(value: Column, pattern: str) -> Checked:
    """Null passes; a non-null value must match the whole pattern."""
    wrong = F.coalesce(~value.rlike(pattern), F.lit(False))
    return Checked(F.when(~wrong, value), wrong)
