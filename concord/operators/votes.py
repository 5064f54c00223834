"""Voting rules on ordered arrays: one value from the reports of a bounded group.

Each rule takes and gives SQL text over columns of a grouped frame, for ``selectExpr``;
all are built-in array functions, decimals stay decimals and no average is made up. The
distributed forms for groups of any size are in :mod:`concord.operators.wide`.
"""

from __future__ import annotations

from collections.abc import Sequence

# Rule parameters.
DEFAULT_MAX_DEVIATION = "0.3"
RANGE_FLOOR = "0.9"
RANGE_CEILING = "1.1"


def reports(rows: str, field: str) -> str:
    """A field of every row of the group, nulls included."""
    return f"transform({rows}, r -> r.{field})"


def known(values: str) -> str:
    return f"filter({values}, v -> v IS NOT NULL)"


def cells(rows: str, field: str, order: Sequence[str]) -> str:
    """A field of every row that has it, as ``struct(o, v)`` with the row's place."""
    place = ", ".join(f"r.{c}" for c in order)
    cell = f"CASE WHEN r.{field} IS NOT NULL THEN struct(struct({place}) AS o, r.{field} AS v) END"
    return f"filter(transform({rows}, r -> {cell}), c -> c IS NOT NULL)"


def placed(rows: str, field: str, order: Sequence[str]) -> str:
    """The cells in order. Equal places are told apart by the value, so the order never depends on other fields."""
    return f"sort_array({cells(rows, field, order)})"


def plain(cells: str) -> str:
    """The values of placed cells."""
    return f"transform({cells}, c -> c.v)"


def mode_first(cells: str) -> str:
    """Most frequent value of cells in any order; ties go to the one seen first. None without cells.

    Sorted by value, equal values are runs; a run's length is its votes and its first cell the
    earliest. (``transform(array(x), s -> ...)[0]`` works ``x`` out once.)
    """
    by_value = f"sort_array(transform({cells}, c -> struct(c.v AS v, c.o AS o)))"
    starts = "filter(sequence(0, size(s) - 1), i -> i = 0 OR s[i].v <> s[i - 1].v)"
    stops = "concat(slice(t, 2, size(t)), array(size(s)))"
    runs = f"zip_with(t, {stops}, (a, b) -> struct(a - b AS fewer, s[a].o AS o, s[a].v AS v))"
    best = f"transform(array({starts}), t -> array_min({runs}).v)[0]"
    one = "element_at(s, 1).v = element_at(s, -1).v"
    return f"CASE WHEN size({cells}) > 0 THEN transform(array({by_value}), s -> CASE WHEN {one} THEN s[0].v ELSE {best} END)[0] END"


def low_median(ordered: str) -> str:
    """Middle element of an ascending array, the lower of two; null for none."""
    return f"get({ordered}, int((size({ordered}) - 1) div 2))"


def middle_sum(ordered: str) -> str:
    """Twice the averaged median of an ascending array, which avoids a division."""
    upper = f"get({ordered}, int(size({ordered}) div 2))"
    return f"{low_median(ordered)} + {upper}"


def zero_scale(ordered: str, twice_median: str) -> str:
    """Twice the median magnitude, worked out only where the median is zero."""
    sizes = f"sort_array(transform({ordered}, v -> abs(v)))"
    middle = middle_sum("s")
    return f"CASE WHEN {twice_median} = 0 THEN transform(array({sizes}), s -> {middle})[0] END"


def deviation(twice_median: str, share: str) -> str:
    """How far twice a value may be from twice the median."""
    return f"{share} * abs({twice_median})"


def within_deviation(values: str, twice_median: str, twice_scale: str, share: str, far: str | None = None) -> str:
    """Values strictly closer to the averaged median than the given share of it.

    With a zero median the scale is the median magnitude; if that is zero as well, or
    there are fewer than two values, all are kept. ``twice_median``, ``twice_scale`` and ``far``, the
    :func:`deviation`, should be columns of their own: the filter reads them for every element.
    """
    near = f"filter({values}, v -> abs(v * 2 - {twice_median}) < {far or deviation(twice_median, share)})"
    small = f"filter({values}, v -> abs(v) * 2 < {share} * {twice_scale})"
    return (
        f"CASE WHEN size({values}) < 2 THEN {values} WHEN {twice_median} <> 0 THEN {near} "
        f"WHEN {twice_scale} = 0 THEN {values} ELSE {small} END"
    )


def union_ordered(arrays: str) -> str:
    """Distinct non-blank elements in order of first appearance; empty is null."""
    merged = f"array_distinct(filter(flatten({arrays}), e -> trim(e) <> ''))"
    return f"CASE WHEN size({merged}) > 0 THEN {merged} END"


def with_quorum(sources: str, vote: str, min_sources: int) -> str:
    return f"CASE WHEN {sources} >= {int(min_sources)} THEN {vote} END"


def is_complete(last: str, low: str, high: str) -> str:
    return f"({last} IS NOT NULL AND {low} IS NOT NULL AND {high} IS NOT NULL)"


def is_consistent(last: str, low: str, high: str) -> str:
    """Complete, bounds not inverted, price within a tenth outside the bounds."""
    return (
        f"coalesce({low} <= {high} AND {low} * {RANGE_FLOOR} <= {last} "
        f"AND {last} <= {high} * {RANGE_CEILING}, false)"
    )
