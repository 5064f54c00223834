"""Trade times and staleness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.schema import PRICE_SENSITIVE_FIELDS

# Fixed value: age in hours beyond which a quote is stale.
MAX_TRADE_AGE_HOURS = 36

_ISO_SHAPE = (
    r"^\d{4}-?\d{2}-?\d{2}"
    r"([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)


# The seconds of the years 1 to 9999, beyond which a time is unknown.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def iso_time(text: Column) -> Column:
    """ISO-8601 text, extended or compact; without an offset it is UTC; malformed text is null."""
    steps = (
        (r"^(\d{4})-?(\d{2})-?(\d{2})", "$1-$2-$3"),
        (r"[T ](\d{2}):?(\d{2}):?(\d{2})", "T$1:$2:$3"),
        (r"[T ](\d{2}):?(\d{2})(?=Z|[+-]|$)", "T$1:$2:00"),
        (r"[T ](\d{2})(?=Z|[+-]|$)", "T$1:00:00"),
        (r"(T.*[+-]\d{2}):?(\d{2})$", "$1:$2"),
        (",", "."),
    )
    extended = text
    for pattern, form in steps:
        extended = F.regexp_replace(extended, pattern, form)
    return F.when(text.rlike(_ISO_SHAPE), extended.try_cast("timestamp"))


def unix_time(seconds: Column) -> Column:
    """Unix seconds, fractions kept; malformed text and times beyond the calendar are null."""
    number = seconds.try_cast("decimal(20,6)")
    return F.timestamp_seconds(F.when(number.between(FIRST_SECOND, LAST_SECOND), number))


def is_stale(traded_at: Column, now: Column, max_age_hours: int = MAX_TRADE_AGE_HOURS) -> Column:
    """Older than the limit. An unknown trade time is not stale."""
    limit = F.expr(f"INTERVAL {int(max_age_hours)} HOURS")
    return F.coalesce(now - traded_at > limit, F.lit(False))


def unless_stale(columns: dict[str, Column], stale: Column) -> dict[str, Column]:
    """Null the price-sensitive columns of stale rows; the rows stay."""
    return {
        name: F.when(~stale, c) if name in PRICE_SENSITIVE_FIELDS else c
        for name, c in columns.items()
    }
