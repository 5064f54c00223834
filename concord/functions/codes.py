"""Identifier and code formats. Format only: no checksum is verified."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions.checked import Checked, matching
from concord.functions.text import is_blank, padded_cik, strip, upper_text

# Code formats and the rating vocabulary.
ISIN = "^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
CUSIP = "^[0-9A-Z]{9}$"
CIK = "^[0-9]{1,10}$"
PADDED_CIK = "^[0-9]{10}$"
LEI = "^[A-Z0-9]{18}[0-9]{2}$"
FIGI = "^[A-Z0-9]{12}$"
MIC = "^[A-Z0-9]{4}$"
CURRENCY = r"^\p{L}{3}$"
SNAPSHOT_DATE = r"^\d{4}-\d{2}-\d{2}$"
RATINGS = {
    "BUY": "BUY",
    "SELL": "SELL",
    "HOLD": "HOLD",
    "STRONG_BUY": "BUY",
    "STRONG_SELL": "SELL",
}


def isin(c: Column) -> Checked:
    return matching(upper_text(c), ISIN)


def cusip(c: Column) -> Checked:
    return matching(upper_text(c), CUSIP)


def cik(c: Column) -> Checked:
    checked = matching(upper_text(c), CIK)
    return Checked(padded_cik(checked.value), checked.wrong)


def lei(c: Column) -> Checked:
    return matching(upper_text(c), LEI)


def figi(c: Column) -> Checked:
    return matching(upper_text(c), FIGI)


def mic(c: Column) -> Checked:
    return matching(upper_text(c), MIC)


def has_malformed_mic(values: Column) -> Column:
    return F.exists(values, lambda m: F.coalesce(~m.rlike(MIC), F.lit(False)))


def mic_list(c: Column) -> Checked:
    """Each element is checked; an empty list is null, a blank element a null one."""
    values = F.when(F.size(c) > 0, F.transform(c, upper_text))
    wrong = F.coalesce(has_malformed_mic(values), F.lit(False))
    return Checked(F.when(~wrong, values), wrong)


def sub_unit(c: Column) -> Column:
    """Mixed case marks a sub-unit (pence, cents) of a currency."""
    return F.coalesce(c.rlike(r"\p{Ll}") & c.rlike(r"\p{Lu}"), F.lit(False))


def currency(c: Column) -> Checked:
    """Three letters; a sub-unit rejects."""
    code = upper_text(c)
    malformed = F.coalesce(~code.rlike(CURRENCY), F.lit(False))
    wrong = code.isNotNull() & (sub_unit(c) | malformed)
    return Checked(F.when(~wrong, code), wrong)


def snapshot_date(c: Column) -> Checked:
    """Dashed ISO date that exists in the calendar; blank is null."""
    text = strip(c)
    value = F.when(text.rlike(SNAPSHOT_DATE), text.try_cast("date"))
    return Checked(value, ~is_blank(c) & value.isNull())


def analyst_rating(c: Column) -> Column:
    """BUY, SELL or HOLD; anything else is null."""
    pairs = [F.lit(x) for pair in RATINGS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), upper_text(c))
