"""Numbers from text and from JSON values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concord.functions.checked import Checked
from concord.functions.text import strip
from concord.schema import AMOUNT

# Accepted number shapes.
PLAIN_NUMBER = r"^-?\d+(\.\d+)?$"
ANY_NUMBER = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
PENCE_NUMBER = r"^\d+([.,]\d+)?$"


def plain_number(text: Column) -> Column:
    """Plain dot-decimal text; commas, exponents and other shapes are null."""
    bare = F.ltrim(strip(text), F.lit("+"))
    return F.when(bare.rlike(PLAIN_NUMBER), bare.try_cast(AMOUNT))


def any_number(text: Column) -> Column:
    """Any finite number literal, exponents included; other text is null."""
    bare = strip(text)
    return F.when(bare.rlike(ANY_NUMBER), bare.try_cast(AMOUNT))


def finite(c: Column) -> Column:
    """Null for NaN and the infinities of a floating column."""
    inf = F.lit(float("inf"))
    return F.when(~F.isnan(c) & (c != inf) & (c != -inf), c)


def unsigned(value: Column) -> Checked:
    """A negative value rejects its row."""
    wrong = F.coalesce(value < 0, F.lit(False))
    return Checked(F.when(~wrong, value), wrong)


def json_kind(v: Column) -> Column:
    """``string``, ``number``, ``other`` or null for a VARIANT cell."""
    kind = F.schema_of_variant(v)
    return (
        F.when(kind.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
        .when(kind == "STRING", "string")
        .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), "number")
        .otherwise("other")
    )


def json_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def json_number(v: Column) -> Column:
    """JSON numbers are trusted in any notation; JSON text must be plain."""
    kind = json_kind(v)
    return F.when(kind == "number", F.try_variant_get(v, "$", AMOUNT.simpleString())).when(
        kind == "string", plain_number(json_text(v))
    )


def json_typed_number(v: Column) -> Checked:
    """For feeds whose column is declared numeric: text that is no number rejects."""
    kind = json_kind(v)
    value = F.when(
        kind == "number", F.try_variant_get(v, "$", AMOUNT.simpleString())
    ).when(kind == "string", any_number(json_text(v)))
    wrong = (kind == "other") | ((kind == "string") & value.isNull())
    return Checked(value, F.coalesce(wrong, F.lit(False)))


def percent_ratio(number: Column) -> Column:
    """20.6 (percent) to 0.206."""
    return (number.cast(AMOUNT) / F.lit(100)).cast(AMOUNT)


def json_percent_ratio(v: Column) -> Column:
    """Ratio of a percent given as JSON number or text; anything else is null."""
    return percent_ratio(any_number(json_text(v)))


def pence_number(text: Column) -> Column:
    """Unsigned number where a lone comma is the decimal point."""
    bare = strip(text)
    sound = bare.rlike(PENCE_NUMBER)
    return F.when(sound, F.translate(bare, ",", ".").try_cast(AMOUNT))


def pounds(pence: Column) -> Column:
    """Hundredth of a pence amount; zero means missing."""
    return F.nullif((pence / F.lit(100)).cast(AMOUNT), F.lit(0).cast(AMOUNT))


def zero_missing(c: Column) -> Column:
    return F.when(c != 0, c)
