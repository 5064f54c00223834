"""Row validation: typed columns plus the list of fields that reject the row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.functions import codes
from concord.functions.checked import Checked, clean
from concord.functions.codes import sub_unit
from concord.functions.text import is_blank, padded_cik, symbol_text, upper_text
from concord.schema import (
    AMOUNT,
    AMOUNT_FIELDS,
    MONETARY_FIELDS,
    RECORD_FIELDS,
    UNSIGNED_FIELDS,
    field_type,
)

#: Fields that must be present in every record, and those of a canonical record.
REQUIRED = ("name", "symbol")
CANONICAL_REQUIRED = ("name", "symbol", "share_class_figi")

#: How a text field is normalised before it is checked; amounts are left as they are.
NORMAL: dict[str, Callable[[Column], Column]] = {
    "symbol": symbol_text,
    "mics": lambda c: F.when(F.size(c) > 0, F.transform(c, upper_text)),
    "analyst_rating": codes.analyst_rating,
}
#: What a normalised text field must look like.
FORMATS: dict[str, Callable[[Column], Column]] = {
    "share_class_figi": lambda c: ~c.rlike(codes.FIGI),
    "isin": lambda c: ~c.rlike(codes.ISIN),
    "cusip": lambda c: ~c.rlike(codes.CUSIP),
    "cik": lambda c: ~c.rlike(codes.PADDED_CIK),
    "lei": lambda c: ~c.rlike(codes.LEI),
    "mics": codes.has_malformed_mic,
    "currency": lambda c: ~c.rlike(codes.CURRENCY),
}


def required_error(value: Column) -> Column:
    return is_blank(value)


def money_without_currency(currency: Column, money: list[Column]) -> Column:
    return currency.isNull() & F.coalesce(*money).isNotNull()


def error_list(wrong: Mapping[str, Column]) -> Column:
    """Array of the names whose flag is set."""
    named = F.array(*[F.when(flag, F.lit(name)) for name, flag in wrong.items()])
    return F.filter(named, lambda e: e.isNotNull())


def validate(
    df: DataFrame,
    raw: Mapping[str, Column | Checked] | None = None,
    required: tuple[str, ...] = REQUIRED,
    counters: str = "validated",
) -> DataFrame:
    """Replace the record fields by their normal form and add ``errors``.

    ``raw`` maps field names to what a feed supplies; fields it leaves out are null.
    Without ``raw`` the frame's own record columns are checked again (merged rows).
    ``counters`` names the observed counts of all and of rejected rows. The observation
    also keeps the optimizer from copying the checks into filters further up, so each
    check runs once per row.
    """
    if raw is None:
        raw = {f: F.col(f) for f in RECORD_FIELDS}
    rest = [c for c in df.columns if c not in RECORD_FIELDS]
    given = {f: c if isinstance(c, Checked) else clean(c) for f, c in raw.items()}
    early = [f for f, c in raw.items() if isinstance(c, Checked)]

    # Three projections in a row: what the feed gives, its normal form, the verdicts.
    taken = df.select(
        *rest,
        *[c.value.alias(f) for f, c in given.items()],
        *[given[f].wrong.alias(f"_early_{f}") for f in early],
        *([sub_unit(given["currency"].value).alias("_sub_unit")] if "currency" in given else []),
    )
    flags = [c for c in taken.columns if c.startswith("_early_") or c == "_sub_unit"]
    normal = taken.select(*rest, *flags, *[_normal(f, f in given).alias(f) for f in RECORD_FIELDS])

    wrong: dict[str, Column] = {}
    for f in RECORD_FIELDS:
        reasons = [F.col(f"_early_{f}")] if f in early else []
        if f in given and f in FORMATS:
            reasons.append(F.coalesce(FORMATS[f](F.col(f)), F.lit(False)))
        if f == "currency" and f in given:
            reasons.append(F.col("_sub_unit"))
        if f in given and f in UNSIGNED_FIELDS:
            reasons.append(F.coalesce(F.col(f) < 0, F.lit(False)))
        if f in required:
            reasons.append(required_error(F.col(f)))
        if reasons:
            wrong[f] = reduce(Column.__or__, reasons)
    unpaired = money_without_currency(F.col("currency"), [F.col(m) for m in MONETARY_FIELDS])
    wrong["currency"] = wrong.get("currency", F.lit(False)) | unpaired
    judged = normal.select(*rest, *RECORD_FIELDS, error_list(wrong).alias("errors"))
    return judged.observe(
        counters, F.count(F.lit(1)).alias("rows"), F.count_if(F.size("errors") > 0).alias("rejected")
    )


def _normal(field: str, given: bool) -> Column:
    if not given:
        return F.lit(None).cast(field_type(field))
    if field in AMOUNT_FIELDS:
        return F.col(field).cast(AMOUNT)
    normal = NORMAL.get(field, upper_text)(F.col(field))
    if field == "cik":
        return F.when(normal.rlike(codes.CIK), padded_cik(normal)).otherwise(normal)
    return normal


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") == 0).drop("errors")


def quarantined(df: DataFrame) -> DataFrame:
    return df.filter(F.size("errors") > 0)


def error_counts(df: DataFrame) -> DataFrame:
    """Rejections per field; a row with two bad fields counts under both."""
    return df.select(F.explode("errors").alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("n"))


def revalidated(df: DataFrame, required: tuple[str, ...] = CANONICAL_REQUIRED) -> DataFrame:
    """Merged rows that still pass every check; the others drop out whole."""
    return accepted(validate(df, required=required, counters="canonical"))
