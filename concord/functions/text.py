"""Text normalisation as column expressions."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide the normalised text.
BLANK_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
BLANKS = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"
NON_BLANK = r"[^\p{IsWhite_Space}\x{1C}-\x{1F}]"
LINE_BREAKS = "\n\r\x85\u2028\u2029"
NON_WORD = r"[^\w\p{L}\p{N}]++"
# The dot comes first, so a scan stops at dots only.
ABBREVIATION_DOT = (
    r"\.(?:(?<=[A-Za-z]\.)(?=[A-Za-z]\.)|(?<=[A-Za-z]\.[A-Za-z]\.))"
)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK_CHARACTERS))


def is_blank(c: Column) -> Column:
    """Null or nothing but whitespace."""
    return c.isNull() | ~c.rlike(NON_BLANK)


def non_blank(c: Column) -> Column:
    """The text itself, or null when blank."""
    return F.when(~is_blank(c), c)


def upper_text(c: Column) -> Column:
    """Dotted abbreviations collapsed, punctuation runs to one space, upper case.

    Blank input is null; input of punctuation only becomes the empty string.
    """
    undotted = F.regexp_replace(c, ABBREVIATION_DOT, "")
    words = F.trim(F.regexp_replace(undotted, NON_WORD, " "))
    return F.when(~is_blank(c), F.upper(words))


def symbol_text(c: Column) -> Column:
    """Upper case with whitespace runs collapsed; punctuation kept."""
    return F.when(~is_blank(c), F.upper(F.regexp_replace(strip(c), f"{BLANKS}+", " ")))


def root_symbol(c: Column) -> Column:
    """Ticker root: before the first dot, digits stripped from both ends."""
    head = F.substring_index(F.upper(c), ".", 1)
    # a pattern's end may lie before a last line break, so only texts without one are trimmed
    broken = reduce(or_, (F.endswith(head, F.lit(b)) for b in LINE_BREAKS))
    return F.when(broken, F.regexp_replace(head, "^[0-9]+|[0-9]+$", "")).otherwise(F.btrim(head, F.lit("0123456789")))


def padded_cik(c: Column) -> Column:
    """Zero-pad to ten places; longer text is left as it is, null stays null."""
    return F.when(F.length(c) < 10, F.lpad(c, 10, "0")).otherwise(c)


def lookup_key(symbol: Column, isin: Column, name: Column) -> Column:
    """Key that tells apart equal tickers: symbol plus ISIN, or name without one."""
    second = F.coalesce(F.when(isin != "", isin), name)
    return F.concat(symbol, F.lit("|"), second)
