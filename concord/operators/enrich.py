"""Enrichment: lookups per group, candidate search, and the rows appended to groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from concord.functions.fuzzy import candidate_score
from concord.functions.text import lookup_key
from concord.operators.dedup import first_per_key

# Score limits and the quote type that counts.
DEFAULT_MIN_SCORE = 160
SINGLE_HIT_MIN_SCORE = 120
EQUITY = "EQUITY"

#: ``score(actual_symbol, actual_name, expected_symbol, expected_name)``.
Score = Callable[[Column, Column, Column, Column], Column]


def present(c: Column) -> Column:
    return F.coalesce(c != "", F.lit(False))


def attach_by_key(df: DataFrame, key: str, table: DataFrame, table_key: str) -> DataFrame:
    """Rows that find their upper-cased key in a lookup table; the others drop out.

    The table grows with the data, so the optimizer chooses the join.
    """
    keyed = df.filter(F.col(key).isNotNull())
    return keyed.join(table, F.upper(F.col(key)) == F.col(table_key), "inner")


def lei_rows(ids: DataFrame, index: DataFrame) -> DataFrame:
    """One enrichment row per group whose ISIN has a LEI."""
    table = index.select(F.col("isin").alias("_isin"), F.col("lei").alias("_lei"))
    hit = attach_by_key(ids, "isin", table, "_isin")
    return hit.select("share_class_figi", "name", "symbol", "isin", F.col("_lei").alias("lei"))


def viable(df: DataFrame) -> DataFrame:
    """Candidates with a symbol and at least one name."""
    named = present(F.col("longname")) | present(F.col("shortname"))
    return df.filter(named & present(F.col("candidate")))


def min_score_for(level: Column, hits: Column, default: float = DEFAULT_MIN_SCORE) -> Column:
    """An identifier search with exactly one viable hit may score lower."""
    single = (level <= 2) & (hits == 1)
    return F.when(single, SINGLE_HIT_MIN_SCORE).otherwise(default)


def search_terms(ids: DataFrame) -> DataFrame:
    """``lookup, symbol, name, level, term``: ISIN, CUSIP, name (or symbol), symbol."""
    name, symbol = F.col("name"), F.col("symbol")
    query = F.when(present(name), name).otherwise(symbol)
    levels = F.array(
        F.struct(F.lit(1).alias("level"), F.col("isin").alias("term")),
        F.struct(F.lit(2).alias("level"), F.col("cusip").alias("term")),
        F.struct(F.lit(3).alias("level"), query.alias("term")),
        F.struct(F.lit(4).alias("level"), F.when(symbol != query, symbol).alias("term")),
    )
    wanted = F.filter(levels, lambda t: F.coalesce(t["term"] != "", F.lit(False)))
    exploded = ids.select("lookup", "symbol", "name", F.explode(wanted).alias("t"))
    return exploded.select("lookup", "symbol", "name", "t.level", "t.term")


def rank_candidates(
    hits: DataFrame,
    score: Score = candidate_score,
    default_min_score: float = DEFAULT_MIN_SCORE,
) -> DataFrame:
    """Ranked candidates of the first level (and name pass) that accepts any.

    ``hits``: ``lookup, symbol, name, level, pos, candidate, longname, shortname``. Every
    level is scored in one pass and the lowest accepted one kept, which gives what a
    level-by-level search gives. Long names are tried first; short names count only if
    no long name is accepted at that level. Ties keep search order. Hits are dealt by
    lookup, so that a candidate that several levels find can be scored from a cache.
    """
    per_level = Window.partitionBy("lookup", "level")
    counted = viable(hits).repartition("lookup").withColumn("_hits", F.count(F.lit(1)).over(per_level))
    passes = F.explode(
        F.filter(
            F.array(
                F.struct(F.lit(0).alias("pass"), F.col("longname").alias("actual")),
                F.struct(F.lit(1).alias("pass"), F.col("shortname").alias("actual")),
            ),
            lambda p: F.coalesce(p["actual"] != "", F.lit(False)),
        )
    )
    tried = counted.withColumn("_p", passes).withColumn("_actual", F.col("_p.actual"))
    scored = tried.withColumn(
        "score",
        score(F.col("candidate"), F.col("_actual"), F.col("symbol"), F.col("name")),
    )
    needed = min_score_for(F.col("level"), F.col("_hits"), default_min_score)
    accepted = scored.filter(F.col("score") >= needed).withColumn(
        "_step", F.struct("level", F.col("_p.pass").alias("pass"))
    )
    per_lookup = Window.partitionBy("lookup")
    first_step = accepted.withColumn("_first", F.min("_step").over(per_lookup)).filter("_step = _first")
    spot = F.row_number().over(per_lookup.orderBy(F.desc("score"), "pos"))
    return first_step.withColumn("rank", spot).select("lookup", "level", "candidate", "score", "rank")


def search_hits(ids: DataFrame, search: DataFrame) -> DataFrame:
    """Join search terms with landed search results (``term, pos, candidate, longname,
    shortname, quote_type``); only equities count."""
    results = search.filter(F.col("quote_type") == EQUITY)
    results = results.select("term", "pos", "candidate", "longname", "shortname")
    return search_terms(ids).join(results, "term", "inner")


def valid_quote(quotes: DataFrame) -> DataFrame:
    """Quotes of equities that carry a name."""
    named = present(F.col("long_name")) | present(F.col("short_name"))
    return quotes.filter((F.col("quote_type") == EQUITY) & named)


def first_valid_quote(ranked: DataFrame, quotes: DataFrame) -> DataFrame:
    """Best-ranked candidate whose quote is valid, one row per lookup.

    ``quotes`` is keyed by ``quote_symbol``. Levels are not reconsidered here: if every
    quote of the accepted level is invalid the lookup finds nothing.
    """
    joined = ranked.join(valid_quote(quotes), F.col("candidate") == F.col("quote_symbol"), "inner")
    return first_per_key(joined, F.col("lookup"), ["rank"])


def with_lookup(ids: DataFrame) -> DataFrame:
    return ids.withColumn("lookup", lookup_key(F.col("symbol"), F.col("isin"), F.col("name")))


def find_quotes(
    ids: DataFrame,
    search: DataFrame,
    quotes: DataFrame,
    score: Score = candidate_score,
    default_min_score: float = DEFAULT_MIN_SCORE,
) -> DataFrame:
    """Enrichment quote per group: groups that share a lookup key share its answer."""
    keyed = with_lookup(ids)
    once = first_per_key(keyed, F.col("lookup"), ["share_class_figi"])
    ranked = rank_candidates(search_hits(once, search), score, default_min_score)
    found = first_valid_quote(ranked, quotes).drop("level", "candidate", "score", "rank")
    return keyed.select("share_class_figi", "lookup").join(found, "lookup", "inner").drop("lookup")


def inject_key(enrichment: DataFrame, group_key: Column, key: str = "share_class_figi") -> DataFrame:
    """Give enrichment rows without an id the id of the group that asked for them."""
    return enrichment.withColumn(key, F.coalesce(F.col(key), group_key))


def append_rows(discovery: DataFrame, *enrichment: DataFrame) -> DataFrame:
    """Discovery rows and enrichment rows of all groups in one frame, ready to merge."""
    for rows in enrichment:
        discovery = discovery.unionByName(rows, allowMissingColumns=True)
    return discovery
