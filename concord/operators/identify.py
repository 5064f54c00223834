"""Attach the global id through a keyed lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from concord.functions.codes import FIGI
from concord.operators.dedup import last_per_key

# Lookup id types in order of preference, and the security type asked for.
ISIN_TYPE = "ID_ISIN"
CUSIP_TYPE = "ID_CUSIP"
TICKER_TYPE = "TICKER"
SECURITY_TYPE = "Common Stock"


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def query_key(isin: Column, cusip: Column, symbol: Column) -> tuple[Column, Column]:
    """``(id_type, id_value)`` of the best identifier a row has."""
    has_isin, has_cusip = _present(isin), _present(cusip)
    kind = F.when(has_isin, ISIN_TYPE).when(has_cusip, CUSIP_TYPE).otherwise(TICKER_TYPE)
    value = F.when(has_isin, isin).when(has_cusip, cusip).otherwise(symbol)
    return kind, value


def with_query_key(df: DataFrame) -> DataFrame:
    kind, value = query_key(F.col("isin"), F.col("cusip"), F.col("symbol"))
    return df.withColumns({"id_type": kind, "id_value": value})


def queries_of(df: DataFrame) -> DataFrame:
    """Distinct lookup queries of a frame."""
    keyed = with_query_key(df).select("id_type", "id_value").distinct()
    return keyed.withColumn("security_type", F.lit(SECURITY_TYPE))


def response_index(columns: list[Column]) -> Column:
    """First index column that holds a number."""
    return F.coalesce(*[c.cast("bigint") for c in columns])


def responses_to_lookup(
    queries: DataFrame,
    responses: DataFrame,
    batch: tuple[str, ...] = (),
) -> DataFrame:
    """Keyed lookup from positional responses.

    ``queries``: ``query_no, id_type, id_value``; ``responses``: ``row_no``, one or more
    of ``query_number, queryId, request_index``, and ``shareClassFIGI, ticker, name,
    securityName``. A response counts if its id is well formed and its index is one of
    the queries; of several, the last wins.
    """
    index_columns = [c for c in ("query_number", "queryId", "request_index") if c in responses.columns]
    symbol = F.col("ticker")
    label = F.coalesce(
        F.when(F.col("name") != "", F.col("name")),
        F.when(F.col("securityName") != "", F.col("securityName")),
        symbol,
    )
    valid = responses.withColumn(
        "query_no", response_index([F.col(c) for c in index_columns])
    ).filter(F.col("query_no").isNotNull() & F.col("shareClassFIGI").rlike(FIGI))
    keys = [*batch, "query_no"]
    last = last_per_key(valid, [F.col(k) for k in keys], ["row_no"])
    records = last.select(
        *keys,
        label.alias("found_name"),
        symbol.alias("found_symbol"),
        F.col("shareClassFIGI").alias("found_figi"),
    )
    return queries.join(records, keys, "inner").drop(*keys)


def unique_lookup(lookup: DataFrame) -> DataFrame:
    """One answer per key: one with an id before one without, then the largest. Repeated keys would
    multiply the rows that ask for them."""
    answer = F.max(F.struct("found_figi", "found_name", "found_symbol")).alias("a")
    return lookup.groupBy("id_type", "id_value").agg(answer).select("id_type", "id_value", "a.*")


def identify(
    df: DataFrame, lookup: DataFrame, counters: str | Observation | None = None
) -> DataFrame:
    """Rows with the id, and the lookup's name and symbol where it has them.

    ``lookup``: ``id_type, id_value, found_name, found_symbol, found_figi``, one answer of each key
    (:func:`unique_lookup`). Rows without
    an id are dropped; ``counters`` observes how many were identified and how many not.
    The lookup grows with the data, so the join is left to the optimizer; adaptive skew
    splitting handles a hot query key.
    """
    joined = with_query_key(df).join(unique_lookup(lookup), ["id_type", "id_value"], "left")
    found = F.col("found_figi").isNotNull()
    if counters is not None:
        joined = joined.observe(
            counters, F.count_if(found).alias("identified"), F.count_if(~found).alias("failed")
        )
    name, symbol = F.col("found_name"), F.col("found_symbol")
    return (
        joined.filter(found)
        .withColumns(
            {
                "share_class_figi": F.col("found_figi"),
                "name": F.coalesce(F.when(name != "", name), F.col("name")),
                "symbol": F.coalesce(F.when(symbol != "", symbol), F.col("symbol")),
            }
        )
        .drop("id_type", "id_value", "found_name", "found_symbol", "found_figi")
    )


def no_lookup(df: DataFrame) -> DataFrame:
    """Empty lookup: what an unavailable service contributes."""
    columns = "id_type string, id_value string, found_name string, found_symbol string, found_figi string"
    return df.sparkSession.createDataFrame([], columns)


def any_identified(lookup: DataFrame) -> bool:
    """Gate before an identification table is kept: at least one id was resolved."""
    return not lookup.filter(F.col("found_figi").isNotNull()).isEmpty()
