"""Registry of the queries over the given tables, each with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.schema import RATE

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; without SQL it is checked by tests instead."""

    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def amount(c: Column | str) -> Column:
    """A money column of the tables as exact decimal (they hold two places)."""
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("decimal(18,2)")


def doubles(df: DataFrame, *names: str) -> DataFrame:
    """Decimal results as DOUBLE, the form both engines are compared in."""
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("bigint") for n in names})


# Currencies and rates are derived from the nations: nation 0 trades in dollars, 23 has
# a rate of zero, 24 has none.


def nation_currency(key: Column) -> Column:
    first, second = (key / 5).cast("int"), key % 5
    code = F.concat(F.lit("N"), F.char(65 + first), F.char(65 + second))
    return F.when(key == 0, "USD").otherwise(code)


def nation_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    rate = F.when(key == 23, 0).otherwise(50 + 7 * key)
    nations = table(spark, sf_dir, "nation").filter(key != 24)
    return nations.select(
        nation_currency(key).alias("currency"),
        (rate.cast("decimal(18,8)") / F.lit(100)).cast(RATE).alias("rate"),
    )


FX_SQL = """
fx AS (
  SELECT n_nationkey,
         CASE WHEN n_nationkey = 0 THEN 'USD'
              ELSE 'N' || chr(65 + n_nationkey // 5) || chr(65 + n_nationkey % 5) END AS currency,
         CASE WHEN n_nationkey = 24 THEN NULL
              WHEN n_nationkey = 23 THEN 0
              ELSE 50 + 7 * n_nationkey END AS rate
  FROM nation
)"""


def usd_sql(price: str) -> str:
    """SQL for a two-place price over a rate in hundredths, half-even at four places,
    in whole numbers so that ties are exact."""
    n = f"(({price}) * 100)::HUGEINT * 10000"
    up = f"2 * ({n} % rate) > rate OR (2 * ({n} % rate) = rate AND ({n} // rate) % 2 = 1)"
    exact = f"({n} // rate + CASE WHEN {up} THEN 1 ELSE 0 END) / 10000.0"
    return f"(CASE WHEN currency = 'USD' THEN ({price})::DOUBLE ELSE {exact} END)"
