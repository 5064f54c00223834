"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.session import stage

Build = Callable[[SparkSession, str], DataFrame]

#: Registered queries and the SQL twins of those that have one.
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``text`` alone; other columns, whatever their names, stay behind.

    A null text counts as empty; a null id stays null.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def free_name(df: DataFrame, name: str = "_row") -> str:
    """``name``, with underscores before it until no column of ``df`` has it (whatever the case)."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def utf8(c: Column | str) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return column.cast("binary")


def ascii_lower(c: Column | str) -> Column:
    """A-Z in lower case; every other character, accented capitals included, as it is.

    Texts without other capitals take the engine's fast lower-casing.
    """
    column = F.col(c) if isinstance(c, str) else c
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    other_case = r"[^\x00-\x7F&&\P{Ll}]"  # beyond ASCII and not already a small letter
    return F.when(column.rlike(other_case), F.translate(column, capitals, capitals.lower())).otherwise(
        F.lower(column)
    )


def numbered(df: DataFrame, *order: str | Column, label: str = "numbered") -> DataFrame:
    """``df`` with ``pos``: the place of each row in the total order, gapless from 0.

    Rows are dealt by ranges of the whole key, so a value that a third of the rows share is
    split as long as the later columns differ. Each task numbers its rows; the tasks' counts,
    one row per partition, are summed up and added. No task sees more than its range.
    The rows are written to the shared folder in between, so the numbers cannot change
    when a lost task is run again. ``df`` is read twice (ranges are sampled first): pass
    something cheap to read.
    """
    kept = stage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    ).withColumns({"_part": F.shiftrightunsigned("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)})
    counts = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    placed = kept.join(F.broadcast(before), "_part")  # a row per shuffle partition
    return placed.withColumn("pos", F.col("_before") + F.col("_row")).drop("_at", "_part", "_row", "_before")
