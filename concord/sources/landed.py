"""Reading landed JSON documents.

A landed document is what a service answered, one per line (or one per file with
``multi_line``), with the page number the lander added as ``page_no``. Numbers that a
service may send as JSON numbers or as text are read as VARIANT, so both stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.schema import POSITION

#: Column with the text of a document that could not be read, else null.
BROKEN = "_broken"


def read_json(
    spark: SparkSession,
    path: str,
    schema: str,
    multi_line: bool = False,
    streaming: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Documents with the columns of ``schema`` and ``_broken``, so that a truncated document is
    seen by the gates (:func:`concord.sources.gates.document_status`) and not lost."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.schema(f"{schema}, {BROKEN} STRING").option("columnNameOfCorruptRecord", BROKEN)
    if streaming and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("multiLine", multi_line).json(path)


def place(page: Column, position: Column, inner: Column | None = None) -> Column:
    """Place of a record in its feed (``POSITION``), ordered as it reads: page, then position, then
    the place in a list of the record. A document without a page number is page 0."""
    parts = (F.coalesce(page, F.lit(0)), position, F.lit(0) if inner is None else inner)
    return F.struct(*[c.cast("bigint").alias(n) for c, n in zip(parts, POSITION.names, strict=True)])


def exploded(pages: DataFrame, records: Column) -> DataFrame:
    """One row per record of each page, ``r`` and its ``row_no``; nulls are skipped."""
    page = F.col("page_no")
    rows = pages.select(page, F.posexplode(records).alias("_at", "r")).filter(F.col("r").isNotNull())
    return rows.select("r", place(page, F.col("_at")).alias("row_no"))


def merge_maps_last_wins(maps: Column) -> Column:
    """One map from an array of maps; a key of a later map replaces an earlier one,
    even with a null value."""
    known = F.filter(maps, lambda m: m.isNotNull())
    none = F.map_filter(F.get(known, F.lit(0)), lambda k, v: F.lit(False))
    return F.reduce(
        F.reverse(known),
        none,
        lambda done, m: F.map_concat(done, F.map_filter(m, lambda k, v: ~F.map_contains_key(done, k))),
    )
