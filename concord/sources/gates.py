"""Gates that decide whether a landed feed may be kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from concord.sources.landed import BROKEN


def page_status(df: DataFrame, feed: Sequence[str], page: str, total: str | Column) -> DataFrame:
    """Per feed: distinct pages seen, pages announced (1 if unknown), complete or not."""
    announced = F.coalesce(F.max(total if isinstance(total, Column) else F.col(total)), F.lit(1))
    status = df.groupBy(*feed).agg(
        F.count_distinct(page).alias("pages"), announced.cast("bigint").alias("total_pages")
    )
    return status.withColumn("complete", F.col("pages") >= F.col("total_pages"))


def document_status(docs: DataFrame, announced: Column | None = None) -> DataFrame:
    """One row on the landed documents of a feed.

    ``pages`` seen, ``total_pages`` announced (the pages seen if none are), ``unreadable`` documents,
    ``unnumbered`` ones beside others, whether the ``started`` feed has its first page (0), and
    ``complete``: all of it is there and readable.
    """
    readable = F.col(BROKEN).isNull()
    total = F.max(announced) if announced is not None else F.lit(None)
    counts = docs.agg(
        F.count_distinct("page_no").alias("pages"),
        total.cast("bigint").alias("total_pages"),
        F.count_if(~readable).alias("unreadable"),
        F.count_if(readable & F.col("page_no").isNull()).alias("_bare"),
        F.count_if(readable).alias("_readable"),
        F.min("page_no").alias("_first"),
    )
    # a feed of one document needs no page number
    single = (F.col("_bare") == 1) & (F.col("_readable") == 1)
    seen = F.when(single, 1).otherwise(F.col("pages")).cast("bigint")
    shown = counts.withColumns(
        {
            "pages": seen,
            "total_pages": F.coalesce("total_pages", seen),
            "unnumbered": F.when(single, 0).otherwise(F.col("_bare")).cast("bigint"),
            "started": single | F.coalesce(F.col("_first") == 0, F.lit(False)),
        }
    )
    whole = F.col("started") & (F.col("unreadable") == 0) & (F.col("unnumbered") == 0)
    return shown.withColumn("complete", whole & (F.col("pages") >= F.col("total_pages"))).drop("_bare", "_readable", "_first")


def count_documents(docs: DataFrame, flag: Column, other: str) -> DataFrame:
    """Documents for which a flag on ``_broken`` holds. Spark refuses to read that column alone, so a
    second one is read with it."""
    return docs.agg(F.greatest(F.count_if(flag), -F.count(other)).alias("n"))


def single_page(docs: DataFrame) -> DataFrame:
    """A single readable document without a page number is page 0, as :func:`document_status` has it."""
    readable = count_documents(docs, F.col(BROKEN).isNull(), "page_no").scalar()
    bare = F.col(BROKEN).isNull() & F.col("page_no").isNull() & (readable == 1)
    return docs.withColumn("page_no", F.when(bare, 0).otherwise(F.col("page_no")))


def pages_for_rows(total_rows: Column, page_size: int) -> Column:
    """Announced pages of a feed that announces rows."""
    return F.greatest(F.ceil(total_rows / F.lit(page_size)), F.lit(1))


def before_gap(df: DataFrame, feed: Sequence[str], page: str, first: int = 0) -> DataFrame:
    """Rows of the unbroken run of pages from ``first``; later pages are ignored.

    The run ends at the lowest page without a successor, found by an anti join and a
    minimum, so a feed with very many pages is never ordered in one task.
    """
    feed = list(feed)
    pages = df.select(*feed, page).distinct()
    followed = pages.withColumn(page, F.col(page) - 1)
    ends = pages.join(followed, [*feed, page], "left_anti")
    started = pages.filter(F.col(page) == first).select(*feed)
    last = ends.groupBy(*feed).agg(F.min(page).alias("_last")).join(started, feed, "left_semi")
    return df.join(last, feed, "inner").filter(F.col(page) <= F.col("_last")).drop("_last")


def keep_if_whole(rows: DataFrame, status: DataFrame, path: str) -> bool:
    """Write a feed's rows for later runs, but only a complete and non-empty feed.

    An incomplete feed is still used by the run that read it; it is just not kept. Tells
    whether the rows were written.
    """
    if rows.isEmpty() or not status.filter(~F.col("complete")).isEmpty():
        return False
    rows.write.mode("overwrite").parquet(path)
    return True


def feed_counts(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows per registered feed, zero for a feed that produced nothing."""
    counts = rows.groupBy("feed").agg(F.count(F.lit(1)).alias("n"))
    return registry.join(counts, "feed", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def require_rows(counts: DataFrame) -> None:
    """Abort when every feed is empty."""
    if not (counts.agg(F.sum("n")).first()[0] or 0):
        raise RuntimeError("all discovery feeds are empty")
