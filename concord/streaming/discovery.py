"""The discovery feeds as streams: landed documents to converted records, faults to the side.

Each feed is streamed by two queries over the same landed JSON. One logs every document with its page
number and, if it could not be read, its text: the quarantine and what the gates count. The other explodes,
projects and validates the records and keeps, as state per key, the one with the first place in the feed, so
the result does not depend on the order in which files land; each micro-batch gives the keys that changed,
which are converted and written beside those that were rejected. A feed whose records are put together from
several kinds of documents streams its parsed documents, and they are joined when the records are read.

Micro-batches write folders named by their number, so a repeated one replaces itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from concord.operators.dedup import first_per_key_or_blank, first_per_present_key, last_per_key
from concord.operators.fx import to_usd
from concord.operators.validate import accepted
from concord.schema import RAW_SCHEMA
from concord.sources.feeds import CHECKED_SCHEMA, DISCOVERY_FEEDS, Feed, checked_records
from concord.sources.gates import before_gap, document_status, single_page
from concord.sources.landed import BROKEN

VERDICTS = T.StructType([T.StructField("_key", T.StringType()), *CHECKED_SCHEMA, T.StructField("kept", T.BooleanType()), T.StructField("batch", T.LongType())])


def keyed(rows: DataFrame, feed: Feed) -> DataFrame:
    """``rows`` with the ``_key`` by which the feed's batch form tells equal records."""
    key = feed.key().cast("string")
    if feed.pick is first_per_present_key:
        rows = rows.filter(key.isNotNull() & (key != ""))
    return rows.withColumn("_key", F.coalesce(key, F.lit("")) if feed.pick is first_per_key_or_blank else key)


def first_rows(feed: Feed, rank: int, docs: DataFrame, now: Column) -> DataFrame:
    """Checked records of a stream of documents, the first of each key (an aggregation in update mode)."""
    readable = docs.filter(F.col(BROKEN).isNull())
    checked = checked_records(feed, rank, keyed(feed.rows(readable), feed), now)
    whole = F.struct(*CHECKED_SCHEMA.names)
    return checked.groupBy("_key").agg(F.min_by(whole, "row_no").alias("r")).select("_key", "r.*")


def converted(rates: DataFrame, path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: changed keys in dollars, and those that are rejected or have no rate
    with their errors (``kept`` tells them apart)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        dollars = to_usd(accepted(batch), rates)
        good = dollars.withColumns({"errors": F.array().cast("array<string>"), "kept": F.lit(True)})
        keys = good.select(F.col("_key").alias("_good"))
        rest = batch.join(keys, F.col("_key").eqNullSafe(F.col("_good")), "left_anti").withColumn("kept", F.lit(False))
        good.unionByName(rest).write.mode("overwrite").parquet(folder)

    return write


def stream_feed(
    spark: SparkSession,
    feed: Feed,
    rank: int,
    path: str,
    out: str,
    rates: DataFrame,
    now: Column,
    files_per_batch: int | None = None,
) -> list[StreamingQuery]:
    """Start the queries of one feed over all that has landed; they stop when it is processed."""
    spark.conf.set("spark.sql.streaming.fileSource.schema.forceNullable", "true")

    def start(df: DataFrame, name: str, **options) -> StreamingQuery:
        writer = df.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{out}/checkpoints/{name}").queryName(f"{feed.name}-{name}")
        if "each" in options:
            return writer.outputMode("update").foreachBatch(options["each"]).start()
        return writer.format("parquet").option("path", f"{out}/{name}").start()

    parts = [folder for folder, _ in feed.parts] or ["documents"]
    docs = feed.documents(spark, path, streaming=True, files_per_batch=files_per_batch)
    if feed.parts:
        return [start(d, name) for d, name in zip(docs, parts, strict=True)]
    announced = feed.announced() if feed.announced else F.lit(None)
    log = docs[0].select("page_no", announced.cast("long").alias("announced"), BROKEN, F.col("_metadata.file_path").alias("file"))
    return [start(log, "documents"), start(first_rows(feed, rank, docs[0], now), "rows", each=converted(rates, f"{out}/rows"))]


def stream_discovery(
    spark: SparkSession,
    root: str,
    out: str,
    rates: DataFrame,
    now: Column,
    feeds: Sequence[Feed] = DISCOVERY_FEEDS,
    files_per_batch: int | None = None,
) -> None:
    """Stream all feeds under ``root/<feed name>`` side by side to ``out/<feed name>`` and wait for them."""
    queries = []
    for rank, feed in enumerate(feeds):
        queries += stream_feed(spark, feed, rank, f"{root}/{feed.name}", f"{out}/{feed.name}", rates, now, files_per_batch)
    for query in queries:
        query.awaitTermination()


def _logged(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def documents_log(spark: SparkSession, out: str) -> DataFrame:
    return _logged(spark, f"{out}/documents", T.StructType.fromDDL(f"page_no INT, announced LONG, {BROKEN} STRING, file STRING"))


def broken_documents(spark: SparkSession, feed: Feed, out: str) -> DataFrame:
    """The quarantine of documents: ``_broken`` (the text) of those that could not be read."""
    folders = [folder for folder, _ in feed.parts] or ["documents"]
    found = [spark.read.schema(f"{BROKEN} STRING").parquet(f"{out}/{folder}") for folder in folders]
    return reduce(DataFrame.union, found).filter(F.col(BROKEN).isNotNull())


def streamed_rows(spark: SparkSession, feed: Feed, rank: int, out: str, rates: DataFrame, now: Column) -> DataFrame:
    """The newest verdict on each key of one feed: checked columns (in dollars where ``kept``) and ``kept``."""
    if feed.parts:
        docs = [spark.read.schema(f"{schema}, {BROKEN} STRING").parquet(f"{out}/{folder}") for folder, schema in feed.parts]
        checked = checked_records(feed, rank, feed.records(docs), now).select(*CHECKED_SCHEMA.names)
        return to_usd(accepted(checked), rates).withColumns({"errors": F.array().cast("array<string>"), "kept": F.lit(True)})
    rows = _logged(spark, f"{out}/rows", VERDICTS)
    newest = last_per_key(rows, F.col("_key"), ["batch"])
    if feed.unbroken:  # a key is first seen on its lowest page, so one beyond the gap has no row before it
        pages = single_page(documents_log(spark, out)).filter(F.col(BROKEN).isNull() & F.col("page_no").isNotNull())
        sound = before_gap(pages.select(F.lit(feed.name).alias("_feed"), "page_no").distinct(), ["_feed"], "page_no")
        newest = newest.join(sound.select(F.col("page_no").alias("_page")), F.col("row_no.page") == F.col("_page"), "left_semi")
    return newest.select(*CHECKED_SCHEMA.names, "kept")


def read_streamed(
    spark: SparkSession, out: str, rates: DataFrame, now: Column, feeds: Sequence[Feed] = DISCOVERY_FEEDS
) -> DataFrame:
    """Accepted records of all streamed feeds in dollars, as the batch form gives them."""
    every = [streamed_rows(spark, feed, rank, f"{out}/{feed.name}", rates, now) for rank, feed in enumerate(feeds)]
    return reduce(DataFrame.unionByName, every).filter("kept").select(*RAW_SCHEMA.names)


def streamed_status(spark: SparkSession, out: str) -> DataFrame:
    """What has landed of a feed, from the log of its documents."""
    return document_status(documents_log(spark, out), F.col("announced"))


class FeedMetrics(StreamingQueryListener):
    """Adds up what the checks of the streams have observed: ``rows`` and ``rejected`` per feed."""

    def __init__(self) -> None:
        self.rows: Counter[str] = Counter()
        self.rejected: Counter[str] = Counter()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, seen in (event.progress.observedMetrics or {}).items():
            if name.startswith("checked "):
                self.rows[name[8:]] += seen["rows"]
                self.rejected[name[8:]] += seen["rejected"]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
