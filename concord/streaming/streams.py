"""Structured Streaming forms of the fan-in, dedup and merge stages.

Conversion has no form of its own: :func:`concord.operators.fx.to_usd` takes streams too.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from concord.operators.golden import merge
from concord.plans.store import Store, utc_date


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    file_format: str = "parquet",
    glob: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Files that keep landing under a folder, as a stream."""
    reader = spark.readStream.format(file_format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def fan_in(streams: Sequence[DataFrame]) -> DataFrame:
    """Union of the feeds' streams, columns matched by name."""
    return reduce(DataFrame.unionByName, streams)


def first_seen(stream: DataFrame, keys: Sequence[str], event_time: str, horizon: str) -> DataFrame:
    """First row of a key to arrive; a copy within the horizon is dropped.

    State is kept per key and expires with the watermark, so it stays bounded.
    """
    return stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def merge_batches(
    store: Store,
    reports: str,
    merge_batch: Callable[[DataFrame], DataFrame] = merge,
    snapshot_date: datetime.date | str | None = None,
    buckets: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` sink: merge *all* of the day's reports on a batch's keys and upsert them.

    A key's reports may come in several batches, so a batch is first added to the reports under
    the folder ``reports`` (by day, batch and bucket of the key), and every key that it touches is
    merged again from all batches up to this one. Only the folders of the buckets it touches are
    opened, so the work follows the batch's keys and not the day's reports. A replayed batch replaces
    its own folder and writes the same rows over the same keys, so it changes nothing. Rows without
    a key are kept with the reports and merged with nothing. There are as many buckets as the store has,
    if not told otherwise.
    """
    dealt = buckets or store.buckets

    def write(batch: DataFrame, batch_id: int) -> None:
        day = str(snapshot_date or utc_date())
        folder = f"{reports}/day={day}"
        bucket = F.pmod(F.xxhash64(store.key), F.lit(dealt)).cast("int")
        placed = batch.withColumn("key_bucket", bucket)
        placed.write.mode("overwrite").partitionBy("key_bucket").parquet(f"{folder}/batch={batch_id}")
        spark = batch.sparkSession
        added = [T.StructField("batch", T.LongType()), T.StructField("key_bucket", T.IntegerType())]
        reader = spark.read.schema(T.StructType([*batch.schema, *added])).option("basePath", folder)
        own = reader.parquet(f"{folder}/batch={batch_id}").filter(F.col(store.key).isNotNull())
        touched = own.select(store.key).distinct()
        opened = sorted(r[0] for r in own.select("key_bucket").distinct().collect())  # at most all buckets
        if opened:
            kept = reader.parquet(f"{folder}/batch=*/key_bucket={{{','.join(map(str, opened))}}}")
            known = kept.filter((F.col("batch") <= batch_id) & F.col(store.key).isNotNull())
            store.save(merge_batch(known.join(touched, store.key, "left_semi").drop("batch", "key_bucket")), day)

    return write


def run_available(
    stream: DataFrame,
    checkpoint: str,
    path: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Process everything that has landed and stop: to Parquet, or to a batch function."""
    writer = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    if each_batch is not None:
        query = writer.foreachBatch(each_batch).start()
    else:
        query = writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query

