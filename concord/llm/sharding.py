"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and get a fractional rank there,
``(rank + 0.5) / rows of the source``. In the order of these fractions every stretch holds
the sources in their overall proportions, so cutting it into equal runs gives shards that
all match the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import numbered, query, table, utf8

#: Bytes that a row is charged besides its text.
ROW_BYTES = 16


def interleave(docs: DataFrame, shards: int = 40, stratum: str = "source", seed: int = 42) -> DataFrame:
    """Shard and slot of every row, under the law ``rows`` (counts at most one apart).

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``. A null text has no
    bytes; a null source is a source of its own; rows with equal or null ids are all kept (the
    order among rows equal in every respect does not matter). An empty table gives no rows.
    Texts never move: hashes, sizes and checksums are taken where the rows lie, then two
    range shuffles carry some 60 bytes a row. Each source's count is one row, joined back by
    source; a source with a third of the rows is one hot key on the large side only, which
    adaptive execution splits.
    """
    body = F.coalesce(utf8(F.col("text").cast("string")), F.lit(b""))
    rows = docs.select(
        F.col("doc_id"),
        F.col(stratum).alias("stratum"),
        (F.length(body) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
    ).withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text_crc32"))
    ranked = numbered(rows, "stratum", "shuffle", "doc_id", "size", label="shard-ranks")
    strata = ranked.groupBy(F.col("stratum").alias("s")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first")
    )
    placed = ranked.join(strata, F.col("stratum").eqNullSafe(F.col("s"))).select(
        ((F.col("pos") - F.col("first") + 0.5) / F.col("rows")).alias("fraction"),
        "shuffle",
        "doc_id",
        "size",
        "text_crc32",
    )
    ordered = numbered(placed, "fraction", "shuffle", "doc_id", "size", label="shard-order")
    total = max(1, ordered.count())
    shard = F.expr(f"pos * {shards} div {total}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("pos") - first).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Write ``docs`` (unique ids) under ``path/shard=…``, each shard in slot order."""
    place = assigned.select("doc_id", "shard", "slot")
    wide = docs.drop("shard", "slot").join(place, "doc_id")
    wide.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(
        path
    )


@query("op9_sharding")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interleave(table(spark, sf_dir, "documents"))
