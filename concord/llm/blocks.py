"""Comparing the members of buckets in cells of bounded size, and joining links to classes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.session import stage


def dealt(members: DataFrame, keys: list[str], most: int, weight: str | None = None, most_weight: int = 1) -> DataFrame:
    """``members`` dealt into cells ``(*keys, low, high)``; ``chunk`` is the member's own part.

    A bucket of up to ``most`` members is one cell (0, 0). A larger one is divided into chunks of
    about that size; cell (i, j) holds chunks i and j, so every pair of members meets in
    exactly one cell (pairs within a chunk in cell (i, i)) and no task sees more than two chunks.
    With a column ``weight`` a chunk has about ``most_weight`` of it at most. ``members`` is read twice and needs
    a column ``spread`` that tells members apart.
    """
    parts = F.count(F.lit(1)) / most
    if weight is not None:
        parts = F.greatest(parts, F.sum(weight) / most_weight)
    sizes = members.groupBy(*keys).agg(F.ceil(parts).cast("int").alias("chunks"))
    alike = [members[k] == sizes[k] for k in keys]
    own = members.join(sizes, alike).select(members["*"], "chunks")
    own = own.withColumn("chunk", F.pmod(F.xxhash64("spread"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = own.withColumn("other", other).withColumns(
        {"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}
    )
    cell = [*keys, "low", "high"]
    return cells.drop("chunks", "other", "spread").repartition(*cell).sortWithinPartitions(*cell)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal ``keys``, each run as one table."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for start, stop in zip(edges, edges[1:], strict=False):
            key = tuple(c[start] for c in columns)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked positions; ``label`` holds each position's smallest member."""
    while len(a):
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(label, high[apart], low[apart])
        while (label[label] != label).any():
            label[:] = label[label]


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (``a``, ``b``): root is the smallest node reachable.

    Alternating large and small stars: each round points the neighbours of a node at the
    smallest of them, which needs a logarithmic number of rounds. Minima are combined before
    they are shuffled and written before they are joined: no aggregate then stands between the join and its
    shuffle, so a node with very many neighbours is split by adaptive execution, or not shuffled at all where
    the minima are few. Each round is written to the shared folder; only a count and a checksum come to the driver.
    """
    turned = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = stage(turned.where("u <> v").distinct(), label)

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stage(both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), f"{label}-least")
        large = (
            both.join(least, F.col("u") == F.col("w"))
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = stage(large, label)
        least = stage(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), f"{label}-least")
        small = large.join(least, F.col("u") == F.col("w")).select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        edges = stage(small.select("e.*").where("u <> v").distinct(), label)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
