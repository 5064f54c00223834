"""Near copies: texts that share at least ``SIMILARITY`` of their shingles (Jaccard), checked exactly.

A single 64-bit SimHash cannot tell 0.8 from 0.7, so it only suits the operator that is defined
by its bits. Here pairs are proposed by bands of minima of independent hashes: two texts agree in
a minimum with the probability of their similarity, so a pair at 0.8 misses all 24 bands of 5
with probability 7e-5, while unrelated texts meet nowhere. Texts of different classes whose prints are within the radius
of ``op10_simhash`` are proposed as well, through its tables of pivots. Every proposed pair is then decided by
its two sets of shingles, so nothing below the threshold is ever joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concord.llm.blocks import components, dealt, join_labels, runs
from concord.llm.common import free_name
from concord.llm.simhash import majority, pairs_apart, pivot_table, text_hashes
from concord.session import stage

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, WIDTH = 24, 5
#: Texts in a chunk of a bucket.
CHUNK = 250
#: Bytes of their shingles, at most about: very long texts make smaller chunks.
CHUNK_BYTES = 8 << 20


def _factors() -> np.ndarray:
    """Odd multipliers of the hashes, by rule."""
    return np.array([xxhash.xxh64_intdigest(b"minimum %d" % i) | 1 for i in range(BANDS * WIDTH)], np.uint64)


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(np.array(text_hashes(text or "", SHINGLE_WORDS), np.uint64))


def bands(shingles: np.ndarray, factors: np.ndarray) -> list[int]:
    """One signed long per band; texts without shingles have none."""
    if not len(shingles):
        return []
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        mixed = shingles[i : i + 2048, None] * factors
        np.minimum(low, (mixed ^ (mixed >> np.uint64(32))).min(axis=0), out=low)
    digest = [xxhash.xxh64_intdigest(row.tobytes()) for row in low.reshape(BANDS, WIDTH)]
    return np.array(digest, np.uint64).view(np.int64).tolist()


def signatures(rows: DataFrame) -> DataFrame:
    """``row, doc_id, node, bands, fp``; ``node`` stands for the set of shingles, so copies share it, ``fp`` is its print."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = _factors()
        for batch in batches:
            sets = [shingle_set(t) for t in batch["text"].to_pylist()]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            lists = pa.array([bands(s, factors) for s in sets], pa.list_(pa.int64()))
            fps = pa.array(np.array([majority(s.tolist()) for s in sets], np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["doc_id"], pa.array(nodes), lists, fps], names=["row", "doc_id", "node", "bands", "fp"]
            )

    known = rows.select(F.col("_row").alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return known.mapInArrow(run, "row long, doc_id long, node long, bands array<long>, fp long")


def shared_buckets(nodes: DataFrame) -> DataFrame:
    """``band, value, node`` of buckets with several members; of buckets with the same members one stays."""
    members = nodes.select("node", F.posexplode("bands").alias("band", "value"))
    digest = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"h{i}") for i in (0, 1)]
    sizes = members.groupBy("band", "value").agg(F.count(F.lit(1)).alias("n"), *digest).where("n > 1")
    kept = sizes.groupBy("n", "h0", "h1").agg(F.min(F.struct("band", "value")).alias("b")).select("b.*")
    return members.join(kept, ["band", "value"])


def shingle_sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, shingles`` (64-bit words as bytes) and their ``bytes`` of ``wanted`` (``node, row``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array([shingle_set(t).tobytes() for t in batch["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["node"], sets], names=["node", "shingles"])

    own = rows.join(wanted.withColumnRenamed("row", "_row"), "_row").select("node", F.col("text").cast("string"))
    return own.mapInArrow(run, "node long, shingles binary").withColumn("bytes", F.length("shingles").cast("long"))


def near(sets: list[np.ndarray], chunk: np.ndarray, across: bool, similarity: float = SIMILARITY) -> np.ndarray:
    """Label of each set: its smallest fellow over pairs at least ``similarity`` alike.

    ``across``: only pairs of different chunks. Sets that are already in one class are not compared.
    """
    label = np.arange(len(sets))
    sizes = np.array([len(s) for s in sets])
    flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    mark = np.zeros(flat.max() + 1, bool)
    for i in range(len(sets) - 1):
        open_ = label != label[i]
        if across:
            open_ &= chunk != chunk[i]
        open_[: i + 1] = False
        if not open_.any():
            continue
        mine = flat[starts[i] : starts[i] + sizes[i]]
        mark[mine] = True
        common = np.add.reduceat(mark[flat], starts, dtype=np.int64)
        mark[mine] = False
        alike = np.flatnonzero(open_ & (common >= similarity * (sizes + sizes[i] - common) - 1e-9))
        join_labels(label, np.full(len(alike), i), alike)
    return label


def links(members: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` that join the pairs of a bucket which are alike, directly or over others.

    ``members`` has ``band, value, node, shingles, bytes``. A cell yields a star per class, one link a member.
    """
    cells = dealt(members.withColumn("spread", F.col("node")), ["band", "value"], chunk, "bytes", CHUNK_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["band", "value", "low", "high"]):
            if cell.num_rows < 2:
                continue
            node = cell["node"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"].to_pylist()]
            label = near(sets, cell["chunk"].to_numpy(), cell["low"][0] != cell["high"][0])
            joined = np.flatnonzero(label != np.arange(len(node)))
            if len(joined):
                yield pa.RecordBatch.from_arrays([pa.array(node[joined]), pa.array(node[label[joined]])], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The ``pairs`` (``a, b``) whose ``sets`` (``node, shingles``) are alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = []
            for x, y in zip(batch["a_set"].to_pylist(), batch["b_set"].to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                alike.append(common >= similarity * (len(x) + len(y) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(alike, pa.bool_()))

    own, its = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set")) for c in "ab")
    return pairs.join(own, "a").join(its, "b").select("a", "b", "a_set", "b_set").mapInArrow(run, "a long, b long")


def first_of_each(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one row of each class of near copies, the one with the smallest ``doc_id``.

    Rows are told apart by a number of their own, so rows with equal or null ids are judged one by one;
    a null id is larger than any other. Texts without words are copies of each other.
    """
    number = free_name(docs)
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()), "near-rows")
    rows = numbered.select(F.col(number).alias("_row"), "doc_id", "text")
    signed = stage(signatures(rows), "near-signatures")
    nodes = signed.groupBy("node").agg(F.min("row").alias("row"), F.any_value("bands").alias("bands"), F.any_value("fp").alias("fp"))
    buckets = stage(shared_buckets(nodes), "near-buckets")
    wanted = nodes.select("node", "row").join(buckets.select("node").distinct(), "node")
    sets = stage(shingle_sets(rows, wanted), "near-sets")
    found = components(stage(links(buckets.join(sets, "node"), chunk), "near-links"), "near-stars")
    prints = nodes.select("node", "fp").join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    pairs = stage(pairs_apart(stage(pivot_table(prints), "near-pivots")), "near-pairs")
    if not pairs.isEmpty():
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        sets = stage(shingle_sets(rows, nodes.select("node", "row").join(ends, "node")), "near-sets")
        more = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(confirmed(pairs, sets))
        found = components(stage(more, "near-links"), "near-stars")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = signed.groupBy("node").agg(F.min(order).alias("first"))
    rooted = first.join(found, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("first")["row"].alias(number))
    return numbered.join(rooted.select(number), number, "left_semi").select(docs.columns)
