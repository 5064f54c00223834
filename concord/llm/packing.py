"""Best-fit packing planned on a histogram of lengths.

Documents are tokenized once into pieces of at most one sequence. Best fit decreasing then runs
over the *counts* of the lengths (at most as many numbers as a sequence has tokens), which
yields ranges of equal pieces and the places they take. A piece takes its place by its rank
among the pieces of its length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.llm.common import numbered, query, table, texts
from concord.llm.tokens import encoder
from concord.session import stage

CAPACITY = 2048
END_ID = 0

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, ids: bool = True) -> DataFrame:
    """Pieces of every document's ids (text ids, then ``end_id``), at most ``capacity`` long.

    Only longer documents are cut, and only their first piece is shorter than ``capacity``. A
    null or empty text is the end id alone. ``ids`` (little-endian unsigned 32-bit) are left
    null if not asked for. Rows with equal or null ids are documents of their own.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        names = PIECES.names[: 6 if ids else 5]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                all_ids = encode(text) + end
                n = len(all_ids) // 4
                edge = n - (n - 1) // capacity * capacity
                for piece, start in enumerate([0, *range(edge, n, capacity)]):
                    stop = edge if piece == 0 else start + capacity
                    part = all_ids[4 * start : 4 * stop]
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(part), part)[: len(names)])
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names=names
            )

    schema = T.StructType(PIECES.fields[: 6 if ids else 5])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing over length counts.

    Returns ``(length, first_rank, pieces, first_sequence, per_sequence, offset)``: the pieces of
    this length with ranks from ``first_rank`` on go, ``per_sequence`` to each, into the
    sequences from ``first_sequence`` on, the first of each at ``offset``. Open sequences are held as runs
    with equal free space, so the work depends on the number of lengths, not of documents.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    runs: dict[int, deque[tuple[int, int]]] = {}  # free space: runs of (first sequence, count)
    spaces: list[int] = []  # free spaces that have runs, ascending
    made = 0

    def leave(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in runs:
                runs[space] = deque()
                insort(spaces, space)
            runs[space].append((first, count))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left and (at := bisect_left(spaces, length)) < len(spaces):
            space = spaces[at]  # the tightest space that fits
            first, count = runs[space].popleft()
            if not runs[space]:
                del runs[space], spaces[at]
            fit = space // length
            whole = min(count, left // fit)
            if whole:
                out.append((length, rank, whole * fit, first, fit, capacity - space))
                leave(space - fit * length, first, whole)
                rank, left = rank + whole * fit, left - whole * fit
            if whole < count and 0 < left < fit:  # the last few of this length
                out.append((length, rank, left, first + whole, left, capacity - space))
                leave(space - left * length, first + whole, 1)
                whole, rank, left = whole + 1, rank + left, 0
            leave(space, first + whole, count - whole)
        if left:
            fit = capacity // length
            for whole, per in ((left // fit, fit), (1 if left % fit else 0, left % fit)):
                if whole:
                    out.append((length, rank, whole * per, made, per, 0))
                    leave(capacity - per * length, made, whole)
                    made, rank = made + whole, rank + whole * per
    return out


PLAN = "plan_length long, first_rank long, pieces long, first_sequence long, per_sequence long, plan_offset long"


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    Ranks within a length come from one total order over (length, id, piece), so a length that
    a third of the pieces share is ranked by many tasks. To the driver goes the histogram, at most
    ``capacity`` numbers; the plan comes back as a small table.
    """
    spark = pieces.sparkSession
    ranked = numbered(pieces, "length", "doc_id", "piece", "ids_crc32", label="pack-ranks")
    histogram = {n: (c, first) for n, c, first in ranked.groupBy("length").agg(F.count(F.lit(1)), F.min("pos")).collect()}
    steps = plan({n: c for n, (c, _) in histogram.items()}, capacity)
    slots = spark.createDataFrame([(s[0], s[1] + histogram[s[0]][1], *s[2:]) for s in steps], PLAN)
    within = (F.col("pos") >= F.col("first_rank")) & (F.col("pos") < F.col("first_rank") + F.col("pieces"))
    nth = F.col("pos") - F.col("first_rank")
    return ranked.join(slots, (F.col("length") == F.col("plan_length")) & within).select(
        *pieces.columns,
        (F.col("first_sequence") + F.floor(nth / F.col("per_sequence"))).cast("long").alias("sequence_id"),
        (F.col("plan_offset") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """Packed pieces of all documents; with ``ids`` also their token ids.

    Clashing or extra columns of ``docs`` are not carried; an empty table gives no rows.
    """
    pieces = stage(cut(texts(docs), tokenizer, capacity, ids=ids), "pack-pieces")
    return place(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` (binary) and the documents in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))  # at most one per token
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"])).alias("ids"),
            F.col("parts.doc_id").alias("doc_ids"),
        )
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = pack(docs, tokenizer_path("byte_bpe_50k.json"), ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
