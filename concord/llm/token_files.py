"""Token ids in files of Simple-8b words.

A word has a 4-bit selector and 60 bits of ids: the selector says how many ids of how many bits
follow. Ids of more than 60 bits follow an escape word as they are. A file holds blocks; a block
has the words of whole documents, with the documents' ids and their places in the block, so a
block is decoded by a few array operations and a document is found without decoding others.
The files are Parquet with one row per block, written and committed by Spark, which any store
that Spark reaches can hold; a lost task leaves no part of a file behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from concord.llm.common import query, table, texts, utf8
from concord.llm.packing import tokenizer_path
from concord.llm.tokens import encoder
from concord.session import scratch_path

END_ID = 2
#: A block is closed when it has this many ids; one document is never divided.
BLOCK_IDS = 1 << 16

#: (ids in a word, bits of each) of selectors 1 to 14. Selector 0 is the escape: the next word
#: is one id of 64 bits.
SELECTORS = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))

#: Lengths of runs, each after the length of the two (overlapping) runs that make it up.
RUNS = ((2, 1), (3, 2), (4, 2), (5, 4), (6, 4), (7, 4), (8, 4), (10, 8), (12, 8), (15, 8), (20, 15), (30, 15), (60, 30))

BLOCKS = "file int, block int, first_id long, n_ids long, doc_ids array<long>, offsets binary, words binary"


def pack_words(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words of unsigned ids, each word taking as many ids as it can.

    The widest id of every run of a selector's length is found for all positions at once, from the widest of
    shorter runs; only the chain from word to word is followed one by one.
    """
    ids = ids.astype(np.uint64)
    n = len(ids)
    kind = np.zeros(n + 60, np.uint8)  # how many selectors are too narrow for the id; nothing follows the end
    for _, bits in SELECTORS:
        kind[:n] += ids >> np.uint64(bits) != 0
    widest = {1: kind}
    for count, part in RUNS:
        widest[count] = np.maximum(widest[part][: n + 61 - count], widest[part][count - part :])
    takes = np.zeros(n, np.uint8)
    selector = np.zeros(n, np.uint8)
    for number in range(len(SELECTORS), 0, -1):  # later rounds take more ids and win
        count, _ = SELECTORS[number - 1]
        fits = widest[count][:n] < number
        takes[fits], selector[fits] = count, number
    chain, p, step = [], 0, takes.tolist()
    while p < n:
        chain.append(p)
        p += step[p] or 1
    heads = np.array(chain, np.int64)
    kinds = selector[heads] if n else selector
    size = np.where(kinds == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    padded = np.append(ids, np.zeros(60, np.uint64))
    for number, (count, bits) in enumerate(SELECTORS, 1):
        here = np.flatnonzero(kinds == number)
        if len(here):
            word = np.full(len(here), np.uint64(number) << np.uint64(60))
            for k in range(count):
                word |= padded[heads[here] + k] << np.uint64(bits * k)
            words[place[here]] = word
    escaped = np.flatnonzero(kinds == 0)
    words[place[escaped] + 1] = ids[heads[escaped]]
    return words


def unpack_words(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of Simple-8b words."""
    kinds = (words >> np.uint64(60)).astype(np.int64)
    if (kinds == 0).any():  # what follows an escape is an id, whatever its upper bits look like
        raw, skip = np.zeros(len(words), bool), -1
        for i in np.flatnonzero(kinds == 0).tolist():
            if i != skip:
                skip = i + 1
                raw[skip] = True
        kinds[raw] = 15
    counts = np.array([0, *(c for c, _ in SELECTORS), 1])[kinds]
    place = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for number, (count, bits) in enumerate(SELECTORS, 1):
        here = np.flatnonzero(kinds == number)
        if len(here):
            word, mask = words[here], np.uint64((1 << bits) - 1)
            for k in range(count):
                out[place[here] + k] = (word >> np.uint64(bits * k)) & mask
    raw = np.flatnonzero(kinds == 15)
    out[place[raw]] = words[raw]
    return out[:n]


def _encoded(tokenizer: str, keeps_space: bool, end_id: int, block_ids: int):
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_space).encode
        file = TaskContext.get().partitionId()
        block, first, n, docs, parts, offsets = 0, 0, 0, [], [], [0]

        def closed() -> pa.RecordBatch:
            words = pack_words(np.frombuffer(b"".join(parts), "<u4"))
            row = ([file], [block], [first], [n], [docs], [np.array(offsets, "<i8").tobytes()], [words.astype("<u8").tobytes()])
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary())
            names = [c.split()[0] for c in BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids = encode(text) + end
                n += len(ids) // 4
                docs.append(doc_id)
                parts.append(ids)
                offsets.append(n)
                if n >= block_ids:
                    yield closed()
                    block, first, n, docs, parts, offsets = block + 1, first + n, 0, [], [], [0]
        if docs:
            yield closed()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, keeps_space: bool = False, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the ids of all documents to ``path``, in ascending order of ``doc_id``.

    Null texts are empty and leave the end id alone; null document ids come first; rows with equal ids
    stand side by side, ordered by text checksum. File ``k`` holds the ``k``-th range of document ids.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    check = F.crc32(utf8("text"))
    rows = texts(docs).select(F.col("doc_id").cast("long"), "text", check.alias("check"))
    ordered = rows.repartitionByRange(parts, "doc_id", "check").sortWithinPartitions("doc_id", "check")
    ordered.mapInArrow(_encoded(tokenizer, keeps_space, end_id, block_ids), BLOCKS).write.option(
        "compression", "none"
    ).parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (binary, little-endian unsigned 32-bit) from the files.

    ``start`` counts the ids of all documents before this one. Blocks are decoded one at a time.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)
    sizes = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in ("first_id", "doc_ids", "offsets", "words", "before", "n_ids")}
                offsets = np.frombuffer(row["offsets"].as_py(), "<i8")
                ids = unpack_words(np.frombuffer(row["words"].as_py(), "<u8"), row["n_ids"].as_py()).astype("<u4")
                edges = pa.array((offsets * 4).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        row["doc_ids"].values,
                        pa.array(offsets[:-1] + row["first_id"].as_py() + row["before"].as_py()),
                        pa.array(np.diff(offsets)),
                        pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, edges.buffers()[1], pa.py_buffer(ids.tobytes())]),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    # one row per file in ``before``
    return blocks.join(F.broadcast(before), "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"))
    return read_tokens(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
