"""Exact substring deduplication by suffix arrays.

Two equal strings of ``MATCH`` bytes have the same inner K-gram of smallest hash, at the same place.
Texts are therefore cut into pieces, the longest stretches in which all such strings choose the
same gram (neighbouring pieces overlap), and equal strings can only meet in pieces with the
same gram. A piece whose gram occurs in one document alone has no match. Of the others every
distinct one is sorted once with all pieces of its gram, which counts as one letter: a suffix array
by Lyndon groups puts equal strings side by side, and the smallest document of each run is what
the others repeat.

Work is passed around in units of some megabytes of whole documents, held as compressed arrays,
so that a row is worth its cost. Every shuffle is by unit or by range of keys, and keys are spread by a
hash: a passage in very many documents is one distinct piece per unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import query, table, texts
from concord.llm.lyndon import suffix_arrays
from concord.session import stage

MATCH, GRAM = 50, 28
UNIT_BYTES = 2 << 20
#: Bytes of a key that are kept; more pieces only become candidates if keys coincide.
KEY_BYTES = 6
#: Codes of pieces whose suffixes are sorted together.
SORT_CODES = 4 << 20
#: Stands for a null id, which sorts behind all others.
NO_ID = np.iinfo(np.int64).max

UNITS = "unit long, ids binary, offsets binary, data binary"


def _packed(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else a.tobytes())


def _unpacked(b: bytes, kind: str = "u1") -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def make_units(docs: DataFrame, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Rows of whole documents; a longer document is a unit of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = TaskContext.get().partitionId() << 32
        ids: list[int] = []
        data: list[bytes] = []
        size = 0

        def closed() -> pa.RecordBatch:
            offsets = np.cumsum([0, *map(len, data)], dtype=np.int64)
            return _batch(UNITS, [(unit, np.array(ids, np.int64).tobytes(), offsets.tobytes(), _packed(b"".join(data)))])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                ids.append(NO_ID if doc_id is None else doc_id)
                data.append(text.encode())
                size += len(data[-1])
                if size >= unit_bytes:
                    yield closed()
                    unit, ids, data, size = unit + 1, [], [], 0
        if ids:
            yield closed()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, UNITS)


def gram_minima(data: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each start of ``match`` bytes the smallest hash (``KEY_BYTES``) of the ``gram``-byte
    strings inside, and where the first such string is."""
    n = max(0, len(data) - match + 1)
    keys, places = np.empty(n, np.uint64), np.empty(n, np.int64)
    step = 1 << 15  # arrays of a step stay in cache
    low = np.uint64(8 * (8 - KEY_BYTES))
    for a in range(0, n, step):
        part = data[a : a + step + match - 1].astype(np.uint64) + np.uint64(1)
        base, width, rest = np.uint64(0x9E3779B97F4A7C15), 1, gram
        hashed: np.ndarray | None = None
        done = 0
        with np.errstate(over="ignore"):
            while rest:  # a polynomial in the bytes, by doubling
                if rest & 1:
                    if hashed is None:
                        hashed = part
                    else:
                        m = len(part) - done
                        hashed = hashed[:m] * base + part[done : done + m]
                    done += width
                rest >>= 1
                if rest:
                    m = len(part) - width
                    part = part[:m] * base + part[width : width + m]
                    width, base = width * 2, base * base
            hashed = hashed ^ (hashed >> np.uint64(29))
            hashed *= np.uint64(0xBF58476D1CE4E5B9)
        # the place in the lower bits decides between equal hashes
        hashed = hashed >> low << low | np.arange(len(hashed), dtype=np.uint64)
        span, width = match - gram + 1, 1
        while width < span:
            shift = min(width, span - width)
            hashed = np.minimum(hashed[:-shift], hashed[shift:])
            width += shift
        b = a + len(hashed)
        keys[a:b] = hashed >> low
        places[a:b] = (hashed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64) + a
    return keys, places


def pieces(data: np.ndarray, offsets: np.ndarray, match: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(start, strings, key, document, inner)`` of all pieces: first byte, number of strings of
    ``match`` bytes that begin in it, key, document number, and place of the gram in the piece."""
    key, place = gram_minima(data, match, gram)
    marks = np.zeros(len(data) + 1, np.int8)
    long = np.diff(offsets) >= match
    np.add.at(marks, offsets[:-1][long], 1)
    np.add.at(marks, offsets[1:][long] - match + 1, -1)
    valid = np.cumsum(marks, dtype=np.int8)[: len(key)].astype(bool)
    begins = valid.copy()
    begins[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    start = np.flatnonzero(begins)
    before = np.cumsum(valid)
    strings = np.diff(np.append(before[start] - 1, before[-1] if len(before) else 0))
    document = np.searchsorted(offsets, start, side="right") - 1
    return start, strings, key[start], document, place[start] - start


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of keys. The smallest of several hashes is mostly small, so keys are mixed first."""
    with np.errstate(over="ignore"):
        mixed = key * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _parts(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Runs of a sorted array: value, first, end."""
    if len(bucket):
        edges = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)]
        for a, b in zip(edges, edges[1:], strict=False):
            yield int(bucket[a]), a, b


def _stepped(ascending: np.ndarray) -> bytes:
    """Ascending numbers as compressed steps, byte by byte: the upper bytes are mostly zero."""
    steps = np.diff(ascending, prepend=np.uint64(0))
    return _packed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _summed(stepped: bytes) -> np.ndarray:
    planes = _unpacked(stepped).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def keys_of(units: DataFrame, buckets: int, match: int, gram: int) -> DataFrame:
    """``bucket, unit, keys``: each unit's distinct keys, with a mark (lowest bit) for those that
    two of its documents have."""
    schema = "bucket long, unit long, keys binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, offsets, data in zip(*(batch[c].to_pylist() for c in ("unit", "offsets", "data")), strict=True):
                _, _, key, document, _ = pieces(_unpacked(data), np.frombuffer(offsets, np.int64), match, gram)
                order = np.argsort(key, kind="stable")
                key, document = key[order], document[order]
                first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
                last = np.append(first[1:], len(key)) - 1 if len(key) else first
                marked = key[first] << np.uint64(1) | (document[first] != document[last]).astype(np.uint64)
                bucket = _bucket(key[first], buckets)
                order = np.argsort(bucket, kind="stable")
                marked, bucket = marked[order], bucket[order]
                yield _batch(schema, [(b, unit, _stepped(marked[a:e])) for b, a, e in _parts(bucket)])

    return units.select("unit", "offsets", "data").mapInArrow(run, schema)


def shared_keys(keys: DataFrame) -> DataFrame:
    """``unit, keys``: those of each unit's keys that another document has too."""
    schema = "unit long, keys binary"

    def run(group: pa.Table) -> pa.Table:
        blobs = group["keys"].to_pylist()
        parts = [_summed(b) for b in blobs]
        marked = np.concatenate(parts)
        unit = np.repeat(np.arange(len(blobs)), [len(p) for p in parts])
        key = marked >> np.uint64(1)
        values, at, times = np.unique(key, return_inverse=True, return_counts=True)
        several = times > 1
        several[at[(marked & np.uint64(1)).astype(bool)]] = True
        keep = several[at]
        key, unit = key[keep], unit[keep]
        names = group["unit"].to_pylist()
        rows = [(names[u], key[a:b].tobytes()) for u, a, b in _parts(unit)]
        return pa.Table.from_batches([_batch(schema, rows)])

    return keys.groupBy("bucket").applyInArrow(run, schema)


CANDIDATES = "kind int, unit long, bucket long, a binary, b binary, c binary"


def candidates(units: DataFrame, shared: DataFrame, buckets: int, match: int, gram: int) -> DataFrame:
    """Pieces with shared keys, once per unit.

    Kind 0, per bucket: the places of their grams and the pieces' lengths (a), smallest document ids (b), bytes (c). Kind 1, per unit:
    where they occur (a: byte, document), and which piece it is (b: number in bucket order).
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_batch(CANDIDATES, [])])
        unit, ids, offsets, data = (left[c][0].as_py() for c in ("unit", "ids", "offsets", "data"))
        known = np.sort(np.frombuffer(b"".join(right["keys"].to_pylist()), np.uint64))
        array = _unpacked(data)
        start, strings, key, document, inner = pieces(array, np.frombuffer(offsets, np.int64), match, gram)
        at = np.minimum(np.searchsorted(known, key), len(known) - 1)
        keep = known[at] == key
        start, strings, key, document, inner = (x[keep] for x in (start, strings, key, document, inner))
        whole, number = array.tobytes(), {}
        which = np.array(
            [number.setdefault(whole[a : a + n], len(number)) for a, n in zip(start.tolist(), (strings + match - 1).tolist(), strict=True)],
            np.int64,
        )
        least = np.full(len(number), NO_ID)
        np.minimum.at(least, which, np.frombuffer(ids, np.int64)[document])
        keys, places = np.zeros(len(number), np.uint64), np.zeros(len(number), np.uint64)
        keys[which], places[which] = key, inner
        bucket = _bucket(keys, buckets)
        order = np.argsort(bucket, kind="stable")
        turned = np.empty(len(order), np.int64)
        turned[order] = np.arange(len(order))
        content = list(number)
        sizes = np.array([len(p) for p in content], np.uint64)
        rows = []
        for b, first, end in _parts(bucket[order]):
            mine = order[first:end]
            rows.append(
                (0, unit, b, _packed(np.stack([places[mine], sizes[mine]])), _packed(least[mine]), _packed(b"".join([content[i] for i in mine.tolist()])))
            )
        rows.append((1, unit, None, _packed(np.stack([start, document])), _packed(turned[which]), None))
        return pa.Table.from_batches([_batch(CANDIDATES, rows)])

    return units.groupBy("unit").cogroup(shared.groupBy("unit")).applyInArrow(run, CANDIDATES)


def least_documents(content: list[bytes], inner: np.ndarray, least: np.ndarray, match: int, gram: int) -> list[np.ndarray]:
    """For each distinct piece and each of its strings, the smallest document that has the string.

    A piece alone with its gram shares no string; others of a gram are sorted together. Every
    string of a piece holds the whole gram, which becomes one code.
    """
    strings = np.array([len(p) - match + 1 for p in content], np.int64)
    edges = np.append(0, np.cumsum(strings))
    out = np.repeat(least, strings)
    numbers: dict[bytes, int] = {}
    grams = [numbers.setdefault(p[i : i + gram], len(numbers)) for p, i in zip(content, inner.tolist(), strict=True)]
    lane = np.array(grams, np.int64)
    order = np.argsort(lane, kind="stable")
    lanes = [(a, b) for _, a, b in _parts(lane[order]) if b - a > 1]
    short = match - gram + 1  # codes of a string
    length = strings + short - 1  # codes of a piece
    weight = [int(length[order[a:b]].sum()) + b - a for a, b in lanes]
    ranked = sorted(range(len(lanes)), key=weight.__getitem__)  # lanes of like size share their steps
    while ranked:
        chosen, size = [], 0
        while ranked and (not chosen or size + weight[ranked[-1]] <= SORT_CODES):
            size += weight[ranked[-1]]
            chosen.append(ranked.pop())
        members = np.concatenate([order[lanes[k][0] : lanes[k][1]] for k in chosen])
        # the gram's code is 0 here, as is the one behind a piece; bytes follow from 3 on
        text = b"".join([content[m][: inner[m]] + b"\0" + content[m][inner[m] + gram :] + b"\0" for m in members.tolist()])
        codes = np.frombuffer(text, np.uint8).astype(np.int16) + np.int16(3)
        stops = np.cumsum(length[members] + 1) - 1
        first = stops - length[members]
        codes[first + inner[members]] = 2
        codes[stops] = 1
        ends = np.cumsum([weight[k] for k in chosen])
        codes[ends - 1] = 0
        sa = suffix_arrays(codes, np.append(0, ends))
        # which answer belongs to the string that begins at a place
        answer = np.full(len(codes), -1, np.int64)
        mine = strings[members]
        spread = np.arange(int(mine.sum())) - np.repeat(np.cumsum(mine) - mine, mine)
        answer[np.repeat(first, mine) + spread] = np.repeat(edges[members], mine) + spread
        sa = sa[answer[sa] >= 0]
        windows = np.lib.stride_tricks.sliding_window_view(codes, short)
        same = np.empty(len(sa), bool)
        same[:1] = False
        for a in range(1, len(sa), 1 << 16):
            b = min(len(sa), a + (1 << 16))
            same[a:b] = (windows[sa[a:b]] == windows[sa[a - 1 : b - 1]]).all(axis=1)
        lane_of = np.searchsorted(ends, sa, side="right")
        same[1:] &= lane_of[1:] == lane_of[:-1]
        heads = np.flatnonzero(~same)
        slot = answer[sa]
        smallest = np.minimum.reduceat(out[slot], heads)
        out[slot] = np.repeat(smallest, np.diff(np.append(heads, len(sa))))
    return [out[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]


def verdicts(found: DataFrame, match: int, gram: int) -> DataFrame:
    """``unit, bucket, least``: per unit and bucket, for the strings of its pieces in order, the
    smallest document that has each."""
    schema = "unit long, bucket long, least binary"

    def run(group: pa.Table) -> pa.Table:
        number: dict[bytes, int] = {}
        ids, which, places = [], [], []
        for a, b, c in zip(*(group[n].to_pylist() for n in ("a", "b", "c")), strict=True):
            inner, sizes = _unpacked(a, "<i8").reshape(2, -1)
            content = _unpacked(c).tobytes()
            ends = np.cumsum(sizes).tolist()
            cut = [content[x:y] for x, y in zip([0, *ends], ends, strict=False)]
            which.append(np.array([number.setdefault(p, len(number)) for p in cut], np.int64))
            places.append(inner)
            ids.append(_unpacked(b, "<i8"))
        every = np.concatenate(which)
        least = np.full(len(number), NO_ID)
        np.minimum.at(least, every, np.concatenate(ids))
        inner = np.zeros(len(number), np.int64)
        inner[every] = np.concatenate(places)
        answers = least_documents(list(number), inner, least, match, gram)
        rows = [
            (u, b, _packed(np.concatenate([answers[i] for i in w.tolist()])))
            for u, b, w in zip(group["unit"].to_pylist(), group["bucket"].to_pylist(), which, strict=True)
        ]
        return pa.Table.from_batches([_batch(schema, rows)])

    return found.where("kind = 0").select("unit", "bucket", "a", "b", "c").groupBy("bucket").applyInArrow(run, schema)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, starts binary, stops binary, kept binary"


def removed(units: DataFrame, found: DataFrame, told: DataFrame, match: int, gram: int) -> DataFrame:
    """Per document its removed spans (bytes; starts and stops as arrays of 64-bit numbers) and what is kept."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, offsets, data = (left[c][0].as_py() for c in ("ids", "offsets", "data"))
        ids, offsets, array = np.frombuffer(ids, np.int64), np.frombuffer(offsets, np.int64), _unpacked(data)
        cover = np.zeros(len(array) + 1, np.int32)
        occurring = left["a"][0].as_py()
        if occurring is not None and right.num_rows:
            start, document = _unpacked(occurring, "<i8").reshape(2, -1)
            which = _unpacked(left["b"][0].as_py(), "<i8")
            ordered = right.sort_by("bucket")["least"].to_pylist()
            least = np.concatenate([_unpacked(b, "<i8") for b in ordered])
            # strings of each piece: found again from any of its occurrences
            at, strings, *_ = pieces(array, offsets, match, gram)
            mine = strings[np.searchsorted(at, start)]
            sizes = np.zeros(int(which.max()) + 1 if len(which) else 0, np.int64)
            sizes[which] = mine
            edges = np.cumsum(sizes) - sizes
            spread = np.arange(int(mine.sum())) - np.repeat(np.cumsum(mine) - mine, mine)
            earlier = least[np.repeat(edges[which], mine) + spread] < np.repeat(ids[document], mine)
            begin = (np.repeat(start, mine) + spread)[earlier]
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + match, -1)
        gone = np.cumsum(cover[:-1]) > 0
        # documents are apart: a span never reaches over an edge, but two may touch there
        fresh = gone.copy()
        fresh[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(gone)]
        fresh[inner] = gone[inner]
        final = gone.copy()
        final[:-1] &= ~gone[1:]
        last = offsets[1:][offsets[1:] > 0] - 1
        final[last] = gone[last]
        starts, stops = np.flatnonzero(fresh), np.flatnonzero(final) + 1
        rows = []
        for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
            lo, hi = np.searchsorted(starts, (a, b))
            taken = int((stops[lo:hi] - starts[lo:hi]).sum())
            kept = array[a:b][~gone[a:b]].tobytes() if taken else array[a:b].tobytes()
            own = None if ids[i] == NO_ID else int(ids[i])
            rows.append((own, b - a, taken, int(hi - lo), (starts[lo:hi] - a).tobytes(), (stops[lo:hi] - a).tobytes(), kept))
        return pa.Table.from_batches([_batch(RESULT, rows)])

    places = found.where("kind = 1").select("unit", "a", "b")
    both = units.join(places, "unit", "left")
    return both.groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(run, RESULT)


def deduplicate(docs: DataFrame, match: int = MATCH, gram: int = GRAM, unit_bytes: int = UNIT_BYTES) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, starts, stops, kept``.

    Removed is each byte under a ``match``-byte string that a document with a smaller id has too,
    judged on the input. Null texts are empty; rows with equal ids do not remove each other's bytes; a null id
    counts as larger than all others. Texts shorter than ``match`` bytes stay whole.
    """
    # few and large, so that very many lanes share each step of a suffix sort
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = stage(make_units(texts(docs), unit_bytes), "dedup-units")
    shared = stage(shared_keys(keys_of(units, buckets, match, gram)), "dedup-keys")
    found = stage(candidates(units, shared, buckets, match, gram), "dedup-pieces")
    told = stage(verdicts(found, match, gram), "dedup-verdicts")
    return removed(units, found, told, match, gram)


@query("op8_substrings")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicate(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
