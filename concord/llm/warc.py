"""WARC archives as a Spark data source, ``warc``, for reading and writing.

Writing: each task appends records to files of its own (one gzip member per record) and starts a new
file at ``maxBytes``. The driver publishes the files of the tasks that counted, with places at which they
can be divided, in a manifest; what a lost or repeated task left behind is never listed, so never read.

Reading: the driver plans partitions of about ``partitionBytes`` from whole files and listed places. A task
parses the headers of a record first and decides on the pushed predicates (record type and other
headers). Of a record that is not wanted nothing else is decoded: its member's length stands in an extra
field of the gzip header (subfield ``sl``), or in ``Content-Length`` of a plain file, and is skipped.
Archives of other writers without that field are inflated and passed over.

Predicates are pushed in two ways. ``read_warc(..., filters=[(column, how, value), ...])`` is part of the frame
and always safe. With the option ``pushdown`` set to ``true`` Spark pushes those of ``where`` as well; in
Spark 4.1 they stay with the loaded frame, so that a later query of the same frame, or another branch of the
same query, would miss rows. Set it only for a frame that is loaded for one query.

Options for reading: ``payload`` (``false``: do not return payloads), ``verify`` (``true``: compare payloads
with their digests, an error on difference), ``partitionBytes``, ``parallelism`` (partitions become smaller to be so
many), ``filters`` (JSON), ``pushdown``. For writing: ``maxBytes``, ``splitBytes``.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from concord.llm.common import query, table, utf8
from concord.session import scratch_path, stage

SCHEMA = (
    "record_type string, record_id string, target_uri string, warc_date string, content_type string, content_length long, payload_digest string, "
    "refers_to string, headers map<string,string>, payload_bytes long, payload binary, file string, offset long"
)
#: Columns that come from a header of the record, in which form filters on them are decided.
HEADER_OF = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "target_uri": "WARC-Target-URI",
    "warc_date": "WARC-Date",
    "content_type": "Content-Type",
    "content_length": "Content-Length",
    "payload_digest": "WARC-Payload-Digest",
    "refers_to": "WARC-Refers-To",
}
_SPELT = {h.lower(): h for h in HEADER_OF.values()}  # names come in any case
_ARROW = pa.schema(
    [(c, pa.string()) for c in ("record_type", "record_id", "target_uri", "warc_date", "content_type")]
    + [("content_length", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string()), ("headers", pa.map_(pa.string(), pa.string()))]
    + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("file", pa.string()), ("offset", pa.int64())]
)
MAX_BYTES, SPLIT_BYTES, PARTITION_BYTES, LEAST_BYTES = 256 << 20, 8 << 20, 128 << 20, 4 << 20
#: Rows and bytes of payload after which a batch is handed on.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20
#: Bytes read at a time, and bytes of headers above which a record is taken as damaged.
CHUNK, LONGEST_HEADERS = 1 << 16, 1 << 20
EMPTY_DATE = "1970-01-01T00:00:00Z"
MANIFEST = "_manifest-"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def _clean(value: str) -> str:
    """A header value in one line: blanks and controls, which would end it, are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


# --- records ------------------------------------------------------------------------------


def record(row: dict) -> bytes:
    """The bytes of one record. A payload becomes an HTTP response; a revisit has its headers only."""
    kind, payload = row.get("record_type") or "response", row.get("payload")
    size = row.get("payload_bytes")
    size = len(payload or b"") if size is None else size
    head = {"WARC-Type": kind, "WARC-Record-ID": row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"}
    head["WARC-Date"] = row.get("warc_date") or EMPTY_DATE
    for column in ("target_uri", "refers_to", "payload_digest"):
        if row.get(column) is not None:
            head[HEADER_OF[column]] = row[column]
    if kind in ("response", "revisit"):
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
        head["Content-Type"] = "application/http;msgtype=response"
    else:
        http = b""
        head["Content-Type"] = row.get("content_type") or "application/octet-stream"
    if kind == "revisit":
        head["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        payload = None
    head |= {k: v for k, v in (row.get("headers") or []) if v is not None}
    block = http + (payload or b"")
    head["Content-Length"] = str(len(block))
    lines = "".join(f"{k}: {_clean(v)}\r\n" for k, v in head.items())
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(content: bytes, level: int = 6) -> bytes:
    """A gzip member that tells its own length, so that readers can skip it."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(content) + deflate.flush()
    tail = struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(body) + len(tail)
    if total >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(5) + b"\xff" + body + tail
    extra = b"sl" + struct.pack("<HII", 8, total, len(content) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def headers_of(content: bytes) -> dict[str, str]:
    lines = content.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    folded: list[str] = []
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and folded:
            folded[-1] += " " + line.strip()
        elif line:
            folded.append(line)
    pairs = (line.partition(":") for line in folded)
    return {_SPELT.get(k.strip().lower(), k.strip()): v.strip() for k, _, v in pairs}


class _Member:
    """A gzip member of known length, inflated as far as asked for."""

    def __init__(self, content: Callable[[int, int], bytes], start: int, body: int, stop: int) -> None:
        self._read, self._at, self._stop = content, start + body, stop
        self._inflate, self._held = zlib.decompressobj(-15), b""

    def read(self, n: int) -> bytes:
        while len(self._held) < n and not self._inflate.eof:
            raw = self._inflate.unconsumed_tail
            if not raw:
                raw = self._read(self._at, min(CHUNK, self._stop - self._at))
                self._at += len(raw)
                if not raw:
                    raise ValueError("a member ends early")
            self._held += self._inflate.decompress(raw, max(n - len(self._held), 1 << 12))
        out, self._held = self._held[:n], self._held[n:]
        return out

    def until(self, mark: bytes) -> bytes:
        out, seen = self.read(1 << 10), 0
        while (at := out.find(mark, seen)) < 0:
            seen = max(0, len(out) - len(mark))
            more = self.read(1 << 12)
            if not more or len(out) > LONGEST_HEADERS:
                raise ValueError("headers without an end")
            out += more
        self._held = out[at + len(mark) :] + self._held
        return out[:at]


class _Stream:
    """A plain or inflated stream of records."""

    def __init__(self, file, seeks: bool) -> None:
        self._file, self.seeks = file, seeks

    def until(self, mark: bytes) -> bytes:
        out = bytearray()
        while not out.endswith(mark):
            line = self._file.readline(LONGEST_HEADERS)
            if not line or len(out) > LONGEST_HEADERS:
                if bytes(out).strip():
                    raise ValueError("headers without an end")
                return b""
            if out or line.strip():  # blank lines before a record
                out += line
        return bytes(out[: -len(mark)])

    def read(self, n: int) -> bytes:
        return self._file.read(n)

    def tell(self) -> int:
        return self._file.tell()

    def skip(self, n: int) -> None:
        if self.seeks:
            self._file.seek(n, 1)
            return
        while n > 0 and (got := len(self._file.read(min(n, CHUNK)))):
            n -= got


@dataclass
class Wanted:
    """What a task returns: the tests on headers, and whether payloads are returned and verified."""

    tests: list[tuple[str, str, object]] = field(default_factory=list)
    payload: bool = True
    verify: bool = False

    def takes(self, head: dict[str, str]) -> bool:
        return all(_holds(head, *test) for test in self.tests)


def _holds(head: dict[str, str], name: str, how: str, value) -> bool:
    held = head.get(name)
    if name == "Content-Length" and held is not None:
        held = int(held)
    if how == "null":
        return (held is None) == value
    if how == "same":  # null-safe
        return held == value
    if how.startswith("not "):
        return held is not None and not _holds(head, name, how[4:], value)
    if held is None or value is None:
        return False
    return {
        "=": lambda: held == value,
        "in": lambda: held in value,
        "<": lambda: held < value,
        "<=": lambda: held <= value,
        ">": lambda: held > value,
        ">=": lambda: held >= value,
        "starts": lambda: held.startswith(value),
        "ends": lambda: held.endswith(value),
        "holds": lambda: value in held,
    }[how]()


def _row(head: dict[str, str], source, wanted: Wanted, file: str, offset: int) -> dict:
    """The row of a record whose headers are read; decodes of its block what the row needs."""
    length = int(head.get("Content-Length", 0))
    row = {c: head.get(h) for c, h in HEADER_OF.items()} | {"content_length": length, "headers": list(head.items()), "file": file, "offset": offset}
    http = head.get("Content-Type", "").startswith("application/http")
    told = None
    if http:
        first = source.until(b"\r\n\r\n")
        found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", first)
        told = int(found[1]) if found else None
        left = length - len(first) - 4
    else:
        left = length
    if head.get("WARC-Type") == "revisit":
        row["payload_bytes"], left_out = told, left
    elif wanted.payload or wanted.verify:
        payload, left_out = source.read(left), 0
        if len(payload) != left:
            raise ValueError(f"{file} at {offset}: the block ends early")
        row["payload_bytes"] = len(payload)
        digest = row["payload_digest"]
        if wanted.verify and digest and digest.startswith("sha1:") and digest[5:] != base32_sha1(payload):
            raise ValueError(f"{file} at {offset}: the payload differs from its digest")
        if wanted.payload:
            row["payload"] = payload
    else:
        row["payload_bytes"], left_out = left, left
    row["_left"] = left_out
    return row


def _sl(head: bytes) -> tuple[int, int] | None:
    """Bytes before the body and in all of a gzip member, if its extra field says so."""
    if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or head[3] != 4:
        return None
    size = struct.unpack_from("<H", head, 10)[0]
    at, stop = 12, 12 + size
    while at + 4 <= min(stop, len(head)):
        n = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == b"sl" and n == 8 and at + 8 <= len(head):
            return stop, struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + n
    return None


def read_records(store: pafs.FileSystem, path: str, start: int, stop: int | None, wanted: Wanted) -> Iterator[dict]:
    """The wanted records that begin in ``[start, stop)`` of one file."""
    with store.open_input_file(path) as file:
        size = file.size()
        stop = size if stop is None else stop
        held, begin = b"", 0

        def content(at: int, n: int) -> bytes:
            nonlocal held, begin
            if not begin <= at <= at + n <= begin + len(held):
                file.seek(at)
                held, begin = file.read(max(n, CHUNK)), at
            return held[at - begin : at - begin + n]

        if path.endswith(".gz"):
            at = start
            while at < stop:
                lengths = _sl(content(at, 32))
                if lengths is None:
                    break
                body, total = lengths
                part = _Member(content, at, body, min(at + total, size))
                head = headers_of(part.until(b"\r\n\r\n"))
                if wanted.takes(head):
                    yield _row(head, part, wanted, path, at)
                at += total
            if at >= stop:
                return
            file.seek(at)
            stream = _Stream(gzip.GzipFile(fileobj=file), False)
        else:
            file.seek(start)
            stream = _Stream(io.BufferedReader(file, CHUNK), True)
            at = start
        while True:
            if stream.seeks:
                at = stream.tell()
                if at >= stop:
                    return
            block = stream.until(b"\r\n\r\n")
            if not block:
                return
            head = headers_of(block)
            if wanted.takes(head):
                row = _row(head, stream, wanted, path, at)
                yield row
                stream.skip(row["_left"])
            else:
                stream.skip(int(head.get("Content-Length", 0)))


# --- the data source ------------------------------------------------------------------------


class Files(ds.InputPartition):
    """Parts of files that one task reads: (path, start, stop or None)."""

    def __init__(self, parts: list[tuple[str, int, int | None]]) -> None:
        self.parts = parts


def listed(path: str) -> list[tuple[str, int, list[int]]]:
    """Files of an archive with their sizes and dividing places: those of its manifests or, without any,
    all files below ``path`` whose names end in ``.warc`` or ``.warc.gz``."""
    store, root = filesystem(path)
    if store.get_file_info(root).type == pafs.FileType.File:
        return [(root, store.get_file_info(root).size, [])]
    found = [i for i in store.get_file_info(pafs.FileSelector(root, recursive=True)) if i.type == pafs.FileType.File]
    manifests = [i.path for i in found if i.base_name.startswith(MANIFEST)]
    if not manifests:
        return sorted((i.path, i.size, []) for i in found if i.base_name.endswith((".warc", ".warc.gz")))
    out = []
    for m in manifests:
        with store.open_input_file(m) as file:
            out += [(f"{root}/{name}", size, places) for name, size, places in json.loads(file.read())["files"]]
    return sorted(out)


def planned(files: list[tuple[str, int, list[int]]], partition_bytes: int) -> list[Files]:
    """Neighbouring parts together up to ``partition_bytes``; a part is a file or what lies between two places."""
    out, held, size = [], [], 0
    for path, total, places in files:
        for start, stop in zip([0, *places], [*places, None], strict=True):
            part = (total if stop is None else stop) - start
            if held and size + part > partition_bytes:
                out.append(Files(held))
                held, size = [], 0
            if held and held[-1][0] == path and held[-1][2] == start:
                held[-1] = (path, held[-1][1], stop)
            else:
                held.append((path, start, stop))
            size += part
    return [*out, Files(held)] if held else out


class WarcReader(ds.DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.parallelism = int(options.get("parallelism", 1))
        tests = [tuple(t) for t in json.loads(options.get("filters", "[]"))]
        self.wanted = Wanted(tests, options.get("payload", "true") == "true", options.get("verify", "false") == "true")
        self.pushdown = options.get("pushdown", "false") == "true"

    def pushFilters(self, filters: list[ds.Filter]) -> Iterator[ds.Filter]:
        for f in filters:
            test = self._test(f) if self.pushdown else None
            if test is None:
                yield f
            else:
                self.wanted.tests.append(test)

    def _test(self, f: ds.Filter) -> tuple[str, str, object] | None:
        if isinstance(f, ds.Not):
            inner = self._test(f.child)
            return (inner[0], f"not {inner[1]}", inner[2]) if inner and inner[1] in ("=", "in", "starts", "ends", "holds") else None
        name = HEADER_OF.get(f.attribute[0]) if len(f.attribute) == 1 else None
        if name is None:
            return None
        if isinstance(f, ds.IsNull | ds.IsNotNull):
            return name, "null", isinstance(f, ds.IsNull)
        kinds = {
            ds.EqualTo: "=", ds.EqualNullSafe: "same", ds.In: "in", ds.LessThan: "<", ds.LessThanOrEqual: "<=", ds.GreaterThan: ">",
            ds.GreaterThanOrEqual: ">=", ds.StringStartsWith: "starts", ds.StringEndsWith: "ends", ds.StringContains: "holds",
        }
        return (name, kinds[type(f)], f.value) if type(f) in kinds else None

    def partitions(self) -> list[Files]:
        files = listed(self.path)
        even = sum(size for _, size, _ in files) // max(1, self.parallelism)
        return planned(files, min(self.partition_bytes, max(LEAST_BYTES, even))) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r.get(f.name) for r in rows], f.type) for f in _ARROW]
            return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

        store, _ = filesystem(self.path)
        for path, start, stop in partition.parts:
            for row in read_records(store, path, start, stop, self.wanted):
                rows.append(row)
                size += len(row.get("payload") or b"")
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        yield batch()


@dataclass
class Written(ds.WriterCommitMessage):
    files: list[tuple[str, int, list[int]]]


class WarcWriter(ds.DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], overwrite: bool) -> None:
        self.path, self.overwrite = options["path"], overwrite
        self.max_bytes, self.split_bytes = int(options.get("maxbytes", MAX_BYTES)), int(options.get("splitbytes", SPLIT_BYTES))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        done: list[tuple[str, int, list[int]]] = []
        out, name, size, places = None, "", 0, []
        for batch in iterator:
            for i in range(batch.num_rows):
                content = member(record({c: batch[c][i].as_py() for c in batch.schema.names}))
                if out is not None and size + len(content) > self.max_bytes:
                    out.close()
                    done.append((name, size, places))
                    out = None
                if out is None:
                    name, size, places = f"{self.job}-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done):04d}.warc.gz", 0, []
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                if size - (places[-1] if places else 0) >= self.split_bytes:
                    places.append(size)
                out.write(content)
                size += len(content)
        if out is not None:
            out.close()
            done.append((name, size, places))
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        store.create_dir(root, recursive=True)
        found = store.get_file_info(pafs.FileSelector(root)) if self.overwrite else []
        old = [i.path for i in found if i.base_name.startswith(MANIFEST)]
        files = [f for m in messages if m for f in m.files]
        with store.open_output_stream(f"{root}/{MANIFEST}{self.job}.json", compression=None) as out:
            out.write(json.dumps({"files": files}).encode())
        for path in old:
            store.delete_file(path)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = filesystem(self.path)
        for name, *_ in (f for m in messages if m for f in m.files):
            store.delete_file(f"{root}/{name}")


class WarcSource(ds.DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format ``warc`` known to the session (which wants to be asked about pushed filters)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages -----------------------------------------------------------------------------------


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """A record per row of ``pages`` (``page_id, url, html``), in the columns that the format writes.

    The payload is the html in UTF-8 (null: empty). Of payloads that are equal (SHA-1) and have
    ``least_bytes`` or more, the one with the largest ``page_id`` is a response and the others revisit
    it; rows which share that id are all responses, and null ids are smaller than any other. Other
    columns are not read. Only payloads that occur more than once are looked up, so pages are not
    shuffled unless those are many.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), utf8(F.coalesce("html", F.lit(""))).alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    seen = rows.where(F.col("payload_bytes") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("latest"), F.count(F.lit(1)).alias("n"))
    again = stage(seen.where("n > 1").select("sha1", "latest"), "warc-repeated")
    marked = rows.join(again, "sha1", "left")
    known = (F.col("payload_bytes") >= least_bytes) & F.col("latest").isNotNull()
    marked = marked.withColumn("revisit", known & ~F.col("page_id").eqNullSafe(F.col("latest")))
    return marked.select(
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        _record_id("page_id").alias("record_id"),
        F.col("url").alias("target_uri"),
        F.concat(F.lit("sha1:"), base32("sha1")).alias("payload_digest"),
        F.when(F.col("revisit"), _record_id("latest")).alias("refers_to"),
        F.map_from_arrays(
            F.array(F.lit("Page-ID"), F.lit("Refers-To-Page-ID")),
            F.array(F.col("page_id").cast("string"), F.when(F.col("revisit"), F.col("latest").cast("string"))),
        ).alias("headers"),
        "payload_bytes",
        F.when(~F.col("revisit"), F.col("payload")).alias("payload"),
    )


def _record_id(page_id: str) -> F.Column:
    h = F.sha1(utf8(F.concat(F.coalesce(F.col(page_id).cast("string"), F.lit("")), F.lit(":"), "sha1")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), parts[0], F.lit("-"), parts[1], F.lit("-5"), parts[2], F.lit("-8"), parts[3], F.lit("-"), parts[4], F.lit(">"))


def base32(sha1: str) -> F.Column:
    """Bare base32 of a SHA-1 in hexadecimal: eight letters for every ten digits."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    parts = []
    for k in range(4):
        number = F.conv(F.substring(sha1, 10 * k + 1, 10), 16, 10).cast("long")
        parts += [F.substring(F.lit(letters), (F.shiftright(number, 35 - 5 * i).bitwiseAND(31) + 1).cast("int"), F.lit(1)) for i in range(8)]
    return F.concat(*parts)


def write_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    register(pages.sparkSession)
    records(pages, least_bytes).write.format("warc").mode("append").save(path)


def read_warc(spark: SparkSession, path: str, filters: list[tuple] = (), **options: str) -> DataFrame:
    """The records of an archive, those alone for which all ``filters`` hold.

    A filter is (column or header name, how, value); how is one of ``=``, ``in``, ``<``, ``<=``, ``>``, ``>=``, ``starts``,
    ``ends``, ``holds`` (any of these after ``not ``), or ``null`` with true or false. A header that a record
    does not have passes only ``null``.
    """
    register(spark)
    tests = [(HEADER_OF.get(name, name), how, value) for name, how, value in filters]
    for name, how, value in tests:
        _holds({name: "0"}, name, how, value)  # an unknown comparison is an error here, not in a task
    known = {"filters": json.dumps(tests), "parallelism": str(spark.sparkContext.defaultParallelism)}
    return spark.read.format("warc").options(**(known | options)).load(path)


_SQL = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), letters AS (
    SELECT page_id, payload_bytes, h, max(page_id) OVER (PARTITION BY h) AS latest,
        list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(h, 10 * (i // 8)::INT + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INT, 1)), 'string_agg', '') AS payload_digest
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM latest THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id IS DISTINCT FROM latest THEN latest END AS refers_to
FROM letters
"""


@query("op13_warc", _SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_pages(table(spark, sf_dir, "pages"), path)
    read = read_warc(spark, path, payload="false", verify="true")
    return read.select(
        F.col("headers")["Page-ID"].cast("long").alias("page_id"),
        "payload_bytes",
        F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
        "record_type",
        F.col("headers")["Refers-To-Page-ID"].cast("long").alias("refers_to"),
    )
