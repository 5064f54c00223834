"""WARC archives: round trips, foreign files, pushed filters and what is not decoded."""

import base64
import gzip
import hashlib
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from concord.llm import warc
from concord.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload string, latest int, sha1 array<int>"
ROWS = [
    (1, "http://a/1", "<p>één</p>", "x", 1, None),
    (2, "http://a/2", "<p>één</p>", "x", 1, [1]),
    (9, None, "<p>één</p>", None, 1, None),
    (3, "http://b/ with\r\nline", "", None, None, None),
    (4, "http://b/4", None, None, None, None),
    (5, "http://b/5", "x" * 3_000_000 + "WARC/1.1\r\n\r\n", None, None, None),
    (None, "http://c", "<p>één</p>", None, None, None),
    (None, "http://c", "alone", None, None, None),
    (7, "u", "again", None, None, None),
    (7, "u", "again", None, None, None),
]


def digest(text):
    return "sha1:" + base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def archive(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.register(spark)
    warc.records(pages).write.format("warc").option("maxBytes", 2_000).option("splitBytes", 500).mode("append").save(path)
    return path


def test_round_trip(spark, archive):
    rows = warc.read_warc(spark, archive, verify="true", partitionBytes="700").collect()
    latest = {}
    for page_id, _, html, *_ in ROWS:
        latest[html or ""] = max((page_id, latest.get(html or "")), key=lambda i: -1 if i is None else i)
    want = []
    for page_id, _, html, *_ in ROWS:
        own = latest[html or ""] == page_id
        want.append((page_id, "response" if own else "revisit", digest(html), len((html or "").encode()), (html or "").encode() if own else None, None if own else latest[html or ""]))

    def number(r, name):
        value = r["headers"].get(name)
        return None if value is None else int(value)

    got = [(number(r, "Page-ID"), r.record_type, r.payload_digest, r.payload_bytes, None if r.payload is None else bytes(r.payload), number(r, "Refers-To-Page-ID")) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    ids = {r.record_id for r in rows if r.record_type == "response"}
    assert all(r.refers_to in ids for r in rows if r.record_type == "revisit")


def test_least_bytes(pages):
    kinds = warc.records(pages, least_bytes=1).groupBy("record_type").count().collect()
    assert {r[0]: r[1] for r in kinds} == {"response": 7, "revisit": 3}


def test_empty_table(spark, pages):
    path = scratch_path(spark, "warc-none")
    warc.write_pages(pages.where("false"), path)
    assert warc.read_warc(spark, path).count() == 0


def test_filters_are_decided_on_headers(spark, archive):
    def ids(filters, **options):
        return sorted(r["headers"].get("Page-ID", "none") for r in warc.read_warc(spark, archive, filters, **options).collect())

    assert ids([("record_type", "=", "revisit"), ("target_uri", "starts", "http://a/"), ("content_length", "<", 1000)], payload="false") == ["1", "2"]
    assert ids([("record_type", "in", ["revisit", "warcinfo"])]) == ["1", "2", "3", "none"]
    assert ids([("Page-ID", "=", "5")]) == ["5"] and ids([("target_uri", "null", True)]) == ["9"]
    assert ids([("target_uri", "not starts", "http://")]) == ["7", "7"]
    with pytest.raises(KeyError):
        warc.read_warc(spark, archive, [("record_type", "like", "r%")])
    frame = warc.read_warc(spark, archive)
    assert frame.where("record_type = 'revisit'").count() == 4 and frame.count() == len(ROWS)
    both = frame.where("record_type = 'revisit'").union(frame.where("payload_bytes = 5"))
    assert both.count() == 4 + 3


def test_where_can_be_pushed_by_spark(spark, archive):
    loaded = warc.read_warc(spark, archive, pushdown="true")
    found = loaded.where("record_type = 'revisit' AND target_uri LIKE 'http://a/%' AND content_length < 1000")
    assert ") Filter" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["headers"]["Page-ID"] for r in found.collect()) == ["1", "2"]
    other = warc.read_warc(spark, archive, pushdown="true").where("NOT record_type = 'revisit' AND payload_bytes = 5").collect()
    assert sorted(bytes(r.payload) for r in other) == [b"again", b"again", b"alone"]
    assert warc.read_warc(spark, archive, pushdown="true").where("target_uri IS NULL").count() == 1


def test_unwanted_payloads_are_not_decoded(spark, tmp_path):
    payload = random.Random(1).randbytes(600_000)  # does not compress, so the damage lies in the payload
    members = [bytearray(warc.member(warc.record({"record_type": "resource", "target_uri": f"u{i}", "payload": payload, "payload_digest": "sha1:" + warc.base32_sha1(payload)}))) for i in range(3)]
    members[1][-30_000:-20] = b"\xff" * len(members[1][-30_000:-20])
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    frame = warc.read_warc(spark, str(tmp_path), verify="true")
    left = warc.read_warc(spark, str(tmp_path), [("target_uri", "not =", "u1")], verify="true")
    assert [r.target_uri for r in left.collect()] == ["u0", "u2"]
    assert warc.read_warc(spark, str(tmp_path), payload="false").count() == 3
    with pytest.raises(Exception):
        frame.select(F.sum(F.length("payload"))).collect()


def test_archives_of_other_writers(spark, tmp_path):
    plain = [
        b"WARC/1.0\r\nwarc-type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 7\r\n\r\nabc\r\n\r\n\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://x/\r\n y\r\nContent-Type: application/http; msgtype=response\r\n"
        b"Content-Length: 46\r\n\r\nHTTP/1.0 200 OK\r\nX: y\r\n\r\n<p>WARC/1.0\r\n\r\nhi</p>\r\n\r\n",
        b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
    ]
    (tmp_path / "p").mkdir()
    (tmp_path / "p/plain.warc").write_bytes(b"".join(plain))
    (tmp_path / "p/members.warc.gz").write_bytes(b"".join(map(gzip.compress, plain)))
    (tmp_path / "p/whole.warc.gz").write_bytes(gzip.compress(b"".join(plain)))
    for name in ("plain.warc", "members.warc.gz", "whole.warc.gz"):
        rows = warc.read_warc(spark, str(tmp_path / "p" / name)).collect()
        assert [(r.record_type, r.target_uri, bytes(r.payload)) for r in rows] == [
            ("warcinfo", None, b"abc\r\n\r\n"),
            ("response", "http://x/ y", b"<p>WARC/1.0\r\n\r\nhi</p>"[:21]),
            ("metadata", None, b""),
        ]
    assert warc.read_warc(spark, str(tmp_path / "p"), [("record_type", "=", "response")]).count() == 3


def test_files_of_lost_tasks_are_not_read(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(pages, path)
    stray = warc.member(warc.record({"target_uri": "stray", "payload": b""}))
    (Path(path) / "0-stray.warc.gz").write_bytes(stray)
    assert warc.read_warc(spark, path).count() == len(ROWS)
    warc.records(pages.limit(1)).write.format("warc").mode("overwrite").save(path)
    assert warc.read_warc(spark, path).count() == 1


def test_wrong_digest_is_an_error(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(warc.member(warc.record({"payload": b"x", "payload_digest": digest("y")})))
    assert warc.read_warc(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read_warc(spark, str(tmp_path), verify="true").collect()


def test_parts_are_planned_by_bytes():
    files = [("a", 10, []), ("b", 100, [40, 80]), ("c", 5, []), ("d", 5, [])]
    assert [p.parts for p in warc.planned(files, 50)] == [[("a", 0, None), ("b", 0, 40)], [("b", 40, 80)], [("b", 80, None), ("c", 0, None), ("d", 0, None)]]


def test_query_equals_sql(spark, sf_dir):
    from concord.llm.queries import ORACLES, QUERIES
    from tests.oracle import compare, duck

    assert compare(spark, duck(sf_dir), "op13_warc", SimpleNamespace(build=QUERIES["op13_warc"], sql=ORACLES["op13_warc"]), sf_dir) == ""
