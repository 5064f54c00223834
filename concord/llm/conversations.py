"""Repair of conversation structure by lightest derivations.

Turns should read ``system? (user assistant)+`` or be none at all. Edits keep, rerole, delete or
insert turns; the cheapest list of edits is a lightest derivation: edits of turns and insertions are
weighted axioms, and a rule joins a repaired beginning with the edit that follows it. Values are
(cost, letters of the edits), compared in this order. Joining adds costs and appends letters. Two
lists for the same turns and states that cost the same are never beginnings of each other (letters
fix the cost), so joining keeps their order and the agenda may finalise the least value first.

A conversation of up to ``SEGMENT`` turns is derived at once. Longer ones are cut into segments that any
task can take: a segment's items are its lightest edits from each state to each state, runs of segments
are joined in rounds by the same rule, and the turns are streamed once more to hash what was repaired.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.common import numbered, query, table
from concord.llm.derivation import lightest
from concord.session import stage

#: Turns, and characters of them, that one derivation takes.
SEGMENT, SEGMENT_CHARS = 512, 32_000_000
#: Segments joined by a task in one round.
JOINED = 64

BLANK = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: States by what they have read: nothing, a system turn, a user turn, an assistant turn.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTING = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
GOAL = ("repaired",)

RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def fault_of(text: str, again: bool) -> str | None:
    """The first fault of a turn; ``again``: the conversation had its role and text before."""
    body = text.rstrip(BLANK)
    if not body:
        return "blank"
    if again:
        return "duplicate"
    return None if body[-1] in ".!?" else "truncated"


def edits(initial: str, fault: str | None) -> Iterator[tuple[str, tuple[int, str]]]:
    """What a turn may become (the initial of its role, or nothing), with its value."""
    yield "", (DELETE, "D")
    if fault in ("blank", "duplicate"):
        return
    extra = TRUNCATED if fault else 0
    if initial in ("s", "u", "a"):
        yield initial, (KEEP + extra, "K")
    for x in ROLES:
        yield x, (REROLE + extra, "R")


def _joined(a: tuple[int, str], b: tuple[int, str]) -> tuple[int, str]:
    return a[0] + b[0], a[1] + b[1]


def derive(turns: list[tuple[str, str | None]], start: int = 0, goal: bool = True) -> dict:
    """Final items of the turns (role initial, fault) from a state on: ``("at", turns done, state)``."""
    axioms: list = [(("at", 0, start), (0, "")), *((("add", x), (INSERT, "I")) for x in ROLES)]
    axioms += [(("turn", i, x), value) for i, (initial, fault) in enumerate(turns) for x, value in edits(initial, fault)]

    def onward(state: int, x: str) -> int | None:
        return STEP.get((state, x)) if x else state

    def rule(item, value, final):
        kind = item[0]
        if kind == "at":
            _, i, state = item
            if i == len(turns) and state in ACCEPTING:
                yield GOAL, value
            for x in ("", "s", "u", "a"):
                to = onward(state, x)
                if to is None:
                    continue
                if (edit := final.get(("turn", i, x))) is not None:
                    yield ("at", i + 1, to), _joined(value, edit)
                if (new := final.get(("add", x))) is not None:
                    yield ("at", i, to), _joined(value, new)
        elif kind == "turn":
            _, i, x = item
            for state in STATES:
                if (before := final.get(("at", i, state))) is not None and (to := onward(state, x)) is not None:
                    yield ("at", i + 1, to), _joined(before, value)
        elif kind == "add":
            for (k, *rest), before in list(final.items()):
                if k == "at" and (to := onward(rest[1], item[1])) is not None:
                    yield ("at", rest[0], to), _joined(before, value)

    return lightest(axioms, rule, GOAL if goal else None)


def repaired(turns: Iterable[tuple[str, str]], audit: str) -> Iterator[tuple[str, str]]:
    """The turns (role, text) after the edits. A rerole or insertion gives the one role the state takes."""
    state, rest = 0, iter(turns)
    for letter in audit:
        if letter != "I":
            role, text = next(rest)
            if letter == "D":
                continue
        x = role[0] if letter == "K" else "a" if state == 2 else "u"
        state = STEP[state, x]
        yield (role, text) if letter == "K" else (ROLES[x], "" if letter == "I" else text)


def illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _digest(turns: Iterable[tuple[str, str]]) -> str:
    made = hashlib.sha256()
    for k, (role, text) in enumerate(turns):
        made.update((("\n" if k else "") + f"{role}:{text}").encode())
    return made.hexdigest()


def repair(turns: list[tuple[int | None, str, str]]) -> tuple:
    """All results of one conversation of (turn, role, text) in order, without its id."""
    seen: set[tuple[str, str]] = set()
    faults = []
    for _, role, text in turns:
        faults.append(fault_of(text, (role, text) in seen))
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in turns]
    cost, audit = derive(list(zip(initials, faults, strict=True)))[GOAL]
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal(initials), cost, audit, _digest(repaired([t[1:] for t in turns], audit)))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present``: the turns after damage by a hash of their place.

    Null roles and texts, and null ids and turns in the hash, are one space. A dropped turn stays as a
    row that is not present, so that its conversation is still known.
    """
    filled = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), filled["role"].alias("role"), filled["text"].alias("text"), kind.alias("kind")
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))),
    )
    return changed.drop("col")


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Consecutive rows of each key as a stream; nulls are keys of their own."""
    rows = (row for batch in batches for row in batch.to_pylist())
    return groupby(rows, key=lambda row: tuple(row[k] for k in keys))


def _records(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 2_000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield _records(held, schema)
            held = []
    yield _records(held, schema)


_RESULT = pa.schema(
    [("conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)
#: Order of turns; Spark puts nulls first.
ORDER = ("turn", "role", "text")


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made() -> Iterator[tuple]:
        for (conv_id,), rows in _runs(batches, ["conv_id"]):
            yield (conv_id, *repair([(r["turn"], r["role"], r["text"]) for r in rows if r["present"]]))

    return _batched(made(), _RESULT)


_SPANS = "conv_id long, at long, first string, last string, blank long, duplicate long, truncated long, illegal long, items array<struct<start:int,stop:int,cost:long,audit:string>>"


def _span_schema() -> pa.Schema:
    item = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    longs = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    return pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("first", pa.string()), ("last", pa.string()), *longs, ("items", pa.list_(item))])


def _span(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of turns: their counts, their ends and their lightest edits from state to state."""

    def made() -> Iterator[tuple]:
        for (conv_id, at), rows in _runs(batches, ["conv_id", "at"]):
            initials, faults = [], []
            for r in rows:
                initials.append(r["role"][:1])
                faults.append(fault_of(r["text"], r["again"]))
            turns = list(zip(initials, faults, strict=True))
            items = []
            for start in STATES:
                final = derive(turns, start, goal=False)
                found = ((stop, final.get(("at", len(turns), stop))) for stop in STATES)
                items += [(start, stop, *value) for stop, value in found if value is not None]
            counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
            yield (conv_id, at, initials[0], initials[-1], *counts, illegal(initials), [dict(zip(("start", "stop", "cost", "audit"), i, strict=True)) for i in items])

    return _batched(made(), _span_schema(), 16)


def _join_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring spans as one: an item from a to b and one from b to c derive one from a to c."""

    def made() -> Iterator[tuple]:
        for (conv_id, onto), rows in _runs(batches, ["conv_id", "onto"]):
            held = None
            for r in rows:
                items = {(i["start"], i["stop"]): (i["cost"], i["audit"]) for i in r["items"]}
                if held is None:
                    held = [r["first"], r["last"], [r["blank"], r["duplicate"], r["truncated"]], r["illegal"], items]
                    continue
                both: dict = {}
                for (a, b), left in held[4].items():
                    for (c, d), right in items.items():
                        if b == c and ((a, d) not in both or _joined(left, right) < both[a, d]):
                            both[a, d] = _joined(left, right)
                counts = [x + r[c] for x, c in zip(held[2], ("blank", "duplicate", "truncated"), strict=True)]
                held = [held[0], r["last"], counts, held[3] + r["illegal"] + illegal([held[1], r["first"]]), both]
            first, last, counts, broken, items = held
            yield (conv_id, onto, first, last, *counts, broken, [{"start": a, "stop": d, "cost": v[0], "audit": v[1]} for (a, d), v in items.items()])

    return _batched(made(), _span_schema(), 4)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of repaired turns; the first row of a conversation (``pos`` -1) brings its edits as text."""
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])

    def made() -> Iterator[tuple]:
        for (conv_id,), rows in _runs(batches, ["conv_id"]):
            audit = next(rows)["text"]
            yield conv_id, _digest(repaired(((r["role"], r["text"]) for r in rows), audit))

    return _batched(made(), schema)


def repair_long(turns: DataFrame, segment: int = SEGMENT, joined: int = JOINED) -> DataFrame:
    """Results of conversations of any length, in the columns of ``RESULT``.

    No task but the last holds more than a segment's turns or ``joined`` spans; the last one streams the turns
    of a conversation through a single hash, which has to be sequential, and holds one letter per edit.
    """
    present = turns.where("present").select("conv_id", "turn", "role", "text")
    rows = stage(numbered(present, "conv_id", *ORDER, label="conversation-turns"), "conversation-numbered")
    starts = rows.groupBy("conv_id").agg(F.min("pos").alias("start"))
    same = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    rows = rows.withColumn("same", same)
    firsts = rows.groupBy("conv_id", "same").agg(F.min("pos").alias("first_pos"))
    known = rows.alias("t").join(firsts.alias("f"), F.col("t.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("t.same") == F.col("f.same")))
    known = known.select("t.conv_id", "t.pos", "t.role", "t.text", (F.col("t.pos") > F.col("f.first_pos")).alias("again"))
    placed = known.join(starts.withColumnRenamed("conv_id", "c"), F.col("conv_id").eqNullSafe(F.col("c")))
    placed = placed.withColumn("at", F.floor((F.col("pos") - F.col("start")) / segment)).drop("c", "start")
    cut = placed.repartition("conv_id", "at").sortWithinPartitions("conv_id", "at", "pos")
    spans = stage(cut.mapInArrow(_span, _SPANS), "conversation-spans")
    while spans.agg(F.max("at")).first()[0]:
        onto = spans.withColumn("onto", F.floor(F.col("at") / joined)).repartition("conv_id", "onto").sortWithinPartitions("conv_id", "onto", "at")
        spans = stage(onto.mapInArrow(_join_spans, _SPANS), "conversation-spans")
    done = F.array_min(F.transform(F.filter("items", lambda i: (i.start == 0) & i.stop.isin(*ACCEPTING)), lambda i: F.struct(i.cost, i.audit)))
    done = stage(spans.withColumn("best", done).select("conv_id", "blank", "duplicate", "truncated", "illegal", "best.*"), "conversation-edits")
    heads = done.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text"))
    stream = heads.union(rows.select("conv_id", "pos", "role", "text")).repartition("conv_id").sortWithinPartitions("conv_id", "pos")
    hashes = stream.mapInArrow(_hashed, "conv_id long, repaired_sha256 string")
    ends = rows.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    everyone = turns.select("conv_id").distinct()
    out = everyone
    for k, part in enumerate((ends, done, hashes)):
        part = part.withColumnRenamed("conv_id", f"_c{k}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"_c{k}")), "left").drop(f"_c{k}")
    none = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return out.fillna(none).select(*(f.name for f in _RESULT))


def repair_all(turns: DataFrame, segment: int = SEGMENT, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """Results per conversation of ``turns`` (``conv_id, turn, role, text, present``; roles and texts not null).

    Turns are taken by ``turn`` (nulls first), then role and text. Rows with a null ``conv_id`` are one
    conversation. A conversation without turns that are present gives zeros, no edits and the hash of
    nothing. Which of the two forms takes a conversation depends on its size alone; their results are equal.
    """
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"), F.sum(F.length("text")).alias("chars"))
    large = stage(sizes.where((F.col("turns") > segment) | (F.col("chars") > segment_chars)).select(F.col("conv_id").alias("c")), "conversation-large")
    if large.isEmpty():
        short, long = turns, None
    else:
        alike = F.col("conv_id").eqNullSafe(F.col("c"))
        short, long = turns.join(large, alike, "left_anti"), stage(turns.join(large, alike, "left_semi"), "conversation-long")
    whole = short.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER).mapInArrow(_whole, RESULT)
    return whole if long is None else whole.union(repair_long(long, segment))


_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, i) ORDER BY i) AS t
    FROM range(256) r(i)
), hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS b
    FROM conversations
), kinds AS (
    SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(range(length(b) // 2),
        lambda a, i: xor(a >> 8, t[1 + (xor(a, ('0x' || substr(b, 2 * i + 1, 2))::BIGINT) & 255)]), 4294967295)) % 20 AS kind
    FROM hashed, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
    FROM kinds
), ordered AS (
    SELECT conv_id, turn, role, text, left(role, 1) AS x, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS stop,
        row_number() OVER w AS i, lag(left(role, 1)) OVER w AS before
    FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), turns AS (
    SELECT *, CASE WHEN stop = '' THEN 'b' WHEN i > min(i) OVER (PARTITION BY conv_id, role, text) THEN 'd' WHEN stop NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM ordered
), priced AS (
    SELECT conv_id, i, x, role || ':' || text AS kept, text, CASE fault WHEN '' THEN 0 WHEN 't' THEN 5 ELSE 1000000 END AS extra FROM turns
), ids AS (SELECT DISTINCT conv_id FROM conversations), states AS (
    SELECT conv_id, 0::BIGINT AS i, (0::BIGINT, '', '') AS s0, (1000000::BIGINT, '', '') AS s1,
        (5::BIGINT, 'I', chr(10) || 'user:') AS s2, (10::BIGINT, 'II', chr(10) || 'user:' || chr(10) || 'assistant:') AS s3
    FROM ids
    UNION ALL
    SELECT conv_id, i, s0, s1, s2, least(n3, (s2[1] + 5, s2[2] || 'I', s2[3] || chr(10) || 'assistant:')) FROM (
        SELECT conv_id, i, s0, s1, n3, least(n2, (s0[1] + 5, s0[2] || 'I', s0[3] || chr(10) || 'user:'),
            (s1[1] + 5, s1[2] || 'I', s1[3] || chr(10) || 'user:'), (n3[1] + 5, n3[2] || 'I', n3[3] || chr(10) || 'user:')) AS s2
        FROM (
            SELECT s.conv_id, p.i, (s0[1] + 2, s0[2] || 'D', s0[3]) AS s0,
                least((s1[1] + 2, s1[2] || 'D', s1[3]), (s0[1] + CASE WHEN x = 's' THEN 0 ELSE 1000000 END + extra, s0[2] || 'K', s0[3] || chr(10) || kept)) AS s1,
                least((s2[1] + 2, s2[2] || 'D', s2[3]),
                    CASE WHEN x = 'u' THEN (m[1] + extra, m[2] || 'K', m[3] || chr(10) || kept) ELSE (m[1] + extra + 1, m[2] || 'R', m[3] || chr(10) || 'user:' || text) END) AS n2,
                least((s3[1] + 2, s3[2] || 'D', s3[3]),
                    CASE WHEN x = 'a' THEN (s2[1] + extra, s2[2] || 'K', s2[3] || chr(10) || kept) ELSE (s2[1] + extra + 1, s2[2] || 'R', s2[3] || chr(10) || 'assistant:' || text) END) AS n3
            FROM (SELECT *, least(s0, s1, s3) AS m FROM states) s JOIN priced p ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.i = s.i + 1
        )
    )
), ends AS (
    SELECT conv_id, arg_max(least(s0, s3), i) AS best FROM states GROUP BY conv_id
), sums AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
        count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
        count(*) FILTER (i > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, best[1] AS cost, best[2] AS audit, sha256(substr(best[3], 2)) AS repaired_sha256
FROM ends e LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query("op11_conversations", _SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_all(damaged(table(spark, sf_dir, "conversations")))
