"""Spelling variants: pairs of words one edit apart, by composing acceptors with a one-edit transducer.

The words of one length are the language of a minimal acyclic acceptor. Its composition with a
transducer that replaces (or inserts) exactly one letter and with an acceptor again has pairs of
states as its states: two equal states before the edit, two states that must accept the same rest
after it. Sub-results belong to states, not to words, so what endings have in common is worked out
once; a state's number of words turns paths into positions in the sorted list.

The vocabulary is dealt to tasks by initial states: all words that reach the same state by the same
first letters. A beginning held by more than ``BLOCK`` words is divided by its next letter. Pairs
whose edit lies within the beginning have a common ending instead; they are found by the same
composition over the reversed words, and each pair is taken on one side only. Beginnings at their
greatest depth that are still too large are compared in cells of two chunks.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm.blocks import dealt, runs
from concord.llm.common import ascii_lower, query, table, texts
from concord.session import stage

#: Letters of a run; the multiplication and division signs lie in this range too.
RUN = "[A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: One of so many runs loses a letter (by hash).
DAMAGED = 97
#: Words of an initial state above which its next letter divides it (work per task only).
BLOCK = 1_500
#: Letters that an initial state takes at most; half of the word, if that is less.
DEEPEST = 16
#: A word's form is a near word that occurs so many times as often.
TIMES = 2


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, damaged: int = DAMAGED) -> DataFrame:
    """``word, n``: the distinct words of all texts and their numbers of occurrences.

    Null and empty texts have no words; a null id counts as an empty one in the hash; rows with equal
    ids or texts count one by one. Occurrences are added up per task before they are shuffled, so a
    very common word is as cheap as any other.
    """
    rows = texts(docs).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), ascii_lower("text").alias("text"))
    each = rows.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run").cast("binary"))
    hit = each.where(F.length("run") >= least_letters).select("run", h.alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hit.select(F.when(F.col("h") % damaged == 0, short).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= least_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= least_count)


class Acceptors:
    """Minimal acyclic acceptors that share their states. State 0 accepts the empty rest.

    ``arcs[s]`` leads from a letter to the next state and to the number of words that come before
    it among those which ``s`` accepts; ``count[s]`` is the number of words which ``s`` accepts.
    """

    def __init__(self) -> None:
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.count = [1]
        self._known: dict[tuple, int] = {}
        self._same: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self._replaced: dict[int, list[tuple[int, int]]] = {0: []}

    def _state(self, arcs: list[tuple[str, int]]) -> int:
        key = tuple(arcs)
        state = self._known.get(key)
        if state is None:
            state, total, leads = len(self.arcs), 0, {}
            for letter, to in arcs:
                leads[letter] = (to, total)
                total += self.count[to]
            self._known[key] = state
            self.arcs.append(leads)
            self.count.append(total)
        return state

    def add(self, words: list[str]) -> int | None:
        """The initial state of an acceptor of sorted, distinct words of one length."""
        if not words:
            return None
        size = len(words[0])
        if not size:
            return 0
        path: list[list[tuple[str, int]]] = [[] for _ in range(size)]  # closed arcs of the open states
        last = words[0]
        for word in [*words[1:], None]:
            k = 0
            if word is not None:
                while word[k] == last[k]:
                    k += 1
            below = 0
            for depth in range(size - 1, k - 1, -1):
                path[depth].append((last[depth], below))
                if depth > k or word is None:
                    below = self._state(path[depth])
                    path[depth] = []
            last = word
        return below

    def same(self, p: int, q: int) -> list[tuple[int, int]]:
        """Positions (in ``p``, in ``q``) of the words that both states accept."""
        if p == q:
            return [(i, i) for i in range(self.count[p])]
        found = self._same.get((p, q))
        if found is None:
            found = []
            a, b = self.arcs[p], self.arcs[q]
            for letter in a if len(a) <= len(b) else b:
                if letter in a and letter in b:
                    (s, i), (t, j) = a[letter], b[letter]
                    found += [(x + i, y + j) for x, y in self.same(s, t)]
            self._same[p, q] = found
        return found

    def replaced(self, p: int) -> list[tuple[int, int]]:
        """Pairs of words of ``p`` that differ by one replaced letter, each pair once."""
        found = self._replaced.get(p)
        if found is None:
            found, ways = [], list(self.arcs[p].values())
            for k, (s, i) in enumerate(ways):
                found += [(x + i, y + i) for x, y in self.replaced(s)]
                for t, j in ways[k + 1 :]:
                    found += [(x + i, y + j) for x, y in self.same(s, t)]
            self._replaced[p] = found
        return found

    def inserted(self, p: int, q: int) -> list[tuple[int, int]]:
        """Pairs (word of ``p``, word of ``q``) where the latter has one more letter, each pair once:
        of several places with the same effect, the last counts, so the next letter is another one."""
        found = []
        a, b = self.arcs[p], self.arcs[q]
        for letter, (t, j) in b.items():
            if p == 0:
                found += [(0, y + j) for _, y in self.same(0, t)]
                continue
            after = self.arcs[t]
            for other, (s, i) in a.items():
                if other != letter and other in after:
                    u, k = after[other]
                    found += [(x + i, y + j + k) for x, y in self.same(s, u)]
            if letter in a:
                s, i = a[letter]
                found += [(x + i, y + j) for x, y in self.inserted(s, t)]
        return found


def common_prefix(a: str, b: str) -> int:
    k, size = 0, min(len(a), len(b))
    while k < size and a[k] == b[k]:
        k += 1
    return k


def near_in_cell(words: list[str], m: int, skip: int) -> Iterator[tuple[int, int]]:
    """Positions of pairs of ``words`` (all with the same first ``skip`` letters, of ``m`` or ``m + 1``
    letters) one edit apart after them, without the pairs of two longer words."""
    order = sorted(range(len(words)), key=words.__getitem__)
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 8 * m + 1_000))  # depth follows the letters of a word
    short, long = ([k for k in order if len(words[k]) == size] for size in (m, m + 1))
    acceptors = Acceptors()
    p, q = (acceptors.add([words[k][skip:] for k in part]) for part in (short, long))
    if p is not None:
        for i, j in acceptors.replaced(p):
            yield short[i], short[j]
        if q is not None:
            for i, j in acceptors.inserted(p, q):
                yield short[i], long[j]


def _depths(entries: DataFrame, letters: Column, deepest: Column, block: int, label: str) -> DataFrame:
    """``entries`` with ``depth``: how many first letters its initial state takes."""
    top = F.substring(letters, F.lit(1), deepest)
    tops = stage(entries.select("m", top.alias("top")).groupBy("m", "top").agg(F.count(F.lit(1)).alias("held")), label)
    shorter = tops.select("m", "top", "held", F.explode(F.sequence(F.lit(0), F.length("top"))).alias("k")).withColumn(
        "q", F.substring("top", F.lit(1), F.col("k"))
    )
    large = shorter.groupBy("m", "q").agg(F.sum("held").alias("held")).where(F.col("held") > block).select("m", "q")
    within = shorter.join(stage(large, label), ["m", "q"]).groupBy("m", "top").agg((F.max("k") + 1).alias("depth"))
    known = tops.join(within, ["m", "top"], "left").select("m", "top", F.least(F.length("top"), F.coalesce("depth", F.lit(0))).alias("depth"))
    return entries.withColumn("top", top).join(stage(known, label), ["m", "top"]).drop("top")


def cells(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every word in the cells where it may meet a near word: ``back, m, low, high, key, word, n, ahead``.

    Pairs whose shorter word has ``m`` letters meet in cells of ``m``; ``ahead`` is the depth of the word's
    forward state. Two words with a common prefix of that length have the same forward state,
    any other near pair has the same backward state.
    """
    size = F.length("word")
    entries = words.select("word", "n", F.explode(F.array_distinct(F.array(F.greatest(size - 1, F.lit(1)), size))).alias("m"))
    half = F.least(F.floor(F.col("m") / 2), F.lit(DEEPEST)).cast("int")
    entries = stage(_depths(entries, F.col("word"), half, block, "spelling-first").withColumnRenamed("depth", "ahead"), "spelling-forward")
    forward = entries.select(F.lit(False).alias("back"), "m", F.substring("word", F.lit(1), F.col("ahead")).alias("key"), "word", "n", "ahead")
    turned = _depths(entries, F.reverse("word"), F.least(F.col("m") - half, F.lit(DEEPEST)), block, "spelling-last")
    backward = turned.select(F.lit(True), "m", F.substring(F.reverse("word"), F.lit(1), F.col("depth")), "word", "n", "ahead")
    members = stage(forward.union(backward).withColumn("spread", F.col("word")), "spelling-members")
    return dealt(members, ["back", "m", "key"], block)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``word, n_near, best_n, best``: number of words of ``words`` (``word, n``; distinct) one edit away,
    and the most frequent of them (ties: the first in code-point order). Words without any are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in runs(batches, ["back", "m", "key", "low", "high"]):
            if cell.num_rows < 2:
                continue
            texts_, counts, chunk = (cell[c].to_pylist() for c in ("word", "n", "chunk"))
            back, m, skip = cell["back"][0].as_py(), cell["m"][0].as_py(), len(cell["key"][0].as_py())
            across = cell["low"][0] != cell["high"][0]
            ahead = cell["ahead"].to_pylist()
            found: defaultdict[int, int] = defaultdict(int)
            best: dict[int, tuple[int, str]] = {}
            for i, j in near_in_cell([w[::-1] for w in texts_] if back else texts_, m, skip):
                if across and chunk[i] == chunk[j] or back and common_prefix(texts_[i], texts_[j]) >= ahead[i]:
                    continue
                for a, b in ((i, j), (j, i)):
                    found[a] += 1
                    rank = (-counts[b], texts_[b])
                    if a not in best or rank < best[a]:
                        best[a] = rank
            if found:
                at = list(found)
                columns = [
                    pa.array([texts_[a] for a in at]),
                    pa.array([found[a] for a in at], pa.int64()),
                    pa.array([-best[a][0] for a in at], pa.int64()),
                    pa.array([best[a][1] for a in at]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    parts = cells(words, block).mapInArrow(run, "word string, n_near long, best_n long, best string")
    first = F.min(F.struct((-F.col("best_n")).alias("r"), "best"))
    merged = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("f"))
    return merged.select("word", "n_near", (-F.col("f.r")).alias("best_n"), F.col("f.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms (``word, form``) of each word lead in the end.

    Every step is doubled per round. Counts at least double from word to form, so chains are no
    longer than the logarithm of the largest count, and the rounds its logarithm again.
    """
    steps = stage(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        joined = stage(steps.join(onward, "root", "left"), "spelling-steps")
        if joined.where("beyond IS NOT NULL").isEmpty():
            return steps
        steps = joined.select("word", F.coalesce("beyond", "root").alias("root"))


def variants(docs: DataFrame, block: int = BLOCK, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``.

    Other columns of ``docs`` are not read. An empty table has no words.
    """
    words = stage(vocabulary(docs), "spelling-words")
    near = words.join(near_words(words, block), "word", "left")
    likely = F.col("best_n") >= times * F.col("n")
    near = near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(likely, F.col("best")).alias("form"), F.when(likely, F.col("best_n")).alias("form_n")
    )
    near = stage(near, "spelling-near")
    ends = roots(near.where("form IS NOT NULL"))
    rooted = near.join(ends, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list(list_reduce(range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END, i) ORDER BY i) AS t
    FROM range(256) r(i)
), runs AS (
    SELECT concat(doc_id, ':') AS head, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
), grouped AS (
    SELECT head, run, count(*) AS n, hex(encode(head || run)) AS b FROM runs WHERE length(run) >= 5 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(range(length(b) // 2), lambda a, i: xor(a >> 8, t[1 + (xor(a, ('0x' || substr(b, 2 * i + 1, 2))::BIGINT) & 255)]), 4294967295)) AS h
    FROM grouped, crc
), words AS (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(n) >= 3
), holes AS (
    SELECT word, n, i, substr(word, 1, i) AS head, substr(word, i + 2) AS tail FROM words, range(length(word)) r(i)
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b ON a.i = b.i AND a.head = b.head AND a.tail = b.tail WHERE a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.head || a.tail = b.word
    UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.head || a.tail = b.word
), best AS (
    SELECT word, count(*) AS n_near, min((-other_n, encode(other), other)) AS first FROM near GROUP BY word
), forms AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
        CASE WHEN -first[1] >= 2 * w.n THEN first[3] END AS form, CASE WHEN -first[1] >= 2 * w.n THEN -first[1] END AS form_n
    FROM words w LEFT JOIN best USING (word)
), steps AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, s.root, f.n, f.n_near, f.form_n
FROM forms f JOIN steps s USING (word) JOIN forms e ON e.word = s.root WHERE e.form IS NULL
"""


@query("op12_spelling", _SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
