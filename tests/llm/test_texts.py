"""Operators on texts against brute force, on a small table with all the odd cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from concord.llm import boosting, decontaminate, packing, pii, sharding, simhash, substrings, token_files, toxicity
from concord.llm.lyndon import suffix_arrays
from concord.session import scratch_path

WORDS = "the of and to in river stone light amber quiet Étude über naïve señor crane bolt".split()
SCHEMA = "doc_id long, text string, source string, row string, pos long, shard int, extra array<int>"


def _corpus() -> list[tuple]:
    draw = random.Random(7)
    prose = [" ".join(draw.choice(WORDS) + draw.choice(["", "", ",", "."]) for _ in range(draw.randint(1, 90))) for _ in range(40)]
    long = " ".join(draw.choice(WORDS) + str(draw.randint(0, 999)) for _ in range(6000))
    texts = prose + prose[:6] + [prose[3] * 2, prose[4] + " tail", "x" + prose[5][3:], long, long[:20_000]]
    texts += [None, "", " ", "\n\n", "word", "AAAA" * 60, "ab" * 90, "  two  spaces \n here\n\n\nthere\t tab ", "é" * 80, "a@b.c_d@e.f 1.2.3.4.5.6.7.8"]
    texts += ["mail me.x+y@mail-1.example.co.uk. or +1 (234) 555-7890 now", "4539 1488 0343 6467 and 4539148803436468", "ip 10.0.255.1 and 999.1.1.1 +123", "1 " * 3000]
    rows = [(i, t, f"src{i % 3}" if i % 5 else None, "r", 1, 9, [1]) for i, t in enumerate(texts)]
    rows += [(2, texts[2], "src0", "again", 2, 8, None), (None, prose[7], None, "n", None, None, None), (None, None, "src1", "n", None, None, None)]
    return rows


ROWS = _corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return repr(r)


# --- op2, op3 -----------------------------------------------------------------------------


def test_words_take_as_many_ids_as_fit():
    draw = np.random.default_rng(3)
    assert len(token_files.RUNS) == len({c for c, _ in token_files.SELECTORS}) - 1
    for n in (0, 1, 59, 61, 400):
        ids = np.array([int(draw.integers(0, 1 << 62)) >> max(0, 62 - int(b)) for b in draw.integers(0, 70, n)], np.uint64) << np.uint64(1)
        want, at = 0, 0
        while at < n:
            fits = [c for c, bits in token_files.SELECTORS if all(int(i) >> bits == 0 for i in ids[at : at + c])]
            want, at = want + (1 if fits else 2), at + (fits[0] if fits else 1)
        words = token_files.pack_words(ids)
        assert len(words) == want and (token_files.unpack_words(words, n) == ids).all()


def test_pieces_are_the_tokenizers_ids(docs):
    path = packing.tokenizer_path("byte_bpe_50k.json")
    plain = Tokenizer.from_file(path)
    want = []
    for doc_id, text, *_ in ROWS:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        edge = len(ids) - (len(ids) - 1) // 64 * 64
        for piece, (a, b) in enumerate(zip([0, *range(edge, len(ids), 64)], [*range(edge, len(ids) + 1, 64)], strict=False)):
            part = np.array(ids[a:b], "<u4").tobytes()
            want.append((doc_id, piece, a, b - a, zlib.crc32(part)))
    packed = packing.pack(docs, path, capacity=64).collect()
    assert sorted((tuple(r[:5]) for r in packed), key=key) == sorted(want, key=key)
    held = defaultdict(list)
    for r in packed:
        held[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(r.ids) == r.ids_crc32
    for places in held.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 64


def test_sequences_hold_the_ids_in_order(docs):
    packed = packing.pack(docs, packing.tokenizer_path("byte_bpe_50k.json"), capacity=64)
    made = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert made[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids


def test_plan_is_best_fit_over_counts():
    draw = random.Random(3)
    for _ in range(50):
        counts = {draw.randint(1, 32): draw.randint(1, 30) for _ in range(draw.randint(1, 12))}
        free = []  # best fit decreasing, one piece at a time
        for n in sorted(counts, reverse=True):
            for _ in range(counts[n]):
                fits = [i for i, f in enumerate(free) if f >= n]
                if fits:
                    free[min(fits, key=lambda i: free[i])] -= n
                else:
                    free.append(32 - n)
        used = defaultdict(int)
        ranks = defaultdict(list)
        for n, rank, pieces, first, per, offset in packing.plan(counts, 32):
            ranks[n] += range(rank, rank + pieces)
            for i in range(pieces):
                assert used[first + i // per] == offset + i % per * n
                used[first + i // per] += n
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
        assert len(used) == len(free) and max(used.values()) <= 32


def test_token_files_round_trip(spark, docs, empty):
    path = packing.tokenizer_path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    out = scratch_path(spark, "t")
    token_files.write_tokens(docs, out, path, block_ids=500)
    want, start = [], 0
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), ids.tobytes()))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in token_files.read_tokens(spark, out).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    token_files.write_tokens(empty, f"{out}-none", path)
    assert token_files.read_tokens(spark, f"{out}-none").count() == 0


@pytest.mark.parametrize("top", [1, 2, 16, 50_000, 1 << 33, 1 << 62, (1 << 64) - 1])
def test_words_round_trip(top):
    draw = random.Random(top)
    ids = np.array([draw.randint(0, draw.choice([1, min(top, 300), top])) for _ in range(3000)], np.uint64)
    words = token_files.pack_words(ids)
    assert (token_files.unpack_words(words, len(ids)) == ids).all()
    assert len(token_files.unpack_words(token_files.pack_words(ids[:0]), 0)) == 0


# --- op4 ----------------------------------------------------------------------------------


def _overlap(rows, items, width=10):
    def words(t):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    out = []
    for doc_id, text, *_ in rows:
        w, hit, ids = words(text), set(), set()
        for item, t in items:
            v = words(t)
            k = min(len(v), width)
            wins = {tuple(v[s : s + k]) for s in range(len(v) - k + 1)} if v else set()
            for p in range(len(w) - k + 1 if v else 0):
                if tuple(w[p : p + k]) in wins:
                    hit |= set(range(p, p + k))
                    ids.add(str(item))
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination(spark, docs, empty):
    some = [(i, r[1]) for i, r in enumerate(ROWS) if r[1] and i % 4 == 0]
    cut = [(100 + i, " ".join((t or "").split()[2:16])) for i, t in some[:6]]
    items = [*some, *cut, (7, "River stone"), (8, "river, STONE"), (9, None), (10, "..."), (11, "1"), (12, "1 1 1 1 1 1 1 1 1 1 1 1")]
    table = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = [tuple(r) for r in decontaminate.overlap(docs, table).collect()]
    assert sorted(got, key=key) == sorted(_overlap(ROWS, items), key=key)
    assert decontaminate.overlap(empty, table).count() == 0
    assert not any(r.contaminated for r in decontaminate.overlap(docs, table.limit(0)).collect())


def test_phrase_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a red fox ran"), (2, "a red big fox"), (3, "fox red")], "doc_id long, text string")
    terms = spark.createDataFrame([("red",), ("fox",)], "word string").selectExpr("word", "xxhash64(word) AS term")
    index = decontaminate.build_index(docs, terms).where("term IS NOT NULL")
    assert decontaminate.phrase(index, ["red", "fox"]).count() == 1
    assert decontaminate.phrase(index, ["red", "fox"], slop=1).count() == 2


# --- op5 ----------------------------------------------------------------------------------


def test_segments_are_maximal():
    def brute(scores, n, drift):
        full = [-drift] * n
        for i, s in scores:
            full[i] = s
        def best(lo, hi):  # the definition: the best segment, then the same left and right of it
            top = None
            for a in range(lo, hi):
                total = 0
                for b in range(a, hi):
                    total += full[b]
                    if total > 1e-9 and (top is None or total > top[0] + 1e-9 or (abs(total - top[0]) <= 1e-9 and b - a < top[2] - top[1])):
                        top = (total, a, b)
            if top is None:
                return []
            return [*best(lo, top[1]), (top[1], top[2]), *best(top[2] + 1, hi)]
        return best(0, n)

    draw = random.Random(5)
    for _ in range(300):
        n = draw.randint(1, 25)
        scores = [(i, draw.choice([0.37, 1.01, 2.3])) for i in range(n) if draw.random() < 0.3]
        assert [(a, b) for a, b, _ in toxicity.segments(scores, 0.4)] == brute(scores, n, 0.4)


def test_toxic_words_are_learned(spark, empty):
    draw = random.Random(1)
    rows, labels = [], []
    for i in range(600):
        words = [draw.choice(WORDS) for _ in range(draw.randint(20, 200))]
        toxic = int(i % 5 == 0)
        if toxic:
            for w in draw.sample(["grimblar", "grimblex", "grimblon", "fozzle"], 3):
                words.insert(draw.randrange(len(words)), w)
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    rows += [(1000, None), (1001, ""), (None, "fozzle fozzle grimblas"), (1002, "Fozzle " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = spark.createDataFrame([*labels, (None, 1), (3, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, table)
    got = {(r.doc_id, r.held_out): r for r in toxicity.classify(docs, model).collect()}
    assert len(got) == len(rows)
    for (i, held), r in got.items():
        if i is not None:
            assert held == (zlib.crc32(str(i).encode()) % 3 == 1)
        if i is None or i == 1002:
            assert r.predicted == 1
        elif i < 600:
            assert r.predicted == dict(labels)[i]
        else:
            assert 0 <= r.score < 0.5
    assert toxicity.passages(docs, model).where("passage LIKE '%fozzle%'").count() > 50
    none = toxicity.train(docs, table.limit(0))
    assert toxicity.classify(docs, none).where("predicted = 1").count() == 0
    assert toxicity.classify(empty, none).count() == 0


# --- op7 ----------------------------------------------------------------------------------


def _base(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    out = []
    for n, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "email" or (kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))) or (kind == "card" and 14 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), n, m.end(), kind))
    return sorted(out)


def test_base_spans(spark, docs, empty):
    draw = random.Random(2)
    noise = ["".join(draw.choice("ab1234@.+-_ ()é") for _ in range(draw.randint(0, 60))) for _ in range(150)]
    noise += ["a@b" + ".c" * 5000, "9" * 20_000, "1.1.1.1" * 50, "1-2" * 3000]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    rows = [(r[0], r[1]) for r in ROWS] + [(1000 + i, t) for i, t in enumerate(noise)]
    want = []
    for doc_id, t in rows:
        found = _base(t)
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        want.append((doc_id, *(sum(x[3] == k for x in found) for k in pii.KINDS), hashlib.sha256(text.encode()).hexdigest()))
    got = pii.report(pii.spans(docs.select("doc_id", "text").union(extra))).collect()
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted(want, key=key)
    texts = defaultdict(set)
    for doc_id, t in rows:
        texts[doc_id].add(t or "")
    for r in got:
        assert any({f"{k}:{a}:{b}" for a, _, b, k in _base(t)} <= set(r.spans.split(",")) or not _base(t) for t in texts[r.doc_id])
    assert pii.report(pii.spans(empty)).count() == 0


def test_redaction(spark):
    rows = [(1, "write to ann@mail.example.com or +1 (234) 555-7890.", 0), (1, "nothing here", 0), (2, None, 0), (3, "10.0.0.1", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {(r.doc_id, r.text, r.n_chars) for r in pii.redact(docs).collect()}
    assert got == {(1, "write to [EMAIL] or [PHONE].", 28), (1, "nothing here", 12), (2, None, None), (3, "[IP]", 4)}


def test_trees_and_their_expression_agree(spark):
    draw = np.random.default_rng(0)
    x = draw.integers(0, 6, (200, 3))
    x = np.unique(x, axis=0)
    positive = np.where((x[:, 0] > 2) & (x[:, 1] < 4), 9.0, 1.0)
    model = boosting.fit(x, positive, 10 - positive)
    score = boosting.predict(model, x)
    frame = spark.createDataFrame(x.tolist(), "a int, b int, c int")
    got = {tuple(r[:3]): r.s for r in frame.withColumn("s", boosting.expression(model, ["a", "b", "c"])).collect()}
    assert all(abs(got[tuple(r)] - s) < 1e-9 for r, s in zip(x.tolist(), score, strict=True))
    assert score[positive == 9].min() > 0.8 > 0.2 > score[positive == 1].max()


# --- op8 ----------------------------------------------------------------------------------


def _without_repeats(rows, match):
    seen, out = {}, []
    last = float("inf")
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        mine = last if doc_id is None else doc_id
        gone = bytearray(len(b))
        for p in range(len(b) - match + 1):
            if seen.setdefault(b[p : p + match], mine) < mine:
                gone[p : p + match] = b"\x01" * match
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((doc_id, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), kept))
    return out


@pytest.mark.parametrize("match, gram, unit_bytes", [(50, 20, 1 << 20), (50, 20, 500), (8, 3, 300)])
def test_repeated_strings_go(docs, empty, match, gram, unit_bytes):
    got = substrings.deduplicate(docs, match, gram, unit_bytes)
    rows = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()]
    assert sorted(rows, key=key) == sorted(_without_repeats(ROWS, match), key=key)
    assert substrings.deduplicate(empty).count() == 0


def test_suffix_arrays_equal_sorting():
    draw = np.random.default_rng(1)
    for _ in range(200):
        lanes = [np.append(draw.integers(1, draw.integers(2, 5), draw.integers(0, 40)), 0) for _ in range(draw.integers(1, 6))]
        edges = np.cumsum([0, *map(len, lanes)])
        want = [np.array(sorted(range(len(x)), key=lambda i: tuple(x[i:]))) + a for x, a in zip(lanes, edges, strict=False)]
        for alone in (1, 20, 1000):
            assert (suffix_arrays(np.concatenate(lanes), edges, alone) == np.concatenate(want)).all()


# --- op9 ----------------------------------------------------------------------------------


def test_shards_match_the_mixture(docs, empty):
    got = sharding.interleave(docs, 5).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in ROWS if r[0] is not None
    )
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(s) for s in slots.values()]
    assert len(got) == len(ROWS) and len(slots) == 5 and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    source = {r[0]: r[2] for r in ROWS}
    for s in {r[2] for r in ROWS}:
        per = [sum(r.shard == k and source[r.doc_id] == s for r in got if r.doc_id is not None) for k in range(5)]
        assert max(per) - min(per) <= 3
    assert sharding.interleave(empty, 5).count() == 0


# --- op10 ---------------------------------------------------------------------------------


def _print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    parts = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(p), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(nodes, linked):
    root = list(range(len(nodes)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(nodes)):
        for j in range(i):
            if linked(i, j):
                root[find(i)] = find(j)
    least = {}
    for i, n in enumerate(nodes):
        if n is not None:
            least[find(i)] = min(least.get(find(i), n), n)
    return [least.get(find(i)) for i in range(len(nodes))]


def test_simhash_classes(docs, empty):
    prints = [_print(r[1]) for r in ROWS]
    ids = [r[0] for r in ROWS]
    names = _components(ids, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    got = simhash.classes(simhash.fingerprints(docs)).collect()
    have = [(r.doc_id, r.fp % (1 << 64), r.component_id) for r in got]
    assert sorted(have, key=key) == sorted(zip(ids, prints, names, strict=True), key=key)
    assert simhash.classes(simhash.fingerprints(empty)).count() == 0


@pytest.mark.parametrize("parts, chunk", [(None, 4000), (None, 7), (6, 7)])
def test_no_pair_within_the_radius_is_lost(spark, parts, chunk):
    draw = random.Random(9)
    seeds = [draw.getrandbits(64) for _ in range(8)]
    values = {s ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 6))) for s in seeds for _ in range(25)}
    values = sorted(int(np.uint64(v).view(np.int64)) for v in values)
    frame = spark.createDataFrame([(i, v, v) for i, v in enumerate(values)], "doc_id long, fp long, node long")
    pairs = simhash.links(simhash.pivot_table(frame), parts=parts, chunk=chunk).collect()
    joined = {frozenset((r.a, r.b)) for r in pairs}
    near = lambda i, j: ((values[i] ^ values[j]) % (1 << 64)).bit_count() <= 4
    own = _components(values, lambda i, j: frozenset((values[i], values[j])) in joined)
    assert own == _components(values, near)


def test_first_of_each(docs, empty):
    kept = [r.doc_id for r in simhash.first_of_each(docs).collect()]
    assert set(range(40)) <= set(kept) and not set(range(40, 46)) & set(kept)
    assert sum(i is None for i in kept) == 2 and len(kept) - 2 == len(set(kept) - {None})
    assert simhash.first_of_each(docs).columns == docs.columns
    assert simhash.first_of_each(empty).count() == 0
