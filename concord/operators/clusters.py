"""Name clusters of groups of any size, without comparing all pairs.

The rule is that of :func:`concord.functions.fuzzy.heaviest_leader`: spellings are visited in order, and
one that matches no earlier leader becomes a leader. Here the matches are found by a
set-similarity join and the leaders by peeling the graph of matches, so a group is never ordered
in one task and its number of leaders does not matter.

Which pairs can match is bounded by the score itself. With ``r = 1 - threshold / 100``, the token-set ratio of
spellings without a subset relation reaches the threshold only if

* the shared tokens make up all but a share ``2r / (1 + r)`` of one of them. So of its rarest tokens with more
  letters than that, one is shared; or
* two texts of lengths ``m`` and ``n``, which are the spellings with their tokens in some order, are within
  ``r (m + n)`` insertions and deletions. A deletion takes away two pairs of neighbouring letters and an
  insertion one, blanks at the ends included, so at least ``(m + n) / 2 + 1 - 1.5 r (m + n)`` pairs are in common;
  pairs of neighbouring letters do not depend on the order of the tokens. So the rarest pairs of both
  meet, as many as are left when all but one of the common ones are taken away.

Subsets share all tokens of the smaller one and fall under the first case.

Numbered names of one word (``Customer#000000001``) have the same few pairs of letters, so the second case would
compare nearly all of them. A text of one token shares no token with any but its supersets, so its score is the plain
ratio of the joined tokens: texts of lengths ``m`` and ``n`` match exactly if both come down to one string by so many
deletions that the ratio allows for these lengths. Where these are few (``MOST_CUTS`` strings), such texts meet in
the strings their deletions leave, of which a string of given length has few sources, and all that meet match.
A million numbered names have over a hundred million such matches, nearly all of them between followers, so they are never
listed: leaders are kept by the strings their deletions leave, and a text is looked up there.

A cluster of very many spellings would make as many matches as it has pairs. So the first ``HEADS`` spellings of a
group are decided at once and their leaders take all their followers before matches are looked for; what
remains of a group has, as a rule, small clusters only.

Staged names are many times larger in memory than on disk (a file of numbered names is a hundredth of its rows), so joins
of two sides that grow with the spellings are told to shuffle: by the size of its files one side would be broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from concord.functions.fuzzy import NAME_THRESHOLD, leader_index, leaders_of
from concord.functions.similarity import FULL_SCORE, token_set_ratio
from concord.session import stage

#: Spellings of a group that are decided before the similarity join.
HEADS = 64
#: Matches (16 bytes each) and spellings of a group that one task decides at once, about; more are decided in rounds.
IN_ONE_TASK = 500_000
NODES_IN_ONE_TASK = 200_000
#: Strings by which one task keeps leaders (some 200 bytes each); beyond it, the round ends early.
MOST_KEPT = 1_000_000
#: Spellings that one task looks up among the leaders of a round.
TRIED_IN_ONE_TASK = 20_000
#: Two to this power of neighbouring ids are counted together to tell how far a round goes.
BLOCK_BITS = 6
#: Below this threshold the bound on common pairs of letters says nothing.
LEAST_THRESHOLD = 67.0
#: Strings that deletions may leave of one text, for texts of one other length.
MOST_CUTS = 200
SLACK = 1e-6  # for the floating point of the score


_LIST = T.ArrayType(T.StringType())
_PARTS = T.StructType([T.StructField("tokens", _LIST), T.StructField("grams", _LIST), T.StructField("size", T.IntegerType())])


@F.pandas_udf(_PARTS)
def _parts(texts: pd.Series) -> pd.DataFrame:
    """Distinct tokens, pairs of neighbouring letters (numbered if repeated) and length of the joined tokens."""
    tokens, grams, sizes = [], [], []
    for text in texts:
        words = sorted(set(text.split()))
        joined = " ".join(words)
        seen: Counter[str] = Counter()
        pairs = []
        for a, b in zip(f" {joined}", f"{joined} ", strict=True):
            pairs.append(f"{a}{b}{seen[a + b]}")
            seen[a + b] += 1
        tokens.append(words)
        grams.append(pairs if words else [])
        sizes.append(len(joined))
    return pd.DataFrame({"tokens": tokens, "grams": grams, "size": sizes})


def _matches(threshold: float):
    @F.pandas_udf(T.BooleanType())
    def matches(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([token_set_ratio(x, y) >= threshold for x, y in zip(a, b, strict=True)], dtype=bool)

    return matches


def spellings(df: DataFrame, group: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Distinct spellings: ``g`` (the group), ``text, votes`` and ``id``, which rises with their order in the group."""
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(F.struct(*group).alias("g"), F.col(value).alias("text"))
        .agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct(*order)).alias("seen"))
    )
    place = ("g", "seen", "text")
    ordered = stage(counted, "spelling-counts").repartitionByRange(*place).sortWithinPartitions(*place)
    return stage(ordered.withColumn("id", F.monotonically_increasing_id()).drop("seen"), "spellings")


def by_rarity(items: DataFrame) -> DataFrame:
    """``g, id, listed``: the items (``g, id, item, letters``) of each spelling from the rarest of its group on."""
    held = items.groupBy("g", "item").agg(F.count(F.lit(1)).alias("held"))
    rated = items.join(held, ["g", "item"])
    return rated.groupBy("g", "id").agg(F.sort_array(F.collect_list(F.struct("held", "item", "letters"))).alias("listed"))


def _first(listed: Column, n: Column) -> Column:
    return F.transform(F.slice(listed, 1, n), lambda x: x["item"])


@lru_cache(maxsize=100_000)
def allowed_cuts(size: int, other: int, threshold: float) -> int | None:
    """Deletions from a text of length ``size`` that leave enough in common with one of length ``other``;
    None if no text of that length can match."""
    total = size + other
    common = next((k for k in range(int(total * threshold / 200), min(size, other) + 1) if FULL_SCORE * 2 * k / total >= threshold), None)
    return None if common is None else size - common


@lru_cache(maxsize=100_000)
def by_cuts(size: int, other: int, threshold: float) -> bool | None:
    """Whether texts of these lengths are matched by the strings their deletions leave; None if none match."""
    own, its = allowed_cuts(size, other, threshold), allowed_cuts(other, size, threshold)
    return None if own is None else comb(size, own) <= MOST_CUTS and comb(other, its) <= MOST_CUTS


def strings_left(text: str, deletions: int) -> set[str]:
    if deletions == 1:
        return {text[:i] + text[i + 1 :] for i in range(len(text))}
    return {"".join(kept) for kept in combinations(text, len(text) - deletions)}


_CUTS = T.ArrayType(
    T.StructType([T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType()), T.StructField("left", T.StringType())])
)


def _cuts(threshold: float):
    @F.pandas_udf(_CUTS)
    def cuts(texts: pd.Series, others: pd.Series) -> pd.Series:
        found = []
        for text, lengths in zip(texts, others, strict=True):
            size, own, left = len(text), [], {}
            for other in lengths:
                if by_cuts(size, other, threshold):
                    n = allowed_cuts(size, other, threshold)
                    if n not in left:
                        left[n] = strings_left(text, n)
                    own += [(min(size, other), max(size, other), kept) for kept in left[n]]
            found.append(own)
        return pd.Series(found)

    return cuts


def _needs_grams(threshold: float):
    @F.pandas_udf(T.BooleanType())
    def needs(sizes: pd.Series, others: pd.Series) -> pd.Series:
        kinds = {(s, n): by_cuts(s, n, threshold) is False for s, lengths in zip(sizes, others, strict=True) for n in lengths}
        return pd.Series([any(kinds[s, n] for n in lengths) for s, lengths in zip(sizes, others, strict=True)], dtype=bool)

    return needs


def with_partners(nodes: DataFrame) -> DataFrame:
    """``nodes`` with ``single`` (one token) and ``others``: the lengths in the group of texts that make a pair with
    a text of one token (any for such a text, those of one token for the rest). ``gid`` is the group's smallest id.

    The lengths are staged and joined, not the result: what comes out of a join is never broadcast by its estimated size.
    """
    single = F.size("tokens") == 1
    sizes = nodes.groupBy(F.col("g").alias("of")).agg(
        F.collect_set("size").alias("sizes"), F.collect_set(F.when(single, F.col("size"))).alias("singles"), F.min("id").alias("gid")
    )
    met = nodes.withColumn("single", single).join(stage(sizes, "cluster-sizes"), F.col("g").eqNullSafe(F.col("of")))
    return met.withColumn("others", F.when(F.col("single"), F.col("sizes")).otherwise(F.col("singles"))).drop("of", "sizes", "singles")


def matched_by_cuts(partners: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``g, a, b, a_text, b_text`` that match, one of them of one token (some twice)."""
    cuts = partners.withColumn("cut", F.explode(_cuts(threshold)(F.array_join("tokens", " "), "others")))
    left = cuts.select("g", "cut.*", "id", "text", "size", "single")
    names = ("id", "text", "size", "single")
    right = left.select("g", "low", "high", "left", *[F.col(c).alias(f"b_{c}") for c in names])
    fit = (F.col("low") == F.col("high")) | (F.col("size") != F.col("b_size"))
    met = left.join(right, ["g", "low", "high", "left"]).filter((F.col("id") < F.col("b_id")) & fit & (F.col("single") | F.col("b_single")))
    return met.select("g", F.col("id").alias("a"), F.col("b_id").alias("b"), F.col("text").alias("a_text"), "b_text")


def candidates(nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``g, a, b, a_text, b_text`` that may match, all of those that do among them (some twice)."""
    partners = with_partners(nodes)
    return compared(partners, threshold).unionByName(matched_by_cuts(partners, threshold))


def compared(partners: DataFrame, threshold: float) -> DataFrame:
    """The candidates that are to be scored: what :func:`matched_by_cuts` does not decide."""
    r = 1 - threshold / 100
    base = partners.select("g", "id", "text", "tokens", "grams", "size")

    # shared tokens: one of the first tokens of a is a token of b
    listed = by_rarity(base.select("g", "id", F.explode("tokens").alias("item")).withColumn("letters", F.length("item")))
    most = F.col("size") * (2 * r / (1 + r)) + SLACK
    upto = F.transform("listed", lambda x, i: F.aggregate(F.slice("listed", F.lit(1), i + 1), F.lit(0), lambda s, y: s + y["letters"] + 1))
    needed = F.least(F.size("listed"), F.size(F.filter(upto, lambda s: s <= most)) + 1)
    heads = listed.join(base.select("id", "text", "size"), "id").withColumn("head", _first(F.col("listed"), needed))
    asked = heads.select("g", F.col("id").alias("a"), F.col("text").alias("a_text"), "head", F.explode("head").alias("item"))
    given = base.select("g", F.col("id").alias("b"), F.col("text").alias("b_text"), "tokens", F.explode("tokens").alias("item"))
    met = asked.join(given, ["g", "item"]).filter("a <> b AND filter(head, x -> array_contains(tokens, x))[0] = item")
    by_token = met.select("g", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *_texts())

    # common pairs of letters: one of the first pairs of both
    open_ = partners.filter(~F.col("single") | _needs_grams(threshold)("size", "others"))
    listed = by_rarity(open_.select("g", "id", F.explode("grams").alias("item")).withColumn("letters", F.lit(2)))
    least = F.ceil(F.col("size") * (2 / (1 + r)) * (0.5 - 1.5 * r) + 1 - SLACK).cast("int")
    heads = listed.join(base.select("id", "text", "size", "grams"), "id")
    heads = heads.withColumn("head", _first(F.col("listed"), F.greatest(F.size("listed") - least + 1, F.lit(1))))
    left = heads.select("g", "id", "text", "size", "grams", "head", F.explode("head").alias("item"))
    right = left.select("g", "item", *[F.col(c).alias(f"b_{c}") for c in ("id", "text", "size", "grams", "head")])
    both = F.col("size") + F.col("b_size")
    close = F.abs(F.col("size") - F.col("b_size")) <= r * both + SLACK
    enough = F.size(F.array_intersect("grams", "b_grams")) >= both * (0.5 - 1.5 * r) + 1 - SLACK
    once = F.expr("filter(head, x -> array_contains(b_head, x))[0] = item")
    pairs = left.join(right, ["g", "item"]).filter((F.col("id") < F.col("b_id")) & close).filter(once).filter(enough)
    by_gram = pairs.select("g", F.col("id").alias("a"), F.col("b_id").alias("b"), F.col("text").alias("a_text"), "b_text")
    return by_token.unionByName(by_gram)


def _texts() -> list[Column]:
    swap = F.col("a") > F.col("b")
    return [
        F.when(swap, F.col("b_text")).otherwise(F.col("a_text")).alias("a_text"),
        F.when(swap, F.col("a_text")).otherwise(F.col("b_text")).alias("b_text"),
    ]


def led_by_heads(nodes: DataFrame, threshold: float, heads: int) -> DataFrame:
    """``nodes`` with ``leader``: the first leader among the group's first ``heads`` spellings that a spelling
    matches (its own id, if it is one), or null."""
    kinds = T.ArrayType(T.IntegerType())

    @F.pandas_udf(kinds)
    def leading(texts: pd.Series) -> pd.Series:
        return pd.Series([leaders_of(list(t), threshold) for t in texts])

    @F.pandas_udf(T.IntegerType())
    def joins(text: pd.Series, leaders: pd.Series) -> pd.Series:
        found = [leader_index(t, known, threshold) for t, known in zip(text, leaders, strict=True)]
        return pd.Series(found, dtype="Int32")

    spot = F.row_number().over(Window.partitionBy("g").orderBy("id"))
    first = nodes.select("g", "id", "text").withColumn("spot", spot).filter(F.col("spot") <= heads)
    listed = first.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("id", "text"))).alias("h"))
    texts = F.transform("h", lambda h: h["text"])
    chosen = listed.withColumn("at", leading(texts)).select("g", F.transform("at", lambda k: F.get("h", k)).alias("leaders"))
    tried = nodes.join(stage(chosen, "cluster-heads"), "g")
    at = joins("text", F.transform("leaders", lambda x: x["text"]))
    return tried.withColumn("leader", F.get("leaders", at)["id"]).drop("leaders")


class _Leaders:
    """Leaders of a group by the strings their deletions leave, added in order; finds the first that a text matches
    where one of the two has one token."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.strings = 0
        self._kept: dict[tuple[int, int, bool], dict[str, int]] = {}

    def _cuts(self, text: str, others: Sequence[int]) -> Iterator[tuple[int, set[str]]]:
        known: dict[int, set[str]] = {}
        for other in others:
            if by_cuts(len(text), other, self.threshold):
                n = allowed_cuts(len(text), other, self.threshold)
                if n not in known:
                    known[n] = strings_left(text, n)
                yield other, known[n]

    def add(self, leader: int, text: str, single: bool, others: Sequence[int]) -> None:
        for other, strings in self._cuts(text, others):
            kept = self._kept.setdefault((len(text), other, single), {})
            before = len(kept)
            for left in strings:
                kept.setdefault(left, leader)
            self.strings += len(kept) - before

    def first(self, text: str, single: bool, others: Sequence[int]) -> int | None:
        kinds = (True, False) if single else (True,)
        met = {n: [kept for one in kinds if (kept := self._kept.get((n, len(text), one)))] for n in others}
        best = None
        for other, strings in self._cuts(text, [n for n in others if met[n]]):
            for kept in met[other]:
                for left in strings & kept.keys():
                    best = kept[left] if best is None else min(best, kept[left])
        return best


def _decided(threshold: float, most_kept: int):
    """The first nodes of a group, visited in order: each is a leader or has an earlier one. Nodes after
    ``most_kept`` strings of leaders are left for the next round."""

    def decide(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        nodes, edges = nodes.sort_values("id"), edges.sort_values(["late", "early"])
        late, early = edges["late"].to_numpy(np.int64), edges["early"].to_numpy(np.int64)
        begin = np.searchsorted(late, nodes["id"].to_numpy(np.int64)).tolist()
        end = np.searchsorted(late, nodes["id"].to_numpy(np.int64), side="right").tolist()
        known, leads, found = _Leaders(threshold), set(), []
        columns = (nodes["g"], nodes["id"], nodes["text"], nodes["single"], nodes["others"], begin, end)
        for g, node, text, single, others, a, b in zip(*columns, strict=True):
            if known.strings > most_kept:
                break
            by_cut = known.first(text, single, others)
            by_edge = next((e for e in early[a:b].tolist() if e in leads), None) if a < b else None
            leader = min((x for x in (by_cut, by_edge) if x is not None), default=node)
            if leader == node:
                leads.add(node)
                known.add(node, text, single, others)
                found.append((g, node, node, text, single, others))
            else:
                found.append((g, node, leader, None, None, None))
        return pd.DataFrame(found, columns=["g", "id", "leader", "text", "single", "others"])

    return decide


def _looked_up(threshold: float):
    """The nodes that match a leader of the round, with the first such."""

    def look_up(nodes: pd.DataFrame, leaders: pd.DataFrame) -> pd.DataFrame:
        known, found = _Leaders(threshold), []
        if len(nodes):
            leaders = leaders.sort_values("id")
            for columns in zip(*(leaders[c] for c in ("id", "text", "single", "others")), strict=True):
                known.add(*columns)
        if known.strings:
            for node, *columns in zip(*(nodes[c] for c in ("id", "text", "single", "others")), strict=True):
                leader = known.first(*columns)
                if leader is not None:
                    found.append((node, leader))
        return pd.DataFrame(found, columns=["id", "leader"])

    return look_up


def decided(
    nodes: DataFrame,
    edges: DataFrame,
    threshold: float,
    in_one_task: int = IN_ONE_TASK,
    nodes_in_one_task: int = NODES_IN_ONE_TASK,
    most_kept: int = MOST_KEPT,
    tried_in_one_task: int = TRIED_IN_ONE_TASK,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """``id, leader`` of all ``nodes`` (``g, id, text, single, others``; ids rise with their order in the group, ``g`` is a long).

    Two nodes match if they are in ``edges`` (``g, early, late``), or if one has one token (``single``) and their deletions
    leave a common string (:func:`matched_by_cuts`). Both are staged. A round decides the first nodes of each group in one task a
    group, as many as have ``in_one_task`` edges among them, about; their leaders then take all their later neighbours, which are
    found in many tasks. So a long chain of decisions takes no rounds of its own.
    """
    waiting, live, led = nodes, edges, None
    left, links = waiting.count(), live.count()
    before = Window.partitionBy("g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    while left:
        held = waiting.select("g", F.shiftright("id", block_bits).alias("block"), F.lit(1).alias("n"), F.lit(0).alias("m"))
        if links:
            held = held.unionAll(live.select("g", F.shiftright("late", block_bits), F.lit(0), F.lit(1)))
        blocks = held.groupBy("g", "block").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        upto = [F.coalesce(F.sum(c).over(before), F.lit(0)) < max(most, 1) for c, most in (("n", nodes_in_one_task), ("m", in_one_task))]
        ends = blocks.withColumn("now", upto[0] & upto[1]).groupBy("g").agg(
            F.max(F.when(F.col("now"), F.col("block"))).alias("last"), F.sum("n").alias("waiting")
        )
        ends = stage(ends, "cluster-ends")
        first = waiting.join(ends, "g").filter(F.shiftright("id", block_bits) <= F.col("last")).select(nodes.columns)
        among = live.join(ends, "g").filter(F.shiftright("late", block_bits) <= F.col("last")).select(edges.columns)
        decide = _decided(threshold, most_kept)
        schema = "g long, id long, leader long, text string, single boolean, others array<int>"
        now = stage(first.groupBy("g").cogroup(among.groupBy("g")).applyInPandas(decide, schema), "cluster-decided")
        led = now.select("id", "leader") if led is None else led.unionAll(now.select("id", "leader"))
        gone = now.groupBy("g").agg(F.max("id").alias("upto"), F.count(F.lit(1)).alias("done"))
        parts = F.ceil((F.col("waiting") - F.col("done")) / tried_in_one_task).cast("int")
        gone = stage(gone.join(ends, "g").filter("waiting > done").select("g", "upto", parts.alias("parts")), "cluster-ends")
        if not gone.count():
            break
        rest = waiting.join(gone, "g").filter("id > upto").select(*nodes.columns, "parts")
        leaders = now.filter("leader = id")

        tried = rest.filter(F.size("others") > 0).select(*nodes.columns, F.pmod(F.xxhash64("id"), "parts").alias("part"))
        each = gone.select(F.col("g").alias("of"), F.explode(F.sequence(F.lit(1), "parts")).alias("nth")).withColumn("part", F.col("nth").cast("long") - 1)
        leading = leaders.filter(F.size("others") > 0).join(each, F.col("g") == F.col("of")).select(*nodes.columns, "part")
        met = tried.groupBy("g", "part").cogroup(leading.groupBy("g", "part"))
        later = met.applyInPandas(_looked_up(threshold), "id long, leader long")
        if links:
            open_ = live.join(gone, "g").filter("late > upto").select(edges.columns)
            by_edge = open_.join(leaders.select(F.col("id").alias("early")).hint("merge"), "early")
            later = later.unionAll(by_edge.select(F.col("late").alias("id"), F.col("early").alias("leader")))
        later = stage(later.groupBy("id").agg(F.min("leader").alias("leader")), "cluster-followers")
        led = led.unionAll(later)
        ids = later.select("id").hint("merge")
        waiting = stage(rest.select(nodes.columns).join(ids, "id", "left_anti"), "cluster-waiting")
        left = waiting.count()
        if links and left:
            live = live.join(gone, "g").filter("early > upto").select(edges.columns)
            live = live.join(ids.withColumnRenamed("id", "late"), "late", "left_anti")
            live = stage(live.join(ids.withColumnRenamed("id", "early"), "early", "left_anti"), "cluster-edges")
            links = live.count()
    return nodes.select("id", F.col("id").alias("leader")) if led is None else led


def peeled(edges: DataFrame, in_one_task: int = IN_ONE_TASK, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``late, leader``: for every node that has an earlier leader, the first of them. ``edges`` (``early, late``)
    is staged; a node that no earlier leader matches is a leader."""
    ends = edges.select(F.explode(F.array("early", "late")).alias("id")).distinct()
    others = F.array().cast("array<int>").alias("others")
    nodes = ends.select(F.lit(0).cast("long").alias("g"), "id", F.lit("").alias("text"), F.lit(False).alias("single"), others)
    links = edges.select(F.lit(0).cast("long").alias("g"), "early", "late")
    led = decided(stage(nodes, "cluster-waiting"), links, NAME_THRESHOLD, in_one_task, block_bits=block_bits)
    return led.filter("id <> leader").select(F.col("id").alias("late"), "leader")


def fuzzy_wide(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    order: Sequence[str],
    threshold: float = NAME_THRESHOLD,
    heads: int = HEADS,
) -> DataFrame:
    """Leader-clustered vote as column ``chosen`` (and ``sources``).

    Spellings with the same set of tokens score alike against everything, so they are one node. Text without
    a word matches nothing and weighs its votes instead of their square.
    """
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"names cannot be clustered below a threshold of {LEAST_THRESHOLD}")
    known = spellings(df, group, value, order).withColumn("p", _parts("text"))
    worded = F.size("p.tokens") > 0
    alike = F.when(worded, F.to_json("p.tokens")).otherwise(F.concat(F.lit(" "), "text"))
    weight = F.when(worded, F.col("votes") * F.col("votes")).otherwise(F.col("votes"))
    nodes = known.withColumns({"alike": alike, "weight": weight}).groupBy("g", "alike").agg(
        F.min(F.struct("id", "text", "p")).alias("n"), F.sum("weight").alias("weight"), F.sum("votes").alias("votes")
    )
    nodes = stage(nodes.select("g", "n.id", "n.text", "n.p.*", "weight", "votes"), "cluster-nodes")
    headed = stage(led_by_heads(nodes, threshold, heads), "cluster-headed")
    rest = headed.filter(F.col("leader").isNull() & (F.size("tokens") > 0)).drop("leader")
    partners = with_partners(rest).withColumn("g", F.col("gid"))
    near = compared(partners, threshold).filter(_matches(threshold)("a_text", "b_text"))
    edges = stage(near.select("g", F.col("a").alias("early"), F.col("b").alias("late")).distinct(), "cluster-edges")
    waiting = partners.select("g", "id", F.array_join("tokens", " ").alias("text"), "single", "others")
    led = decided(stage(waiting, "cluster-waiting"), edges, threshold).select("id", F.col("leader").alias("later"))
    own = headed.select("g", "id", "text", "weight", "votes", "leader")
    joined = own.join(led.hint("merge"), "id", "left").withColumn("leader", F.coalesce("leader", "later", "id"))
    sums = joined.groupBy("g", "leader").agg(
        F.sum("weight").alias("weight"), F.sum("votes").alias("votes"), F.max(F.when(F.col("id") == F.col("leader"), F.col("text"))).alias("text")
    )
    best = F.min(F.struct((-F.col("weight")).alias("w"), "leader", "text"))
    chosen = sums.groupBy("g").agg(best["text"].alias("chosen"), F.sum("votes").alias("sources"))
    return chosen.select("g.*", "chosen", "sources")
