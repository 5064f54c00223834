"""Units of the toxicity model are counted by texts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from concord.llm import toxicity
from tests.llm.test_texts import WORDS


def test_a_text_counts_once_for_a_beginning(spark):
    draw = random.Random(4)
    rows = [(" ".join(draw.choice(WORDS) + draw.choice(["", "es", "ing"]) for _ in range(30)), i % 2) for i in range(60)]
    want = Counter()
    for text, toxic in rows:
        words = toxicity._WORD.findall(text.lower())
        want.update({(w[:n], toxic) for w in words for n in (4, 5, 6, 7, len(w)) if n <= len(w)})
    got = toxicity.unit_counts(spark.createDataFrame(rows, "text string, toxic int")).collect()
    assert {r.unit for r in got} == {u for u, _ in want}
    assert all((r.t, r.c) == (want[r.unit, 1], want[r.unit, 0]) for r in got)


def test_the_commonest_beginning_stays_in_the_model(spark):
    draw = random.Random(6)
    rows = []
    for i in range(600):
        words = [draw.choice(WORDS) for _ in range(draw.randint(20, 60))]
        if i % 4 == 0:
            words += [f"grimb{a}{b}" for a in draw.sample("aeiou", 3) for b in draw.sample("lmnrstx", 3)]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert model.units["grimb"][1] == model.toxic and model.units["grimb"][2] == 0
    unseen = spark.createDataFrame([(1, "the river grimbypz grimbyqz grimbyvz of stone")], "doc_id long, text string")
    assert toxicity.classify(unseen, model).first().predicted == 1


def test_the_level_follows_the_number_of_units(spark):
    def level(n):
        return toxicity.level_of(spark.range(n).select(F.when(F.col("id") < 20, 4.0).when(F.col("id") < 40, 3.2).otherwise(0.0).alias("z")))

    assert level(1000) == 3.2 and level(20_000) == 4.0 and level(10**7) > 40
