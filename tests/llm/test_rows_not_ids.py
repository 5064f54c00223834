"""Stages of the pipeline judge rows, not ids, whatever the other columns are called."""

import corpus_pipeline
from concord.llm import nearcopies

SCHEMA = "doc_id long, text string, _row string, __row long, _id int, row int"


def test_decontamination_by_row(spark, sf_dir):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(1, f"so {item} there", "a", 1, 1, 1), (1, "a clean text", "b", 2, 2, 2), (None, item, "c", 3, 3, 3), (None, "clean too", "d", 4, 4, 4), (2, None, "e", 5, 5, 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.benchmark_out(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted(r["_row"] for r in kept.collect()) == ["b", "d", "e"]


def test_near_copies_by_row(spark):
    words = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"other{i}" for i in range(40))
    rows = [(None, words, "a", 1, 1, 1), (3, words + " end", "b", 2, 2, 2), (3, other, "c", 3, 3, 3), (None, "alone " + other[:90], "d", 4, 4, 4), (1, other, "e", 5, 5, 5), (None, words, "f", 6, 6, 6)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = nearcopies.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["_row"] for r in kept.collect()) == ["b", "d", "e"]
    assert nearcopies.first_of_each(docs.where("false")).count() == 0


def test_redaction_beside_columns_of_its_own_names(spark):
    from concord.llm import pii

    rows = [(1, "write to a.b@example.org now", 7, "x", [1]), (None, "a.b@example.org", 8, "y", None), (1, "nothing", 9, "z", None), (2, None, 1, "n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long, _DIGEST string, _edits array<int>")
    out = pii.redact(docs)
    assert out.columns == docs.columns
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[2]) == sorted(
        [(1, "write to [EMAIL] now", 7, "x", [1]), (None, "[EMAIL]", 8, "y", None), (1, "nothing", 9, "z", None), (2, None, 1, "n", None)], key=lambda r: r[2]
    )
