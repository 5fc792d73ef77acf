"""The pipeline's stages, each against a plain version on what the one before kept."""

from __future__ import annotations

import plain
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import secret_scan, toxicity

from .test_edges import REPEATED


def rows_of(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small.folder}/documents.parquet")
    labels = spark.read.parquet(f"{small.folder}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    before = rows_of(docs)

    mild = stage["toxicity"](spark, docs, small.folder)
    model = toxicity.train(docs, labels)
    wanted = [(i, t) for i, t in before if model.score(toxicity.features(t or "")) < 0.5]
    assert mild.columns == docs.columns
    assert sorted(rows_of(mild)) == sorted(wanted)

    cleaned = stage["line dedup"](spark, mild, small.folder)
    assert cleaned.schema == docs.schema
    plainly = plain.dedup_lines(wanted)
    wanted = [(i, plainly[i][2]) for i, _ in wanted]
    assert sorted(rows_of(cleaned)) == sorted(wanted)
    assert all(r.n_chars == len(r.text) for r in cleaned.collect())

    apart = stage["SimHash near-dedup"](spark, cleaned, small.folder)
    groups = plain.simhash_components(wanted)
    wanted = [(i, t) for i, t in wanted if groups[i] == i]
    assert sorted(rows_of(apart)) == sorted(wanted)

    safe = stage["secret scans"](spark, apart, small.folder)
    assert safe.schema == docs.schema
    masked = dict(rows_of(safe))
    assert set(masked) == {i for i, _ in wanted}
    for doc, text in wanted:
        found = secret_scan.spans_of(text)
        assert (masked[doc] == text) == (not found)
        assert not any(s[0] in ("access", "hex") for s in secret_scan.spans_of(masked[doc]))

    packed = stage["best-fit packing"](spark, safe, small.folder).collect()
    assert {r.doc_id for r in packed} == set(masked)

    final = corpus_pipeline.run(spark, small.folder).collect()
    assert sorted(map(tuple, final)) == sorted(map(tuple, packed))


@pytest.mark.parametrize("rows", [REPEATED, []])
def test_edge_rows_go_through(spark, docs, table, rows):
    labels = spark.createDataFrame([(4, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int")
    folder = table(documents=docs(rows), labels=labels)
    current = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, current, folder)
        assert after.columns == current.columns, name
        current = after
    assert corpus_pipeline.run(spark, folder).count() >= len(current.collect())


def test_one_row_of_each_group_stays(spark, docs):
    a, b = "some words that stand here again and again", "other words of another text that is not near"
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]

    def kept(*rows):
        frame = docs(list(rows), extra=False).drop("source").withColumn("source", F.lit("s"))
        return sorted(rows_of(stage(spark, frame, "")), key=str)

    assert kept((1, a), (None, a), (None, b), (None, b), (None, a)) == [(1, a), (None, b)]
    # an id with two texts: the one that is a near copy of another document goes
    assert kept((5, a), (5, b), (2, a)) == [(2, a), (5, b)]
    assert kept((3, a), (3, a), (3, a), (9, b)) == [(3, a), (9, b)]
    assert kept((4, None), (7, ""), (8, " ")) == [(4, None)]
    assert kept() == []


def test_columns_named_like_those_of_the_keepers(spark, docs):
    a, b = "some words that stand here again and again", "other words of another text that is not near"
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    names = ["keeper", "keeper_row", "copies", "component", "row_key", "first"]
    rows = [(3, a), (1, a), (1, a), (7, b), (None, b)]
    frame = docs(rows, extra=False).select("doc_id", "text", *[F.lit(5).alias(n) for n in names])
    after = stage(spark, frame, "")
    assert after.columns == frame.columns
    assert sorted(map(tuple, after.collect())) == [(1, a, *[5] * 6), (7, b, *[5] * 6)]
