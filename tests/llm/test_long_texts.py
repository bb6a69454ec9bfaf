"""Texts of tens of thousands of words, each as a whole."""

import pytest
from pyspark.sql import functions as F

from sensorloom.llm import linedup, mixing, neardup, tokens, toxicity


def changed(text, every):
    return " ".join(w if i % every else "other" for i, w in enumerate(text.split()))


def test_near_duplicates(documents, prose):
    long = prose(30_000, 1)
    rows = [(1, long), (2, changed(long, 400)), (3, changed(long, 11)), (4, long + " " + prose(60_000, 2)), (5, long), (6, prose(30_000, 3))]
    got = {r.doc_id: (r.class_id, r.kept) for r in neardup.near_duplicates(documents(rows))[0].collect()}
    assert got == {1: (1, True), 2: (1, False), 3: (3, True), 4: (4, True), 5: (1, False), 6: (6, True)}


def test_mixing(documents, prose):
    rows = [(1, prose(40_000, 1), "a"), (2, prose(10, 2), "a"), (3, prose(20_000, 3), "b"), (4, None, "b")]
    got = {r.doc_id: r for r in mixing.mix_sources(documents(rows)).collect()}
    assert [got[i]["size"] for i in range(1, 5)] == [40_000, 10, 20_000, 0]
    for ids, source in (((1, 2), "a"), ((3, 4), "b")):
        assert sum(got[i].taken for i in ids) == pytest.approx(got[ids[0]].target, abs=1)
        assert all(got[i].taken <= 3 * got[i]["size"] for i in ids)


def test_lines_of_a_long_text(documents, prose):
    lines = [prose(12, i) for i in range(4000)]
    out = linedup.drop_repeated_lines(documents([(1, "\n".join(lines)), (2, "\n".join(lines[:2000] + [prose(12, 9000 + i) for i in range(2000)]))]))
    got = {r.doc_id: len(r.text.split("\n")) for r in out.collect()}
    assert got == {1: 4000, 2: 2000}


def test_passages_of_a_long_text(spark, documents, prose):
    bad = "awful nasty vile wicked rotten"
    rows = [(i, f"{prose(60, i)} {bad if i % 2 else ''} {prose(20, 300 + i)}") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id bigint, toxic int")
    docs = documents(rows)
    model = toxicity.fit(docs, labels)
    long = documents([(500, f"{prose(30_000, 7)} {bad} {bad} {prose(10, 8)}"), (501, prose(30_000, 9))])
    got = {r.doc_id: r for r in toxicity.score(long, model).collect()}
    assert got[500].score > got[501].score and len(got[500].passages) >= 1


def test_tokens(documents, prose):
    pieces = tokens.vocabulary()
    long = prose(50_000, 5)
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(documents([(1, long), (2, long + " " + long), (3, "x" * 100_000)]), pieces).collect()}
    assert got[2] == 2 * got[1] and 0 < got[3] <= 100_001
    assert tokens.count_tokens(documents([(1, long)]), pieces).filter(F.col("n_tokens") > 50_000).count() == 1
