"""The classifiers on held-out rows, without labels, and on odd documents."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.cases import all_null, no_documents, odd_documents
from tillstream.llm import labels, quality_classifier, toxicity
from tillstream.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_folds(spark):
    rows = spark.range(-5, 200).select(F.col("id").alias("doc_id"), labels.held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_labels_that_may_be_learnt(spark):
    given = spark.createDataFrame(
        [(i, i % 2) for i in range(50)] + [(1, 0), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int"
    )
    got = {r["doc_id"]: r["label"] for r in labels.learnable(given, "toxic").collect()}
    assert not any(zlib.crc32(str(i).encode()) % 5 == 0 for i in got)
    assert all(got[i] == (1 if i == 2 else i % 2) for i in got)


def accuracy(scored, given, column):
    rows = scored.join(given, "doc_id").where("held_out").select("predicted", column).collect()
    assert len(rows) > 30
    return sum(r[0] == r[1] for r in rows) / len(rows)


def test_toxicity_held_out(spark):
    given = table(spark, FOLDER, "labels")
    scored = toxicity.toxicity(table(spark, FOLDER, "documents"), given)
    assert accuracy(scored, given, "toxic") >= 0.95


def test_quality_held_out(spark):
    given = table(spark, FOLDER, "labels")
    scored = quality_classifier.quality_scores(
        table(spark, FOLDER, "documents"), given, F.col("source"), F.col("lang")
    )
    assert accuracy(scored, given, "quality") >= 0.95


def test_held_out_labels_change_nothing(spark):
    docs, given = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    turned = given.withColumn("toxic", F.when(labels.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, given).collect()}
    two = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, turned).collect()}
    assert all(abs(one[i] - two[i]) < 1e-9 for i in one)


def test_sites_are_shrunk(spark):
    """A bad site pulls its doubtful pages down; a page alone on a site is judged as all are."""
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(600):
        bad = i % 3 == 0
        text = " ".join(rng.choices(["aa", "bb", "cc", "dd"], k=60)) + (" $$$" * 20 if bad else "")
        rows.append((i, text, "bad" if bad else "good", "p"))
        marks.append((i, int(not bad)))
    rows += [(1000, " ".join(["aa bb cc dd"] * 15), "bad", "p"), (1001, " ".join(["aa bb cc dd"] * 15), "alone", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, host string, path string")
    given = spark.createDataFrame(marks, "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_classifier.quality_scores(docs, given, F.col("host"), F.col("path")).collect()}
    assert got[1000]["path_rate"] < 0.2 < 0.5 < got[1001]["path_rate"] < 0.8
    assert got[1000]["doc_score"] == pytest.approx(got[1001]["doc_score"])
    assert got[1000]["score"] < got[1001]["score"]


def test_site_of_an_address(spark):
    urls = ["https://www.A.example.com/en/25#top", "http://u:p@b.org:80?x=1", "nonsense", None]
    host, path = quality_classifier.site(F.col("u"))
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(host, path).collect()
    assert [tuple(r) for r in rows] == [("a.example.com", "en"), ("b.org", ""), ("", ""), (None, None)]


def test_correlated_voters_are_discounted():
    import numpy as np

    pairs = np.array([[100.0, 99.0, 0.0], [99.0, 100.0, 0.0], [0.0, 0.0, 100.0]])
    spoken, inside = np.array([50.0, 50.0, 50.0]), np.array([49.0, 49.0, 49.0])
    model = toxicity._model(1000.0, 100.0, spoken, inside, pairs)
    assert model.speaks[0] == pytest.approx(model.speaks[2] / 1.99, rel=0.01)


@pytest.mark.parametrize("with_labels", [True, False])
def test_odd_documents(spark, with_labels):
    docs, rows = odd_documents(spark)
    given = spark.createDataFrame(
        [(i, i % 2, i % 2) for i in range(60)] if with_labels else [], "doc_id long, quality int, toxic int"
    )
    for scored in (
        toxicity.toxicity(docs, given),
        quality_classifier.quality_scores(docs, given, F.col("source"), F.col("lang")),
    ):
        got = scored.collect()
        assert len(got) == len(rows)
        assert all(0 <= r["score"] <= 1 for r in got)


def test_empty_and_null(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for docs, n in ((no_documents(spark), 0), (all_null(spark), 2)):
        assert toxicity.toxicity(docs, none).count() == n
        assert quality_classifier.quality_scores(docs, none, F.col("source"), F.col("lang")).count() == n
