"""Terms are mined from all labels, not from the sample that the classifier is fitted on."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstream.llm import toxicity


def marked(n, terms):
    """Clean documents, and toxic ones that show one of the terms each."""
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(60)]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        shown = rng.sample(words, 12) + ([terms[i // 4 % len(terms)]] if toxic else [])
        rows.append((i, " ".join(shown), int(toxic)))
    return rows


def test_terms_beyond_the_sample(spark):
    terms = [f"zq{a}{b}" for a in "ijklm" for b in "rstuv"]
    rows = marked(2_000, terms)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    given = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = toxicity.toxicity(docs, given, sample_rows=200).collect()
    wanted = {r[0]: r[2] for r in rows}
    assert sum(r["predicted"] == wanted[r["doc_id"]] for r in got) >= 0.98 * len(got)


def test_all_terms_count_and_chance_ones_do_not(spark):
    terms = [f"zq{a}{b}" for a in "ijklm" for b in "rstuv"]
    rows = marked(2_000, terms)
    rows += [(5_000 + i, f"once{i} twice{i % 20}", 1) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(6)
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    candidates, totals = toxicity.candidate_terms(docs, known)
    shown = toxicity.with_shown(docs, candidates).select("doc_id", F.explode("shown").alias("hash"))
    mined = {r["term"]: r for r in toxicity.marking_terms(shown, candidates, known, totals).collect()}
    assert set(terms) <= set(mined)
    assert not any(t.startswith("twice") and t[5:].isdigit() for t in mined)
    # Counts, strengths and the test again, over all documents and terms.
    n_toxic = sum(r[2] for r in rows)
    n_clean = len(rows) - n_toxic
    counts = Counter((t, r[2]) for r in rows for t in toxicity._terms_in(r[1]))
    tested = {t for t, label in counts if label}
    assert (totals.toxic, totals.clean, totals.tested) == (n_toxic, n_clean, len(tested))
    usual = (n_toxic + 0.5) / (len(rows) + 1)
    for term in tested:
        a, b = counts[term, 1], counts[term, 0]
        evidence = a * math.log(a / (a + b) / usual) + (b * math.log(b / (a + b) / (1 - usual)) if b else 0)
        telling = a >= 0.8 * (a + b) and evidence >= math.log(len(tested))
        assert telling == (term in mined), term
        if telling:
            assert (mined[term]["toxic"], mined[term]["clean"]) == (a, b)
            odds = math.log((a + 0.5) / (n_toxic + 1)) - math.log((b + 0.5) / (n_clean + 1))
            assert math.isclose(mined[term]["strength"], odds)


@pytest.mark.parametrize("bits", [64, 1 << 12])
def test_results_do_not_depend_on_the_filters(spark, monkeypatch, bits):
    terms = [f"zq{a}{b}" for a in "ijk" for b in "rst"]
    rows = marked(600, terms)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    given = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    want = sorted(map(tuple, toxicity.toxicity(docs, given).collect()))
    monkeypatch.setattr(toxicity, "FILTER_BITS", bits)
    got = sorted(map(tuple, toxicity.toxicity(docs, given).collect()))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-6) for g, w in zip(got, want))


def test_label_model_and_scores_by_hand(spark):
    """The sums of one round, and the score of each row, without Spark."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        toxic = i % 5 == 0
        votes = sorted(v for v in range(toxicity.VOTERS + 5) if rng.random() < (0.3 if toxic else 0.02))
        rows.append((i, votes, float(toxic), None if i % 3 == 0 else int(toxic)))
    table = spark.createDataFrame(rows, "doc_id long, votes array<int>, strength double, label int").repartition(4)
    got = toxicity.fit_label_model(table, rounds=1)
    votes = toxicity.vote_matrix([r[1] for r in rows])
    z = math.log(0.05 / 0.95) + votes.sum(axis=1) * math.log(0.1 / 0.005)
    trust = math.log(toxicity.TRUST / (1 - toxicity.TRUST))
    z += [0 if r[3] is None else trust if r[3] else -trust for r in rows]
    p = 1 / (1 + np.exp(-z))
    p1 = (p @ votes + 0.5) / (p.sum() + 1)
    p0 = (votes.sum(axis=0) - p @ votes + 0.05) / (300 - p.sum() + 1)
    pairs = votes.T @ votes
    spread = np.sqrt(np.maximum(np.diag(pairs), 1e-9))
    correlation = np.abs(pairs / np.outer(spread, spread)) - np.eye(len(pairs)) * (np.diag(pairs) > 0)
    discount = 1 / (1 + np.where(correlation > 0.1, correlation, 0).sum(axis=1))
    assert np.allclose(got.speaks, discount * np.log(p1 / p0))
    assert np.allclose(got.silent, discount * np.log((1 - p1) / (1 - p0)))
    assert math.isclose(got.prior, math.log((p.sum() + 1) / (302 - p.sum() - 1)))
    weights = np.array(toxicity.fit_classifier(table, got))
    scores = toxicity.sigmoid(toxicity.design([r[1] for r in rows], np.array([r[2] for r in rows])) @ weights[:-1] + weights[-1])
    assert all((s >= 0.5) == (r[2] > 0) for s, r in zip(scores, rows))


def test_sample_of_repeated_ids(spark):
    rows = [(i % 40, [i % 3], float(i), 1 if i % 2 else None) for i in range(400)] + [(None, [1], 0.0, None)]
    table = spark.createDataFrame(rows, "doc_id long, votes array<int>, strength double, label int").repartition(5)
    one, two = (sorted(map(tuple, toxicity.sample_of(t, 20).collect())) for t in (table, table.repartition(3)))
    assert one == two and len(one) == 20 == len({r[0] for r in one})
    assert sum(r[3] is None for r in one) == 10
