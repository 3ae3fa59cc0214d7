"""Secrets, personal data and licenses against plain versions, and cases of the methods."""

import base64
import random

import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tests.llm.cases import all_null, no_documents, odd_documents
from tillstream.llm import licenses, pii, secrets
from tillstream.llm.common import table

SMALL = "/root/testdata/sf0.001"


def by_id(rows):
    return sorted(rows, key=repr)


def inputs(spark):
    odd, rows = odd_documents(spark)
    given = table(spark, SMALL, "documents")
    return [(odd, [(r[0], r[1]) for r in rows]), (given, [tuple(r) for r in given.select("doc_id", "text").collect()])]


def kinds_only(spans, kinds):
    return ",".join(s for s in spans.split(",") if s.split(":")[0] in kinds)


def test_secrets_base(spark):
    for docs, rows in inputs(spark):
        got = secrets.secrets(docs).collect()
        want = []
        for number, text in rows:
            spans = plain.secret_base(text or "")
            counts = [sum(s.startswith(k) for s in spans) for k in ("assign", "access", "hex")]
            want.append((number, *counts, plain.digest(",".join(spans))))
        assert by_id([tuple(r)[:5] for r in got]) == by_id(want)
        for r in got:
            assert plain.digest(kinds_only(r["spans"], secrets.BASE_KINDS)) == r["base_sha256"]


def test_random_tokens_are_found_and_words_are_not(spark):
    rng = random.Random(1)
    tokens = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(20)]
    words = "the quick brown fox jumps over a lazy dog and runs into the long-forgotten-forest-of-oak".split()
    rows = [
        (i, " ".join(rng.choices(words, k=200)) + f" key {t} " + " ".join(rng.choices(words, k=50)))
        for i, t in enumerate(tokens)
    ]
    rows += [(100 + i, " ".join(rng.choices(words, k=300)) + " antidisestablishmentarianism/path/to/SomeFileName") for i in range(50)]
    got = secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in got if r["n_random"]}
    assert len(found & set(range(20))) >= 18
    assert not found - set(range(20))


def test_step_up_rule_needs_more_evidence_of_more_tokens():
    few = secrets.levels_needed({(0, 40): 1, (0, 0): 9}, 0.01)
    many = secrets.levels_needed({(0, 40): 1, (0, 0): 10**9}, 0.01)
    assert few[0] <= 40 < many[0]
    assert secrets.levels_needed({}, 0.01) == {}


def test_personal_data_base(spark):
    for docs, rows in inputs(spark):
        got = pii.personal_data(docs).collect()
        want = []
        for number, text in rows:
            spans = plain.pii_base(text or "")
            counts = [sum(s.startswith(k + ":") for s in spans) for k in pii.BASE]
            want.append((number, *counts, plain.digest(",".join(spans))))
        assert by_id([tuple(r)[:6] for r in got]) == by_id(want)
        for r in got:
            assert plain.digest(kinds_only(r["spans"], pii.BASE)) == r["base_sha256"]


def test_masking_leaves_all_else(spark):
    docs, rows = odd_documents(spark)
    masked = pii.masked_documents(docs)
    assert masked.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in masked.collect()}
    for row in rows:
        number, text = row[0], row[1]
        if text is None:
            assert got[number]["text"] is None
        elif not pii_spans(spark, docs).get(number):
            assert got[number]["text"] == text
        else:
            assert not plain.pii_base(got[number]["text"])
        assert number is None or got[number]["n_chars"] == (None if text is None else len(got[number]["text"]))
    text = "Write to ab@cd.org or +1 (654) 555-4136 now"
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.masked_documents(one).first()["text"] == "Write to <EMAIL> or <PHONE> now"


def test_names_in_any_letters_and_columns_of_any_name(spark):
    text = "Dr. Müller and Anna Martin, phone (654) 555-4136 now"
    docs = spark.createDataFrame([(1, text, "t", "r", 0)], "doc_id long, text string, __text string, __row string, __base int")
    masked = pii.masked_documents(docs)
    assert masked.dtypes == docs.dtypes
    assert tuple(masked.first()) == (1, "<PERSON> and <PERSON>, phone <LOCAL_PHONE> now", "t", "r", 0)


def test_running_sums_and_cuts(spark):
    rng = random.Random(4)
    lists = [[rng.randrange(9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 1_000, 5_000)]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, x array<int>")
    before = pii._before(F.col("x"), lambda a, b: a + b)
    most = pii._before(F.col("x"), lambda a, b: F.greatest(a, b))
    for i, sums, largest in rows.select("i", before, most).collect():
        assert sums == [sum(lists[i][:k]) for k in range(len(lists[i]))]
        assert largest == [max([0, *lists[i][:k]]) for k in range(len(lists[i]))]
    text = "".join(rng.choice("aé日👍\n ") for _ in range(300))
    cuts = [sorted(rng.choices([*range(301), 64, 128], k=2)) for _ in range(200)]
    rows = spark.createDataFrame([(text, a, b) for a, b in cuts], "t string, a int, b int")
    got = rows.select("a", "b", pii._cut(pii._chunks(F.col("t")), F.col("a"), F.col("b"))).collect()
    assert all(r[2] == text[r[0] : r[1]] for r in got)


def test_spans_apart_from_others(spark):
    rng = random.Random(9)

    def some(n):
        return [(a, a + rng.randrange(1, 6)) for a in (rng.randrange(4_000) for _ in range(n))]

    pairs = [(some(a), some(b)) for a, b in ((0, 3), (3, 0), (40, 20), (300, 600), (20, 256), (20, 512))]
    kind = "array<struct<start:int,end:int>>"
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], f"i int, s {kind}, o {kind}")
    for i, found in rows.select("i", pii._apart(F.col("s"), F.col("o"))).collect():
        spans, others = pairs[i]
        want = [s for s in spans if not any(s[0] < o[1] and o[0] < s[1] for o in others)]
        assert [tuple(s) for s in found] == want


_FOUND = {}


def pii_spans(spark, docs):
    if not _FOUND:
        _FOUND.update((r["doc_id"], r["spans"]) for r in pii.personal_data(docs).collect())
    return _FOUND


def test_labelers_outvote_a_bad_shape(spark):
    rows = [(i, f"my ssn 123-45-67{i:02d} here") for i in range(30)]
    rows += [(100 + i, f"order 000-00-00{i:02d}/x") for i in range(30)]
    rows += [(200 + i, f"call +1 (654) 555-41{i:02d} please") for i in range(30)]
    got = {r["doc_id"]: r["n_more"] for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == 1 for i in range(30))
    assert all(got[100 + i] == 0 for i in range(30))


def test_licenses_base(spark):
    for docs, rows in inputs(spark):
        got = [tuple(r)[:6] for r in licenses.licenses(docs).collect()]
        assert by_id(got) == by_id([(n, *plain.license_base(t or "")) for n, t in rows])


def plain_labels(text):
    """Every block against every template, without any filter."""
    import re

    low, labels, score = plain.lower(text), set(), 0.0
    for block in re.split(r"\n|(?<=[.!?;])[ \t\n\x0b\f\r]+", low):
        words = set(plain.WORD.findall(block))
        best = None
        for label, template in licenses.TEMPLATES:
            t = set(template.split())
            share = len(t & words) / len(t)
            if len(t & words) >= licenses.THRESHOLD * len(t) - 1e-9:
                best = max(best or (0, 0, ""), (share, len(t), label))
        if best:
            labels.add(best[2])
            score = max(score, best[0])
    base = plain.license_base(text)[4]
    labels |= set(base.split(",")) - {""}
    return ",".join(sorted(labels)), 1.0 if base else score


def test_licenses_join_loses_no_block(spark):
    for docs, rows in inputs(spark):
        got = [(r["doc_id"], r["labels"], round(r["score"], 9)) for r in licenses.licenses(docs).collect()]
        want = [(n, lab, round(s, 9)) for n, t in rows for lab, s in [plain_labels(t or "")]]
        assert by_id(got) == by_id(want)


@pytest.mark.parametrize("scan", [secrets.secrets, pii.personal_data, licenses.licenses])
def test_empty_and_null(spark, scan):
    assert scan(no_documents(spark)).count() == 0
    rows = scan(all_null(spark)).collect()
    assert len(rows) == 2 and rows[0]["doc_id"] is None
