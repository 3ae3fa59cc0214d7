"""The pipeline's stages against plain versions, and the registered queries."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import plain
from tests.llm.cases import no_documents, odd_documents
from tillstream.llm import pii, quality_rules
from tillstream.llm.common import table
from tillstream.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    """Each stage keeps and changes what its plain version does, on the rows kept before."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    verdict = {r["doc_id"]: r["kept"] for r in quality_rules.quality(docs, public_tokenizers.path("piece_bpe_32k.model")).collect()}
    rows = {r["doc_id"]: r for r in docs.collect()}
    want = {i for i in rows if verdict[i]}
    assert all(not plain.quality_base(rows[i]["text"])[-1] for i in want)

    good = corpus_pipeline.STAGES[0][1](spark, docs, SMALL)
    assert good.columns == columns and {r["doc_id"] for r in good.collect()} == want

    near = plain.near_components([(i, rows[i]["text"]) for i in sorted(want)])
    want = {c for _, _, c in near}
    one = corpus_pipeline.STAGES[1][1](spark, good, SMALL)
    assert one.columns == columns and {r["doc_id"] for r in one.collect()} == want

    items = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    want = {i for i in want if not plain.contamination(rows[i]["text"], items)[-1]}
    clean = corpus_pipeline.STAGES[2][1](spark, one, SMALL)
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == want

    masked = corpus_pipeline.STAGES[3][1](spark, clean, SMALL)
    texts = {r["doc_id"]: r["text"] for r in masked.collect()}
    assert masked.columns == columns and set(texts) == want
    spans = {r["doc_id"]: r["spans"] for r in pii.personal_data(clean).collect()}
    for i in want:
        text, at, out = rows[i]["text"], 0, ""
        found = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans[i].split(",") if s))
        for start, end, kind in found:
            if start >= at:
                out += text[at:start] + f"<{kind.upper()}>"
            at = max(at, end)
        assert texts[i] == out + text[at:]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = corpus_pipeline.run(spark, SMALL).collect()
    pieces = set()
    for i in want:
        ids = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0], "<u4")
        for k, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            pieces.add((i, k, start, len(part), zlib.crc32(part.tobytes())))
    assert {tuple(r)[:5] for r in got} == pieces and len(got) == len(pieces)


def test_odd_documents_pass_through(spark):
    for docs in (odd_documents(spark)[0], no_documents(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
            docs.collect()


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run(spark, name):
    rows = QUERIES[name](spark, SMALL)
    if name == "op13_conversation_repair":
        assert rows.count() == table(spark, SMALL, "conversations").select("conv_id").distinct().count()
        return
    assert "doc_id" in rows.columns
    assert rows.count() >= table(spark, SMALL, "documents").count()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        connection.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    cursor = connection.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall(), key=repr)
    ours = QUERIES[name](spark, SMALL)
    assert sorted(ours.columns) == sorted(names)
    assert sorted(map(tuple, ours.select(*names).collect()), key=repr) == want
