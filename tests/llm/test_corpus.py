"""Counts, rules, packing, joins and near copies against plain versions."""

import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm import plain
from tests.llm.cases import all_null, no_documents, odd_documents
from tillstream.llm import decontamination, packing, quality_rules, simhash, token_counts
from tillstream.llm.common import table
from tillstream.llm.components import components

SMALL = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def by_id(rows):
    return sorted(rows, key=repr)


def inputs(spark):
    odd, rows = odd_documents(spark)
    given = table(spark, SMALL, "documents")
    return [
        (odd, [(r[0], r[1]) for r in rows]),
        (given, [tuple(r) for r in given.select("doc_id", "text").collect()]),
    ]


# Quality rules


def test_quality_base(spark):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    for docs, rows in inputs(spark):
        got = quality_rules.quality(docs, PIECES)
        got = got.select("doc_id", *names, "kept").collect()
        assert by_id([tuple(r)[:7] for r in got]) == by_id([(n, *plain.quality_base(t or "")) for n, t in rows])
        assert not any(r["kept"] and r["base_failed"] for r in got)


def test_bands_keep_prose_and_reject_what_stands_out(spark):
    rng = random.Random(3)
    syllables = "an be co du el fi go hu is ja ki lo mu no or pe qui ro su ti un vo wa xe yi za".split()
    vocabulary = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choices(vocabulary, k=n))

    rows = [(i, prose(rng.randrange(60, 600)), "en") for i in range(600)]
    # Two alternating words with a counter are no repeated windows, but have little entropy.
    poor = " ".join(f"{a}{b}" for a in "xy" for b in "##|#|" for _ in range(20))
    rows += [(1000 + i, " ".join(rng.sample(poor.split(), 200)), "en") for i in range(10)]
    rows += [(2000 + i, "".join(chr(0x12000 + rng.randrange(800)) + " " for _ in range(200)), "en") for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.quality(docs, PIECES).collect()}
    assert sum(got[i]["kept"] for i in range(600)) >= 598
    assert not any(got[i]["kept"] for i in got if i >= 1000)
    assert {r["doc_id"] for r in quality_rules.kept_documents(docs, PIECES).collect()} == {
        i for i, r in got.items() if r["kept"]
    }


def test_pieces_of_words_are_the_models():
    model = quality_rules.Fertility(PIECES)
    for word in ["the", "▁a▁", "ÀéLL", "日本", "\x00", "x" * 300]:
        known = model.known.of({word.encode()})
        ids = np.frombuffer(known[word.encode()], "<u4").tolist()
        assert ids == model.model.encode(word)


def test_scripts():
    assert quality_rules.script_of("Привет x") == "cyrillic"
    assert quality_rules.script_of("日本語") == "han"
    assert quality_rules.script_of("été là") == "latin"
    assert quality_rules.script_of("12 !") == "none"


# Token counts


def test_token_counts(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs, rows in inputs(spark):
        for common in (5, 200_000):
            got = [tuple(r) for r in token_counts.token_counts(docs, PIECES, common=common).collect()]
            want = []
            for number, text in rows:
                n = len(model.encode(text or ""))
                want.append((number, len((text or "").encode()), n, n > 4096))
            assert by_id(got) == by_id(want)


def test_pre_tokens_are_never_joined():
    pieces = token_counts.Pieces(PIECES)
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice("abst'redvml  0!?ÀéLL'''-\n.,,..#$% ▁日—“\t<>x") for _ in range(rng.randrange(1, 60)))
        parts = pieces.split(text)
        assert sum(pieces.count(parts)) == len(pieces.model.encode(text)), text


# Packing


def test_ids_are_the_tokenisers():
    ours, whole = packing.WordIds(WORDS), Tokenizer.from_file(WORDS)
    rng = random.Random(6)
    texts = ["don't you'll I'M o'ΣΑΣ", "a'sb 'S !'s '''ll 12'd", "x<|endoftext|>y", "été İstanbul ǅ", "", None, "ÀÉ'S×÷ ß_a__'re'", "a\x85b\x1cc"]
    texts += ["".join(rng.choice("abst'redvml 0!?ÀéLL'''-\n.,,..日") for _ in range(80)) for _ in range(300)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids


def test_packing(spark):
    whole = Tokenizer.from_file(WORDS)
    for docs, rows in inputs(spark):
        got = packing.pack(docs, WORDS, capacity=256).collect()
        want = []
        for number, text in rows:
            ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
            for piece, start in enumerate(range(0, len(ids), 256)):
                part = ids[start : start + 256]
                want.append((number, piece, start, len(part), zlib.crc32(part.tobytes())))
        assert by_id([tuple(r)[:5] for r in got]) == by_id(want)
        total = sum(w[3] for w in want)
        sequences = {}
        for r in got:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 256
        assert len(sequences) <= -(-total // 256) * 1.02 + 1


@pytest.mark.parametrize("seed", range(4))
def test_bin_completion(seed):
    rng = random.Random(seed)
    counts = Counter(rng.randrange(20, 101) for _ in range(rng.choice([8, 30, 300])))
    plan = packing.bin_completion(counts, 100)
    packed = Counter()
    for filling in plan:
        assert sum(filling.lengths) <= 100 and filling.bins > 0
        for n in filling.lengths:
            packed[n] += filling.bins
    assert packed == counts
    assert sum(f.bins for f in plan) <= sum(f.bins for f in packing.best_fit(packing.Left(counts), 100))


def test_bin_completion_beats_best_fit():
    # Best fit puts 6 with 4 and strands the rest; three bins of ten do.
    counts = {6: 1, 5: 2, 4: 1, 3: 2, 2: 2}
    assert sum(f.bins for f in packing.bin_completion(counts, 10)) == 3
    counts = {44: 1, 24: 2, 22: 1, 21: 1, 17: 2, 8: 2, 6: 2}
    best = sum(f.bins for f in packing.best_fit(packing.Left(counts), 61))
    assert sum(f.bins for f in packing.bin_completion(counts, 61)) <= best


def test_one_length_may_hold_all_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 10)
    docs = spark.createDataFrame([(i, "same text") for i in range(200)], "doc_id long, text string")
    got = packing.pack(docs, WORDS, capacity=16).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 200


# Decontamination


def items(spark, rows):
    benchmark = [tuple(r) for r in table(spark, SMALL, "benchmark").collect()]
    words = " ".join(t for _, t in rows if t).split()
    extra = [(900, " ".join(words[100:140])), (901, "the of"), (902, ""), (903, None), (904, "the of"),
             (None, "Released under the MIT License"), (905, "Password TOKEN")]
    return benchmark + extra


def test_contamination(spark):
    for docs, rows in inputs(spark):
        bench = items(spark, rows)
        benchmark = spark.createDataFrame(bench, "item_id long, text string")
        want = by_id(
            (n, *plain.contamination(t or "", [(i if i is not None else "null", x) for i, x in bench]))
            for n, t in rows
        )
        for block in (decontamination.BLOCK_WINDOWS, 200):
            got = decontamination.contamination(docs, benchmark, block_windows=block)
            assert by_id(tuple(r) for r in got.collect()) == want
        kept = {r[0] for r in decontamination.clean_documents(docs, benchmark).select("doc_id").collect()}
        assert kept == {w[0] for w in want if not w[5]}


def test_no_items(spark):
    docs, rows = odd_documents(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.contamination(docs, none).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] for r in got)


# Near copies


def test_blocks_outlast_any_three_bytes():
    assert len(simhash.BLOCKS) == 14
    for spoilt in combinations(range(8), 3):
        assert any(not set(spoilt) & set(b) for b in simhash.BLOCKS)


def test_near_duplicates(spark):
    for docs, rows in inputs(spark):
        got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
        assert by_id(got) == by_id(plain.near_components(rows))


def test_kept_documents_are_one_of_each(spark):
    for docs, rows in inputs(spark):
        kept = simhash.kept_documents(docs)
        assert kept.dtypes == docs.dtypes
        got = [r["doc_id"] for r in kept.select("doc_id").collect()]
        classes = {c for _, _, c in plain.near_components(rows) if c is not None}
        without = {f for n, f, c in plain.near_components(rows) if c is None}
        assert sorted(x for x in got if x is not None) == sorted(classes)
        assert sum(x is None for x in got) <= len(without)


def test_chains_and_large_groups_of_prints(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 16)
    rng = random.Random(8)
    prints, value = set(), rng.getrandbits(64)
    for _ in range(300):
        prints.add(value)
        for _ in range(rng.randrange(1, 4)):
            value ^= 1 << rng.randrange(64)
    prints |= {rng.getrandbits(64) for _ in range(100)}
    base = rng.getrandbits(64)
    prints |= {base ^ (i << 5) for i in range(256)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.near_links(frame)).collect()}
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= 3:
            parent[root(a)] = root(b)
    ours, theirs = {}, {}
    for p, s in zip(prints, signed):
        ours.setdefault(got.get(s, s), set()).add(p)
        theirs.setdefault(root(p), set()).add(p)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = " ".join(str(i * i) for i in range(5_000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "COUNTED", 77)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: quality_rules.quality(d, PIECES),
        lambda d: quality_rules.kept_documents(d, PIECES),
        lambda d: token_counts.token_counts(d, PIECES),
        lambda d: packing.pack(d, WORDS),
        simhash.near_duplicates,
        simhash.kept_documents,
    ],
)
def test_empty_and_null(spark, operator):
    assert operator(no_documents(spark)).count() == 0
    operator(all_null(spark)).collect()
