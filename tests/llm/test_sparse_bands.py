"""Languages of few rows: what is judged by the script, and what is not judged."""

import random

import public_tokenizers

from tillstream.llm import quality_rules

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_a_rare_script_is_not_judged_by_others(spark):
    rng = random.Random(4)
    syllables = "an be co du el fi go hu is ja ki lo mu no or pe qui ro su ti un vo".split()
    latin = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(400)]
    hangul = ["".join(chr(0xAC00 + rng.randrange(11_000)) for _ in range(rng.randrange(2, 4))) for _ in range(400)]
    greek = ["".join(chr(0x3B1 + rng.randrange(17)) for _ in range(rng.randrange(3, 9))) for _ in range(400)]

    def prose(words):
        return " ".join(rng.choices(words, k=rng.randrange(80, 400)))

    rows = [(i, prose(latin), "en") for i in range(400)]
    rows += [(1000 + i, prose(hangul), "ko") for i in range(3)]
    rows += [(1100 + i, prose(greek), None) for i in range(3)]
    # Few rows of a script that has many: clean ones are kept, others still rejected.
    rows += [(2000 + i, prose(latin), "fr") for i in range(20)]
    rows += [(3000, " ".join(chr(0x12000 + rng.randrange(800)) for _ in range(200)), "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in quality_rules.quality(docs, PIECES).collect()}
    assert all(r["kept"] for i, r in got.items() if 1000 <= i < 3000)
    assert not got[3000]["kept"]
    kept = {r["doc_id"] for r in quality_rules.kept_documents(docs, PIECES).collect()}
    assert kept == {i for i, r in got.items() if r["kept"]}


def _letters(first, n, rng, size=400):
    return ["".join(chr(first + rng.randrange(n)) for _ in range(rng.randrange(3, 9))) for _ in range(size)]


def test_junk_of_a_rare_script_is_rejected_and_prose_kept(spark):
    """However many rows of the script there are, and whatever the order of the rows."""
    rng = random.Random(6)
    latin = _letters(97, 26, rng)
    greek = _letters(0x3B1, 17, rng)
    for n in (12, 199, 200):
        rows = [(i, " ".join(rng.choices(latin, k=rng.randrange(80, 400))), "en") for i in range(300)]
        rows += [(1000 + i, " ".join(rng.choices(greek, k=rng.randrange(80, 400))), "el") for i in range(n)]
        # One letter, in words whose windows seldom return: few tokens that hardly vary.
        rows += [(9000, " ".join("\u03b1" * rng.randrange(1, 40) for _ in range(300)), "el")]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        one, two = (
            {r["doc_id"]: r for r in quality_rules.quality(d, PIECES).collect()}
            for d in (docs.repartition(3), docs.repartition(11))
        )
        assert one == two
        assert not one[9000]["base_failed"] and not one[9000]["kept"], n
        assert sum(r["kept"] for i, r in one.items() if 1000 <= i < 9000) >= 0.98 * n


def test_quartiles_by_hand(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.gauss(1, 2), rng.random(), rng.gauss(0, 1)) for _ in range(500)]
    table = spark.createDataFrame(rows, "band string, chars_per_token double, byte_share double, entropy_excess double")
    got = quality_rules._quartiles(table.repartition(7), "", "band")
    for band in "ab":
        for i, m in enumerate(quality_rules.MEASURES, 1):
            values = sorted(round(r[i] * 1000) for r in rows if r[0] == band)
            want = [next(v for k, v in enumerate(values) if (k + 1) / len(values) >= q) for q in (0.25, 0.5, 0.75)]
            assert [round(x * 1000) for x in got[band][m]] == want
