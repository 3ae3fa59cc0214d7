"""Bin completion against the optimum, cut searches, repeated rows and other vocabularies."""

import random
from collections import Counter
from functools import lru_cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer, pre_tokenizers

from tillstream.llm import packing


def least_bins(sizes, capacity):
    """By trying every set of pieces beside the largest that is left."""
    sizes = tuple(sorted(sizes, reverse=True))

    @lru_cache(maxsize=None)
    def least(rest):
        if not rest:
            return 0
        best = len(rest)
        for chosen in range(1 << (len(rest) - 1)):
            beside = [n for i, n in enumerate(rest[1:]) if chosen >> i & 1]
            if rest[0] + sum(beside) <= capacity:
                kept = tuple(n for i, n in enumerate(rest[1:]) if not chosen >> i & 1)
                best = min(best, 1 + least(kept))
        return best

    return least(sizes)


def bins_of(plan):
    return sum(f.bins for f in plan)


@pytest.mark.parametrize("seed", range(60))
def test_small_cases_are_least(seed):
    rng = random.Random(seed)
    low = rng.choice([5, 12, 20])
    sizes = [rng.randrange(low, 62) for _ in range(rng.randrange(1, 11))]
    sizes += rng.choices(sizes, k=min(2, 11 - len(sizes)))
    plan, proven = packing.search_plan(Counter(sizes), 61)
    assert Counter(n for f in plan for n in f.lengths * f.bins) == Counter(sizes)
    assert proven and bins_of(plan) == least_bins(sizes, 61)


def test_a_cut_search_goes_on_with_best_fit(monkeypatch):
    """A node that runs out of steps has a child, and nothing is called proven."""
    rng = random.Random(3)
    counts = Counter(rng.randrange(100, 300) for _ in range(400))
    monkeypatch.setattr(packing, "STEPS", 3)
    left = packing.Left(counts)
    ways, known = packing.fillings(left, 1000, 1000)
    assert ways and not known
    plan, proven = packing.search_plan(counts, 1000, 200)
    bound = -(-left.total() // 1000)
    assert Counter({n: c for n, c in counts.items()}) == sum(
        (Counter({n: k * f.bins for n, k in Counter(f.lengths).items()}) for f in plan), Counter()
    )
    assert proven == (bins_of(plan) == bound)
    assert bins_of(plan) <= bins_of(packing.best_fit(packing.Left(counts), 1000))


def test_rows_alike_in_all_columns_are_dealt_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "NUMBERED", 10)
    docs = spark.createDataFrame([(None, None)] * 300, "doc_id long, text string").repartition(7)
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack(docs, path, capacity=16).collect()
    assert len(got) == 300
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 300
    assert len({r["sequence_id"] for r in got}) == -(-300 // 16)


def test_a_vocabulary_that_cuts_otherwise_gets_texts_whole(tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.WordIds(path).alike
    other = Tokenizer.from_file(path)
    other.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    file = str(tmp_path / "other.json")
    other.save(file)
    ids = packing.WordIds(file)
    assert not ids.alike
    texts = ["It's 3.14, we'll see.", "", "two words"]
    whole = [Tokenizer.from_file(file).encode(t, add_special_tokens=False).ids for t in texts]
    assert [list(memoryview(e).cast("I")) for e in ids.encode(texts)] == whole
