"""The evidence of random tokens: never too much on average, and found by encoding and length."""

import math
import random

import numpy as np
import pytest

from tillstream.llm import secrets
from tests.llm.test_random_tokens import WORDS


@pytest.mark.parametrize("length", [16, 40])
def test_mean_ratio_of_ordinary_tokens_is_at_most_one(length):
    """Tokens drawn by the transitions, which here are near even, so that ratios spread little."""
    rng = np.random.default_rng(4)
    table = rng.uniform(0.9, 1.1, (secrets._SIZE, secrets._SIZE - 1))
    table /= table.sum(axis=1, keepdims=True)
    total, draws = 0.0, 4000
    for _ in range(draws):
        symbol, token = secrets._SIZE - 1, []
        for _ in range(length):
            symbol = rng.choice(secrets._SIZE - 1, p=table[symbol])
            token.append(secrets._SYMBOLS[symbol])
        # Paths are parted at slashes in candidates(); the whole token is the stricter case.
        token = "".join(token).replace("/", "_")
        for found in secrets.candidates(token, table * 1e9):
            total += math.exp(found["level"] * secrets.STEP) if found["level"] else 0.0
    assert total / draws <= 1


def test_p_value_is_the_smallest_of_three_and_never_infinite():
    assert secrets.log_p((0.0, 0.0, 0.0)) == 0.0
    assert secrets.log_p((1.0, -3.0, 0.5)) == pytest.approx(math.log(3 * 0.0026997961))
    far, farther = secrets.log_p((0.0, 30.0, 0.0)), secrets.log_p((0.0, 3e4, 0.0))
    assert -460 < far < -440 and math.isfinite(farther) and farther < far
    # The two forms of the tail meet.
    near = [secrets.log_p((z, 0.0, 0.0)) for z in (28.28, 28.29)]
    assert near[0] > near[1] > near[0] - 0.5


def test_all_tested_tokens_are_counted():
    """Also those that fail the battery: they are at the lowest level, not left out."""
    usual = np.full((secrets._SIZE, secrets._SIZE - 1), 1e6)
    found = secrets.candidates("a" * 40 + " " + "ab" * 20, usual)
    assert [t["level"] for t in found] == [0, 0]


def test_a_token_does_not_make_itself_usual():
    token = "q7Zr2XvK9mWp4TbN"
    alone = np.ones((secrets._SIZE, secrets._SIZE - 1))
    code = secrets._CODE[np.frombuffer(token.encode(), np.uint8)]
    with_it = alone.copy()
    np.add.at(with_it, (np.concatenate(([secrets._SIZE - 1], code[:-1])), code), 1)
    want = secrets.ordinary_log(token, alone + 0, alone.sum(axis=1) + 1e-9)
    got = secrets.ordinary_log(token, with_it, with_it.sum(axis=1))
    assert got == pytest.approx(-len(token) * math.log(secrets._SIZE - 1))
    assert want >= got


def test_recall_by_encoding_and_length(spark):
    """Eight tokens of each encoding and length among prose, and prose without any."""
    rng = random.Random(11)
    rows, planted = [], {}
    for i in range(300):
        rows.append((i, " ".join(rng.choices(WORDS, k=200)) + " uncharacteristically"))
    number = 1000
    for name, alphabet in secrets.ENCODINGS:
        if name in ("mixed", "base64"):  # parted at slashes, or cut short by them
            continue
        for length in (20, 32, 64):
            for _ in range(8):
                token = "".join(rng.choices(alphabet, k=length))
                rows.append((number, " ".join(rng.choices(WORDS, k=100)) + f" {token} end"))
                planted[number] = (name, length)
                number += 1
    got = secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = {r["doc_id"]: r["n_random"] + r["n_hex"] for r in got}
    assert not any(spans[i] for i in range(300))
    share = {}
    for i, key in planted.items():
        share.setdefault(key, []).append(spans[i] > 0)
    print({f"{k[0]} {k[1]}": sum(v) for k, v in share.items()})
    for (name, length), hits in share.items():
        assert sum(hits) >= (7 if length >= 32 else 5), (name, length)
