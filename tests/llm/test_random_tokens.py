"""Random tokens of one case, of digits, and at the end of paths."""

import random
import string

import pytest

from tillstream.llm import secrets

WORDS = "the quick brown fox jumps over a lazy dog and runs into the long-forgotten-forest-of-oak".split()
# Ordinary numbers are short; without any, random digits would be what is usual.
WORDS += ["1999", "2000", "10", "500"]


@pytest.mark.parametrize(
    ("alphabet", "before", "kind"),
    [
        (string.ascii_lowercase, "", "random_lower"),
        (string.ascii_uppercase, "", "random_upper"),
        (string.digits, "", "random_digits"),
        (string.ascii_letters + string.digits + "-_", "https/files/", "random_base64url"),
    ],
)
def test_found_among_words(spark, alphabet, before, kind):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choices(WORDS, k=300)) + " antidisestablishmentarianism") for i in range(60)]
    for i in range(20):
        token = "".join(rng.choices(alphabet, k=30)) + ("-_" if "-" in alphabet else "")
        rows.append((100 + i, " ".join(rng.choices(WORDS, k=100)) + f" {before}{token} end"))
    got = secrets.secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"] for r in got if kind in r["spans"]}
    assert len(found) >= 17 and min(found) >= 100
    assert not any(r["n_random"] for r in got if r["doc_id"] < 100)
