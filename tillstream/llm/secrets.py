"""Secrets in texts: fixed patterns, and tokens that look random under a battery of tests."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillstream.llm.common import append, durable, emit, span_text

#: The base patterns, and the least length of the match or of its second group.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16
BASE_KINDS = ["assign", "access", "hex"]

#: A candidate token, and the shortest one that is tested.
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
_PART = re.compile(r"[A-Za-z0-9+_-]{16,}")
#: Encodings from the smallest alphabet on; a token is taken for the first that has its symbols.
ENCODINGS = [
    ("digits", "0123456789"),
    ("hex_lower", "0123456789abcdef"),
    ("hex_upper", "0123456789ABCDEF"),
    ("lower", "abcdefghijklmnopqrstuvwxyz"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum_lower", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("alnum_upper", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("alnum", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
    ("mixed", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"),
]
_SETS = [(name, frozenset(a), np.full(128, -1)) for name, a in ENCODINGS]
for (_, _, _codes), (_, _alphabet) in zip(_SETS, ENCODINGS):
    _codes[[ord(c) for c in _alphabet]] = range(len(_alphabet))
KINDS = [*BASE_KINDS, *(f"random_{name}" for name, _ in ENCODINGS)]

#: Share of false findings that is allowed among the tokens found.
FALSE_SHARE = 0.01
#: Shortest tokens of each length class; each class is controlled by itself.
LENGTHS = [16, 24, 32, 48]
#: Classes of evidence, of a quarter nat each, and their number.
STEP, STEPS = 0.25, 1600

#: Symbols of ordinary text: token characters, and one more for all that parts tokens.
_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
_SIZE = len(_SYMBOLS) + 1
_CODE = np.full(256, -1)
_CODE[[ord(c) for c in _SYMBOLS]] = range(len(_SYMBOLS))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of the fixed patterns' matches, by start, then kind."""
    found = [
        (m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST
    ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= ACCESS_LEAST
        ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def transitions(docs: DataFrame) -> np.ndarray:
    """How often each symbol follows each in the tokens of all texts.

    One row for each pair of symbols comes to the driver. The last symbol stands for all that
    parts tokens; every pair counts once more than it is found.
    """

    def count(parts: Iterator[tuple[list]]) -> Iterator[list[pa.Array]]:
        totals = np.zeros(_SIZE * _SIZE, dtype=np.int64)
        for (texts,) in parts:
            data = "\n".join(t for t in texts if t).encode("utf-8", "surrogatepass")
            code = _CODE[np.frombuffer(data, np.uint8)]
            code[code < 0] = _SIZE - 1
            if len(code) > 1:
                totals += np.bincount(code[:-1] * _SIZE + code[1:], minlength=_SIZE * _SIZE)
        pairs = np.flatnonzero(totals)
        yield [pa.array(pairs, pa.int64()), pa.array(totals[pairs], pa.int64())]

    schema = StructType([StructField("pair", LongType()), StructField("n", LongType())])
    rows = emit(docs, ["text"], count, schema).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.ones(_SIZE * _SIZE)
    for row in rows.collect():
        counts[row["pair"]] += row["n"]
    return counts.reshape(_SIZE, _SIZE)[:, :-1]


def ordinary_log(token: str, usual: np.ndarray, from_symbol: np.ndarray) -> float:
    """Log probability of a token as ordinary text, by the transitions of all but itself.

    ``from_symbol`` are the sums of the rows of ``usual``. A token that its own symbols had made
    usual would be hidden by them in a small corpus.
    """
    code = _CODE[np.frombuffer(token.encode(), np.uint8)]
    before = np.concatenate(([_SIZE - 1], code[:-1]))
    _, place, own = np.unique(before * _SIZE + code, return_inverse=True, return_counts=True)
    own_from = np.bincount(before, minlength=_SIZE)[before]
    # Each pair counts once more than it is found, so what is left is never 0.
    left = np.maximum(usual[before, code] - own[place], 1)
    return float(np.log(left / np.maximum(from_symbol[before] - own_from, left)).sum())


def infer_encoding(token: str) -> int:
    """The first encoding with all symbols of the token; the last one has those of all tokens.

    Words and numbers have one too: it is for the evidence to tell them from random ones.
    """
    symbols = set(token)
    return next(i for i, (_, alphabet, _) in enumerate(_SETS) if symbols <= alphabet)


def tokens_of(text: str) -> Iterator[tuple[int, str]]:
    """Place and token; one that only the mixed encoding has is parted at slashes, as a path is."""
    for match in TOKEN.finditer(text):
        if infer_encoding(match[0]) < len(_SETS) - 1:
            yield match.start(), match[0]
            continue
        for part in _PART.finditer(match[0]):
            yield match.start() + part.start(), part[0]


def battery(token: str, encoding: int) -> tuple[float, float, float]:
    """Standard scores of chi-squared uniformity, runs about the middle, and serial correlation.

    Under randomness each has mean 0 and deviation 1, about; the exact moments of the chi-squared
    statistic of a multinomial are used, so that short tokens are judged fairly.
    """
    code = _SETS[encoding][2][np.frombuffer(token.encode(), np.uint8)].astype(np.float64)
    size, n = len(ENCODINGS[encoding][1]), len(code)
    counts = np.bincount(code.astype(np.int64), minlength=size)
    chi = (counts**2).sum() * size / n - n
    z_chi = (chi - (size - 1)) / math.sqrt(2 * (size - 1) * (n - 1) / n)
    high = code >= size / 2
    ups = int(high.sum())
    downs = n - ups
    if ups and downs:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * ups * downs / n
        deviation = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
        z_runs = (runs - mean) / deviation
    else:
        z_runs = -math.sqrt(n)
    centred = code - code.mean()
    power = float((centred**2).sum())
    serial = float((centred[1:] * centred[:-1]).sum()) / power if power else 1.0
    z_serial = (serial + 1 / n) * math.sqrt(n)
    return z_chi, z_runs, z_serial


def log_p(scores: tuple[float, ...]) -> float:
    """Logarithm of the p-value that all tests give a random token, by Bonferroni, at most 0."""
    x = max(map(abs, scores)) / math.sqrt(2)
    # Far out erfc is 0 in floating point; there its asymptotic form is as good.
    tail = math.log(math.erfc(x)) if x < 20 else -x * x - math.log(x * math.sqrt(math.pi))
    return min(0.0, math.log(len(scores)) + tail)


def candidates(text: str, usual: np.ndarray) -> list[dict]:
    """All tokens that are tested, with the evidence against ordinary text in nats.

    The ratio is how much likelier the token is if its symbols are drawn evenly from its alphabet
    than as ordinary text, by the transitions. As the alphabet goes by the token, ordinary text has
    a mean ratio of up to the number of encodings; divided by that, it is at most 1, whatever the
    length. Times the battery's p-value, which is at most 1, it is still an e-value: a token that
    the tests find less random needs the more evidence, and one that fails them has none.
    """
    found = []
    from_symbol = usual.sum(axis=1)
    for start, token in tokens_of(text):
        encoding = infer_encoding(token)
        ordinary = ordinary_log(token, usual, from_symbol)
        likelier = -len(token) * math.log(len(ENCODINGS[encoding][1])) - ordinary
        evidence = likelier - math.log(len(ENCODINGS)) + log_p(battery(token, encoding))
        level = min(STEPS, max(0, int(evidence / STEP)))
        group = sum(len(token) >= n for n in LENGTHS) - 1
        found.append(
            {
                "start": start,
                "end": start + len(token),
                "encoding": encoding,
                "group": group,
                "level": level,
            }
        )
    return found


def levels_needed(counts: dict[tuple[int, int], int], share: float) -> dict[int, int]:
    """For each length class the least level of evidence that is believed.

    By the step-up rule for e-values: with k of all m tested tokens at a level or above, it is
    believed if its e-value is at least m / (share * k). If ordinary tokens follow the transitions,
    that bounds the expected share of false findings in each class under any dependence, copies of
    a token included. The transitions are estimated, from all texts but the token itself; the other
    secrets in them make a secret look more ordinary, which errs towards finding less.
    """
    needed = {}
    for group in {g for g, _ in counts}:
        levels = sorted(((v, n) for (g, v), n in counts.items() if g == group), reverse=True)
        m = sum(n for _, n in levels)
        k, lowest = 0, STEPS + 1
        for level, n in levels:
            k += n
            if level * STEP >= math.log(m / (share * k)):
                lowest = level
        needed[group] = lowest
    return needed


_SPAN = "array<struct<start:int,kind:int,end:int>>"
_CANDIDATE = "array<struct<start:int,end:int,encoding:int,group:int,level:int>>"


def secrets(docs: DataFrame, share: float = FALSE_SHARE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random`` for each row.

    Spans are in code points, by start, then kind, with the end exclusive. A random token within a
    base span is that span. A NULL text is an empty one, without spans. Repeated rows get the same
    result each; a NULL ``doc_id`` is carried along; other columns are ignored; an empty table
    gives an empty result.

    Two passes over the texts: the transitions of ordinary text, and the candidates. The counts of
    candidates by length class and level of evidence, at most ``4 * 1601`` rows, come to the
    driver.
    """
    usual = docs.sparkSession.sparkContext.broadcast(transitions(docs))

    def search(texts):
        spans, tokens = [], []
        for text in texts:
            base = base_spans(text or "")
            spans.append([{"start": a, "kind": k, "end": b} for a, k, b in base])
            tokens.append(
                [
                    c
                    for c in candidates(text or "", usual.value)
                    if not any(a <= c["start"] and c["end"] <= b for a, _, b in base)
                ]
            )
        kind = pa.struct([(n, pa.int32()) for n in ("start", "kind", "end")])
        token = pa.struct(
            [(n, pa.int32()) for n in ("start", "end", "encoding", "group", "level")]
        )
        return [pa.array(spans, pa.list_(kind)), pa.array(tokens, pa.list_(token))]

    fields = StructType.fromDDL(f"base {_SPAN}, tokens {_CANDIDATE}").fields
    found = durable(append(docs, ["doc_id"], ["text"], search, fields))
    levels = (
        found.select(F.explode("tokens").alias("t")).groupBy("t.group", "t.level").count().collect()
    )
    needed = levels_needed({(r["group"], r["level"]): r["count"] for r in levels}, share)
    least = F.array(*(F.lit(needed.get(g, STEPS + 1)) for g in range(len(LENGTHS))))
    random = F.transform(
        F.filter("tokens", lambda t: t["level"] >= F.get(least, t["group"])),
        lambda t: F.struct(
            t["start"].alias("start"),
            (t["encoding"] + len(BASE_KINDS)).alias("kind"),
            t["end"].alias("end"),
        ),
    )
    kinds = F.array(*map(F.lit, KINDS))

    def text_of(spans):
        named = F.transform(
            spans,
            lambda s: F.struct(
                F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        )
        return span_text(named)

    def count(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.withColumn("random", random).select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)),
        F.sha2(text_of(F.col("base")), 256).alias("base_sha256"),
        text_of(F.array_sort(F.concat("base", "random"))).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )
