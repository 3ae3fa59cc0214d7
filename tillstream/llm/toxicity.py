"""Toxicity by weak supervision: voters, a label model, and a linear classifier."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillstream.llm.common import Memo, append, durable, emit, found_by_workers
from tillstream.llm.labels import fit_logistic, held_out, learnable, sigmoid

#: Rows that the classifier is fitted on, at most: half labelled, half not.
SAMPLE_ROWS = 40_000
#: Voters made of mined terms; those that begin alike share one.
VOTERS = 24
#: How a term qualifies: share of toxic documents, and terms expected to do so by chance.
LEAST_SHARE, BY_CHANCE = 0.8, 1.0
#: One in so many ids counts clean documents before terms are looked for in all texts.
EARLY = 16
#: Beginnings of words that are terms too.
PREFIXES = (4, 5, 6, 7)
#: Rounds of expectation-maximisation, and how far a learnt label is trusted.
ROUNDS = 5
TRUST = 0.98
#: Distinct terms that a task holds before it hands their counts on.
HELD = 400_000
#: Words of which a worker remembers the terms.
REMEMBERED = 300_000
#: Bits of a filter, whatever is put in. What it lets through is joined, so results do not depend
#: on it.
FILTER_BITS = 1 << 25
#: Spark's seed of XXH64.
SEED = 42

#: Common insults, chosen by hand; terms beside them are mined.
INSULTS = frozenset(
    "idiot idiots moron morons loser losers scum trash stupid pathetic worthless disgusting clown "
    "dumb fool imbecile jerk filth vermin garbage retard freak coward bastard cretin".split()
)
PATTERNS = ["insult", "insult_twice", "insult_to_you", "shouting", "exclaiming"]
_WORD = re.compile(r"[^\W\d_]+")
_TO_YOU = re.compile(r"\b(?:you|your|u)\b\W+(?:\w+\W+){0,2}(?:" + "|".join(sorted(INSULTS)) + r")\b")


def terms_of(word: str) -> list[str]:
    """The word and its beginnings, which are marked with a star."""
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


def patterns_of(text: str, low: str, words: list[str]) -> list[int]:
    """The numbers of the patterns that a text shows."""
    insults = sum(w in INSULTS for w in words)
    letters = sum(map(len, words)) or 1
    upper = len(re.findall("[A-Z]", text))
    shown = (
        insults > 0,
        insults > 1,
        insults > 0 and _TO_YOU.search(low) is not None,
        upper > 0.5 * letters,
        text.count("!") > 0.05 * len(words) + 1,
    )
    return [i for i, s in enumerate(shown) if s]


def bit_filter(hashes: DataFrame) -> np.ndarray:
    """Two bits set for each of the 64-bit ``hash``, in ``FILTER_BITS`` bits."""
    places = F.array(
        F.pmod("hash", F.lit(FILTER_BITS)),
        F.pmod(F.shiftrightunsigned("hash", 32), F.lit(FILTER_BITS)),
    )
    words = (
        hashes.select(F.explode(places).alias("place"))
        .groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def passes(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the unsigned hashes may be among those that a filter was made of."""
    bits = np.uint64(len(words) * 64 - 1)
    found = np.ones(len(hashes), dtype=bool)
    for place in (hashes & bits, (hashes >> np.uint64(32)) & bits):
        found &= (words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found


def _terms_in(text: str | None) -> set[str]:
    words = set(_WORD.findall((text or "").lower()))
    return set(chain.from_iterable(map(terms_of, words)))


def count_terms(labelled: DataFrame) -> DataFrame:
    """``term, toxic, clean``: how many documents of ``text, label`` show each term."""

    def count(parts: Iterator[tuple[list, list]]) -> Iterator[list[pa.Array]]:
        toxic: Counter = Counter()
        clean: Counter = Counter()

        def out() -> list[pa.Array]:
            terms = list(toxic.keys() | clean.keys())
            arrays = [
                pa.array(terms, pa.string()),
                pa.array([toxic[t] for t in terms], pa.int64()),
                pa.array([clean[t] for t in terms], pa.int64()),
            ]
            toxic.clear()
            clean.clear()
            return arrays

        for texts, labels in parts:
            for text, label in zip(texts, labels):
                (toxic if label else clean).update(_terms_in(text))
                if len(toxic) + len(clean) > HELD:
                    yield out()
        yield out()

    schema = StructType(
        [
            StructField("term", StringType()),
            StructField("toxic", LongType()),
            StructField("clean", LongType()),
        ]
    )
    return (
        emit(labelled, ["text", "label"], count, schema)
        .groupBy("term")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )


@dataclass
class Totals:
    """Labelled documents, toxic and clean, and how many terms are tested."""

    toxic: int
    clean: int
    tested: int

    def telling(self) -> Column:
        """Whether a term with ``toxic`` and ``clean`` documents marks toxic ones.

        So many toxic documents among those that show it must be unlikely, by the Chernoff bound,
        were it shown by toxic documents no more than by others; the bound is for the number of
        terms tested. More clean documents can only make a term fail.
        """
        usual = (self.toxic + 0.5) / (self.toxic + self.clean + 1)
        n = F.col("toxic") + F.col("clean")
        evidence = F.col("toxic") * F.log(F.col("toxic") / n / usual) + F.when(
            F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / n / (1 - usual))
        ).otherwise(0.0)
        return (
            (F.col("toxic") >= LEAST_SHARE * n)
            & (F.col("toxic") > usual * n)
            & (evidence >= math.log(max(1, self.tested) / BY_CHANCE))
        )

    def strength(self) -> Column:
        """The log odds that a term adds."""
        return F.log((F.col("toxic") + 0.5) / (self.toxic + 1)) - F.log(
            (F.col("clean") + 0.5) / (self.clean + 1)
        )


def _texts_of(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``doc_id, text, label`` of the documents whose ids are in ``marks``.

    Texts of other ids are left out by a filter before the join, so they are not shuffled.
    """
    words = docs.sparkSession.sparkContext.broadcast(
        bit_filter(marks.select(F.xxhash64("doc_id").alias("hash")))
    )

    rows = docs.where("doc_id is not null").select(
        "doc_id", "text", F.xxhash64("doc_id").alias("hash")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = passes(words.value, batch.column("hash").to_numpy().view(np.uint64))
            yield batch.select(["doc_id", "text"]).filter(pa.array(found))

    found_by_workers(docs)
    schema = StructType([rows.schema["doc_id"], rows.schema["text"]])
    return rows.mapInArrow(run, schema).join(marks, "doc_id")


def candidate_terms(docs: DataFrame, known: DataFrame) -> tuple[DataFrame, Totals]:
    """``hash, term`` of the terms that may mark toxic documents, and the totals.

    They are counted in all toxic documents, and in the clean ones of one in ``EARLY`` ids. That
    count is at most the whole one, so no term is lost that all clean documents would let pass.
    """
    sums = {
        r["label"]: r["n"]
        for r in docs.select("doc_id").join(known, "doc_id").groupBy("label").agg(F.count("*").alias("n")).collect()
    }
    early = F.pmod(F.xxhash64("doc_id"), F.lit(EARLY)) == 0
    marks = known.where((F.col("label") == 1) | early)
    counts = durable(count_terms(_texts_of(docs, marks)).where("toxic > 0"))
    totals = Totals(sums.get(1, 0), sums.get(0, 0), counts.count())
    chosen = counts.where(totals.telling()).select(
        F.xxhash64("term").alias("hash"), "term"
    )
    return durable(chosen), totals


def with_shown(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """``doc_id``, ``shown``: hashes of terms that may be candidates, and ``patterns``."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(candidates))
    memo: list[Memo] = []

    def learn(words: list[str]) -> dict[str, tuple[int, ...]]:
        terms = [terms_of(w) for w in words]
        hashes = np.array(
            [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass"), SEED) for ts in terms for t in ts],
            dtype=np.uint64,
        )
        found = passes(shared.value, hashes)
        signed = hashes.view(np.int64).tolist()
        out, at = {}, 0
        for word, ts in zip(words, terms):
            out[word] = tuple(signed[i] for i in range(at, at + len(ts)) if found[i])
            at += len(ts)
        return out

    def find(texts):
        if not memo:
            memo.append(Memo(learn, REMEMBERED))
        lows = [(t or "").lower() for t in texts]
        words = [_WORD.findall(low) for low in lows]
        distinct = [set(w) for w in words]
        known = memo[0].of(set().union(*distinct))
        shown = [sorted(set(chain.from_iterable(map(known.__getitem__, d)))) for d in distinct]
        patterns = [patterns_of(t or "", low, w) for t, low, w in zip(texts, lows, words)]
        return [pa.array(shown, pa.list_(pa.int64())), pa.array(patterns, pa.list_(pa.int32()))]

    fields = [
        StructField("shown", ArrayType(LongType())),
        StructField("patterns", ArrayType(IntegerType())),
    ]
    return append(docs, ["doc_id"], ["text"], find, fields)


def marking_terms(shown: DataFrame, candidates: DataFrame, known: DataFrame, totals: Totals) -> DataFrame:
    """``hash, term, toxic, clean, strength, voter`` of the terms that mark toxic documents, counted
    in all labelled ones. ``shown`` has a row for each document and candidate."""
    counts = (
        shown.join(known, "doc_id")
        .groupBy("hash")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    )
    voter = F.pmod(F.xxhash64(F.left("term", F.lit(4))), F.lit(VOTERS)).cast("int")
    return (
        counts.join(candidates, "hash")
        .where(totals.telling())
        .select("hash", "term", "toxic", "clean", totals.strength().alias("strength"), voter.alias("voter"))
    )


def with_features(docs: DataFrame, known: DataFrame) -> DataFrame:
    """``doc_id, votes, strength`` for each row: the voters that speak, mined ones before patterns,
    and the sum of the log odds of the terms shown. Texts are read, not shuffled."""
    candidates, totals = candidate_terms(docs, known)
    found = durable(
        with_shown(docs, candidates).withColumn("uid", F.monotonically_increasing_id())
    )
    shown = durable(
        found.select("uid", "doc_id", F.explode("shown").alias("hash")).join(
            candidates.select("hash"), "hash"
        )
    )
    terms = durable(marking_terms(shown, candidates, known, totals))
    spoken = (
        shown.join(terms.select("hash", "strength", "voter"), "hash")
        .groupBy("uid")
        .agg(F.collect_set("voter").alias("mined"), F.sum(F.round("strength", 6).cast("decimal(18,6)")).alias("strength"))
    )
    mined = F.sort_array(F.coalesce("mined", F.array().cast("array<int>")))
    patterns = F.transform("patterns", lambda i: i + VOTERS)
    return found.join(spoken, "uid", "left").select(
        "doc_id",
        F.concat(mined, patterns).alias("votes"),
        F.coalesce(F.col("strength").cast("double"), F.lit(0.0)).alias("strength"),
    )


def vote_matrix(votes: list[list[int]]) -> np.ndarray:
    out = np.zeros((len(votes), VOTERS + len(PATTERNS)))
    for row, numbers in zip(out, votes):
        row[numbers] = 1
    return out


@dataclass
class LabelModel:
    """Log odds of a voter that speaks and of one that does not, and of the share of toxic texts.

    Voters that speak together more than the label explains are discounted by that correlation.
    """

    speaks: np.ndarray
    silent: np.ndarray
    prior: float

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Probability of being toxic; ``labels`` are 0, 1, or NaN where not known."""
        z = self.prior + votes @ self.speaks + (1 - votes) @ self.silent
        trust = np.log(TRUST / (1 - TRUST))
        return sigmoid(z + np.where(np.isnan(labels), 0.0, np.where(labels > 0.5, trust, -trust)))


def _model(total: float, toxic: float, spoken: np.ndarray, in_toxic: np.ndarray, pairs: np.ndarray) -> LabelModel:
    """From the sums over all documents: of posteriors, votes, votes in toxic ones, and of the
    products of votes less what the label explains, for each pair of voters."""
    p1 = (in_toxic + 0.5) / (toxic + 1.0)
    p0 = (spoken - in_toxic + 0.05) / (total - toxic + 1.0)
    p0 = np.minimum(p0, 0.9999)
    p1 = np.minimum(p1, 0.9999)
    spread = np.sqrt(np.maximum(np.diag(pairs), 1e-9))
    correlation = np.abs(pairs / np.outer(spread, spread))
    np.fill_diagonal(correlation, 0.0)
    discount = 1 / (1 + np.where(correlation > 0.1, correlation, 0.0).sum(axis=1))
    share = min(0.999, max(0.001, (toxic + 1) / (total + 2)))
    return LabelModel(
        discount * np.log(p1 / p0),
        discount * np.log((1 - p1) / (1 - p0)),
        float(np.log(share / (1 - share))),
    )


def fit_label_model(rows: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over all rows of ``votes`` and ``label``, which stay where they are.

    A round is one job; a task hands on sums over its rows, about a thousand numbers.
    """
    n = VOTERS + len(PATTERNS)
    context = rows.sparkSession.sparkContext
    # First, voters are held to speak in one toxic document in ten and seldom in others.
    start = np.log(np.full(n, 0.1) / 0.005)
    model = LabelModel(start, np.zeros(n), float(np.log(0.05 / 0.95)))
    means = np.zeros((2, n))
    schema = StructType(
        [StructField("cell", IntegerType()), StructField("value", DoubleType())]
    )
    for _ in range(rounds):
        shared = context.broadcast((model, means))

        def sums(parts, shared=shared):
            model, means = shared.value
            out = np.zeros(2 + 2 * n + n * n)
            for shown, labels in parts:
                votes = vote_matrix(shown)
                known = np.array([np.nan if x is None else x for x in labels], dtype=float)
                p = model.posterior(votes, known)
                rest = votes - np.outer(p, means[1]) - np.outer(1 - p, means[0])
                out[0] += len(votes)
                out[1] += p.sum()
                out[2 : 2 + n] += votes.sum(axis=0)
                out[2 + n : 2 + 2 * n] += p @ votes
                out[2 + 2 * n :] += (rest.T @ rest).ravel()
            cells = np.flatnonzero(out)
            yield [pa.array(cells, pa.int32()), pa.array(out[cells], pa.float64())]

        totals = np.zeros(2 + 2 * n + n * n)
        cells = emit(rows, ["votes", "label"], sums, schema).groupBy("cell").agg(F.sum("value").alias("v"))
        for r in cells.collect():
            totals[r["cell"]] = r["v"]
        total, toxic = totals[:2]
        spoken, in_toxic = totals[2 : 2 + n], totals[2 + n : 2 + 2 * n]
        model = _model(total, toxic, spoken, in_toxic, totals[2 + 2 * n :].reshape(n, n))
        means = np.array(
            [(spoken - in_toxic) / max(1.0, total - toxic), in_toxic / max(1.0, toxic)]
        )
    return model


def sample_of(rows: DataFrame, most: int) -> DataFrame:
    """One row each of at most ``most`` ids, half with a label and half without, the same ones at
    every run: those whose ids hash least. Of rows that share an id the least stands for all."""
    ids = (
        rows.where("doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min(F.struct("votes", "strength", "label")).alias("r"))
        .select("doc_id", "r.*")
    )
    halves = [
        ids.where(condition).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2)
        for condition in ("label is not null", "label is null")
    ]
    return halves[0].unionByName(halves[1])


def design(votes: list[list[int]], strength: np.ndarray) -> np.ndarray:
    """The classifier's features: strength of the mined terms, whether there are any, and votes."""
    return np.hstack([strength[:, None], (strength > 0)[:, None], vote_matrix(votes)])


def fit_classifier(sample: DataFrame, model: LabelModel) -> list[float]:
    """Weights of the features, the intercept last, from the label model's posteriors."""
    rows = sample.select("votes", "strength", "label").collect()
    if not rows:
        return [0.0] * (2 + VOTERS + len(PATTERNS)) + [model.prior]
    votes = [r["votes"] for r in rows]
    labels = np.array([np.nan if r["label"] is None else r["label"] for r in rows], dtype=float)
    posterior = model.posterior(vote_matrix(votes), labels)
    x = design(votes, np.array([r["strength"] for r in rows]))
    # Alike documents, most of which show nothing, are counted together.
    x, group, weight = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    target = np.bincount(group.ravel(), posterior) / weight
    return fit_logistic(x, target, 0.3, weight=weight.astype(float)).tolist()


def toxicity(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, label_column: str = "toxic"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Labels are learnt only from ids that are not held out; neither they nor any column but the
    text is an input of a score. Terms are mined from all labelled rows, and each adds the log odds
    that these show; the label model is fitted over all rows that are not held out, labelled or not,
    the classifier on the posteriors of at most ``sample_rows`` of them, half without a label. A
    NULL or empty text shows no feature and gets the score of the intercept; a very long one counts
    as any other, by the terms it shows at least once. Repeated rows get a row each; a NULL
    ``doc_id`` is carried along and has no label; without labels only the insults and the patterns
    vote; other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    docs = docs.select("doc_id", "text")
    known = durable(learnable(labels, label_column))
    found = durable(with_features(docs, known))
    rows = durable(found.where(~held_out()).join(known, "doc_id", "left"))
    model = fit_label_model(rows)
    weights = fit_classifier(sample_of(rows, sample_rows), model)
    table = F.array(*map(F.lit, weights[2:-1]))
    strength = F.col("strength")
    total = weights[-1] + weights[0] * strength + F.when(strength > 0, weights[1]).otherwise(0.0)
    total = total + F.aggregate("votes", F.lit(0.0), lambda z, i: z + F.get(table, i))
    score = 1 / (1 + F.exp(-total))
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
