"""Document quality by hierarchical empirical Bayes over sites and paths."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from tillstream.llm.common import append, durable
from tillstream.llm.labels import bounded, fit_logistic, held_out, learnable
from tillstream.llm.quality_rules import base_counts

#: Labelled rows that the document classifier is fitted on, at most.
SAMPLE_ROWS = 20_000
#: What a document without a label counts as evidence about its site, beside one with a label.
SOFT = 0.1
#: Bounds on the number of documents that a prior counts for.
WEAKEST, STRONGEST = 2.0, 10_000.0

FEATURES = [
    "log_words", "chars_per_word", "upper", "digits", "symbols", "marks", "bars", "repeated_lines",
    "repeated_words", "distinct", "spaces", "other_bytes",
]


def site(url: Column) -> tuple[Column, Column]:
    """Host and path of an address: the host without ``www.``, and the first part of the path.

    An address that has none gives empty strings; NULL gives NULLs.
    """
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)", 1)
    return F.regexp_replace(host, r"^www\.", ""), path


def features(text: str | None) -> list[float]:
    """Shares and sizes that tell prose from what is not; all 0 for a text without words."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)
    chars, symbols, lines, repeated = base_counts(data, words)
    n, size = len(words), len(data)

    def share(characters: bytes) -> float:
        return (size - len(data.translate(None, characters))) / size

    return [
        math.log(n),
        chars / n,
        share(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        share(b"0123456789"),
        symbols / size,
        share(b"!?"),
        share(b"|"),
        lines / (1 + data.count(b"\n")),
        repeated / n,
        math.log(len(set(words))) / math.log(n) if n > 1 else 1.0,
        share(b" "),
        share(bytes(range(128, 256))),
    ]


def with_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    def measure(texts):
        return [pa.array([features(t) for t in texts], pa.list_(pa.float64()))]

    return append(docs, keep, ["text"], measure, [StructField("f", ArrayType(DoubleType()))])


@dataclass
class Evidence:
    """The document classifier: weights over scaled features, and the share it was fitted at."""

    weights: list[float]
    intercept: float
    base: float

    def logit(self) -> Column:
        total = F.lit(self.intercept)
        for i, w in enumerate(self.weights):
            total = total + F.lit(w) * F.get("f", F.lit(i))
        return total


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


def fit_evidence(labelled: DataFrame) -> Evidence:
    """From the features and labels of a bounded sample, which comes to the driver."""
    rows = labelled.select("f", "label").collect()
    if len({r["label"] for r in rows}) < 2:
        base = min(0.99, max(0.01, float(rows[0]["label"]))) if rows else 0.5
        return Evidence([0.0] * len(FEATURES), _logit(base), base)
    x = np.array([r["f"] for r in rows])
    y = np.array([float(r["label"]) for r in rows])
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale == 0] = 1.0
    w = fit_logistic((x - mean) / scale, y)
    weights = w[:-1] / scale
    return Evidence(weights.tolist(), float(w[-1] - (weights * mean).sum()), float(y.mean()))


def _strength(groups: DataFrame, rate: Column, centre: Column) -> float:
    """For how many documents a prior counts: few if groups differ more than chance makes them.

    By moments: the mean square distance of the groups' rates from their centre is that of chance,
    ``m (1 - m) / n``, and that of the groups, ``m (1 - m) / (strength + 1)``. One row is read.
    """
    square = F.sum(F.col("n") * F.pow(rate - centre, F.lit(2)))
    chance = F.sum(centre * (1 - centre))
    spread = F.sum(F.col("n") * centre * (1 - centre))
    row = groups.where("n > 0").agg(
        square.alias("square"), chance.alias("chance"), spread.alias("spread")
    ).first()
    between = (row["square"] or 0.0) - (row["chance"] or 0.0)
    if between <= 0:
        return STRONGEST
    return min(STRONGEST, max(WEAKEST, (row["spread"] or 0.0) / between - 1))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    sample_rows: int = SAMPLE_ROWS,
    label_column: str = "quality",
) -> DataFrame:
    """``doc_id, held_out, doc_score, host_rate, path_rate, score, predicted, kept`` for each row.

    ``doc_score`` is the classifier's. The rate of a host is drawn towards the global one, that of
    a path towards its host's, the more so the fewer documents there are; the evidence of the
    document itself is left out of the rates it meets. ``score`` joins the classifier's evidence
    with the path's rate as prior odds; ``predicted`` and ``kept`` go by 0.5.

    Labels are learnt from ids that are not held out. The classifier is fitted on at most
    ``sample_rows`` of them; rates are from all labels and all documents. A NULL host or path is
    one like any other; a text without words has all features 0; repeated rows get a row each;
    without labels every score is near 0.5; an empty table gives an empty result.

    Documents are grouped by host and path before they are shuffled, so a site with a third of all
    rows is a few partial sums; the texts are read once and not shuffled.
    """
    sites = docs.withColumns({"__host": host, "__path": path})
    found = durable(with_features(sites, ["doc_id", "__host", "__path"]))
    known = learnable(labels, label_column)
    sample = found.select("doc_id", "f").join(F.broadcast(bounded(known, sample_rows)), "doc_id")
    evidence = fit_evidence(sample.limit(2 * sample_rows))
    logit = evidence.logit()
    rows = found.join(known, "doc_id", "left").select(
        "doc_id",
        "__host",
        "__path",
        (logit - _logit(min(0.99, max(0.01, evidence.base)))).alias("llr"),
        (1 / (1 + F.exp(-logit))).alias("doc_score"),
        "label",
    )
    weight = F.when(F.col("label").isNull(), F.lit(SOFT)).otherwise(F.lit(1.0))
    rows = durable(
        rows.withColumn("w", weight).withColumn("r", F.coalesce(F.col("label"), F.col("doc_score")))
    )
    paths = durable(
        rows.groupBy("__host", "__path").agg(
            F.sum("w").alias("n"), F.sum(F.col("w") * F.col("r")).alias("s")
        )
    )
    hosts = paths.groupBy("__host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    # A page seen, good or not, before any is: the rate is never 0 or 1.
    overall = ((whole["s"] or 0.0) + 1) / ((whole["n"] or 0.0) + 2)
    k_host = _strength(hosts, F.col("s") / F.col("n"), F.lit(overall))
    host_rate = (F.col("hs") + k_host * overall) / (F.col("hn") + k_host)
    by_host = hosts.select("__host", F.col("n").alias("hn"), F.col("s").alias("hs"))
    joined = paths.join(by_host, paths["__host"].eqNullSafe(by_host["__host"])).drop(
        by_host["__host"]
    )
    k_path = _strength(joined, F.col("s") / F.col("n"), host_rate)
    sites = joined.withColumnRenamed("__host", "__h").withColumnRenamed("__path", "__p")
    own = F.col("w") * F.col("r")
    others_host = (F.col("hs") - own + k_host * overall) / (F.col("hn") - F.col("w") + k_host)
    others_path = (F.col("s") - own + k_path * F.col("host_rate")) / (
        F.col("n") - F.col("w") + k_path
    )
    rate = F.least(F.greatest("path_rate", F.lit(1e-4)), F.lit(1 - 1e-4))
    score = 1 / (1 + F.exp(-(F.col("llr") + F.log(rate / (1 - rate)))))
    return (
        rows.join(
            sites, rows["__host"].eqNullSafe(sites["__h"]) & rows["__path"].eqNullSafe(sites["__p"])
        )
        .withColumn("host_rate", others_host)
        .withColumn("path_rate", others_path)
        .withColumn("score", score)
        .select(
            "doc_id",
            held_out().alias("held_out"),
            "doc_score",
            "host_rate",
            "path_rate",
            "score",
            (F.col("score") >= 0.5).cast("int").alias("predicted"),
            (F.col("score") >= 0.5).alias("kept"),
        )
    )
