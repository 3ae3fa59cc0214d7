"""Quality rules from the fertility of a public tokeniser, with bands for each language."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillstream.llm.common import Memo, append, durable

MIN_WORDS = 50
#: Percentage of words in repeated three-word windows beyond which a text is rejected.
MOST_REPEATED = 50
#: A measure is out of its band if it is further from the median than so many times the distance
#: between the quartile on that side and the median, and further than the least width: a share of
#: the median for characters a token, else an absolute one. An unusually rich text is no fault.
WIDTH = 5.0
LEAST_WIDTH = {"chars_per_token": 0.3, "byte_share": 0.1, "entropy_excess": 0.2}
LOW_SIDE = {"chars_per_token", "entropy_excess"}
HIGH_SIDE = {"chars_per_token", "byte_share"}
#: Tokens from which on the entropy of a text counts fully.
STEADY_TOKENS = 500
#: A band weighs as many rows as it has, of at least ``MIN_WORDS`` words; what its script has, and
#: what any script has, weigh so many.
PRIOR_ROWS = 20
#: Quartiles that any script may have. They reject no prose, but texts whose tokens
#: hardly vary.
PRIOR = {
    "chars_per_token": (0.4, 1.5, 4.0),
    "byte_share": (0.0, 0.3, 0.9),
    "entropy_excess": (-0.4, 0.0, 0.4),
}
#: Bits of token entropy that a text of any script has, whatever its length: less than prose of any,
#: as far as known, and more than texts of a few tokens.
PRIOR_ENTROPY, PRIOR_LENGTHS = 4.5, np.arange(6.0, 20.0)
#: Quartiles are exact for measures to so many parts of one, in a range that is never left.
PARTS, RANGE = 1000, 100
#: Words whose pieces a worker remembers.
REMEMBERED = 120_000

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\r\x0b\x0c"
_MARK = "\u2581"

#: First code points of blocks, and the script that a letter from there on is counted for.
_SCRIPTS = [
    (0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"),
    (0x600, "arabic"), (0x780, "other"), (0x900, "indic"), (0xE00, "thai"), (0xE80, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
    (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
]
_STARTS = np.array([s for s, _ in _SCRIPTS])


def script_of(text: str) -> str:
    """The script that most letters of a text belong to; "none" without letters."""
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else "none"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letters = points[((points | 32) >= 97) & ((points | 32) <= 122) | (points >= 0xAA)]
    if not len(letters):
        return "none"
    blocks = np.bincount(
        np.searchsorted(_STARTS, letters, side="right").clip(1) - 1, minlength=len(_SCRIPTS)
    )
    return _SCRIPTS[int(blocks.argmax())][1]


def base_counts(data: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """Code points in words, symbols, repeated lines, and words in repeated windows of three."""
    inside = data.translate(None, _SPACES)
    word_chars = np.count_nonzero(np.frombuffer(inside, np.uint8) & 0xC0 != 0x80)
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    lines = [x for x in data.split(b"\n") if x.strip(_SPACES)]
    repeated = 0
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        hit = bytearray(len(words))
        for i, window in enumerate(windows):
            if times[window] > 1:
                hit[i : i + 3] = b"\1\1\1"
        repeated = hit.count(1)
    return int(word_chars), symbols, len(lines) - len(set(lines)), repeated


class Fertility:
    """Pieces of words under a sentencepiece vocabulary with byte fallback.

    Each word is encoded by itself, so its pieces can be remembered. What is remembered is
    bounded and only saves time.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.fallback = np.array([self.model.is_byte(i) for i in range(self.size)])
        # Pieces that begin a word, which is marked by U+2581.
        self.begins = np.array(
            [self.model.id_to_piece(i).startswith(_MARK) for i in range(self.size)]
        )
        self.known = Memo(self._learn, REMEMBERED)

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """The pieces of words, of many words in one text where the marks tell them apart."""
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [i for i, t in enumerate(texts) if _MARK not in t]
        found: dict[bytes, bytes] = {}
        groups = [plain[k : k + 200] for k in range(0, len(plain), 200)]
        joined = [" ".join(texts[i] for i in g) for g in groups]
        for group, ids in zip(groups, self.model.encode(joined, num_threads=1)):
            ids = np.array(ids, dtype="<u4")
            cuts = np.flatnonzero(self.begins[ids])
            for i, a, b in zip(group, cuts, [*cuts[1:], len(ids)]):
                found[words[i]] = ids[a:b].tobytes()
        for i in set(range(len(words))).difference(plain):
            found[words[i]] = np.array(self.model.encode(texts[i]), "<u4").tobytes()
        return found

    def measure(
        self, word_chars: int, words: list[bytes], known: dict
    ) -> tuple[int, float, float, float]:
        """Tokens, characters a token, share of byte pieces, entropy of the tokens in bits."""
        ids = np.frombuffer(b"".join(map(known.__getitem__, words)), dtype="<u4")
        n = len(ids)
        if not n:
            return 0, 0.0, 0.0, 0.0
        times = np.unique(ids, return_counts=True)[1]
        entropy = math.log2(n) - float((times * np.log2(times)).sum()) / n
        return n, word_chars / n, float(self.fallback[ids].sum()) / n, entropy


@lru_cache(maxsize=2)
def _fertility(path: str) -> Fertility:
    return Fertility(path)


FIELDS = [
    StructField("n_words", LongType()),
    StructField("word_chars", LongType()),
    StructField("n_symbols", LongType()),
    StructField("n_dup_lines", LongType()),
    StructField("n_repeat_words", LongType()),
    StructField("n_tokens", LongType()),
    StructField("chars_per_token", DoubleType()),
    StructField("byte_share", DoubleType()),
    StructField("token_entropy", DoubleType()),
    StructField("band", StringType()),
    StructField("script", StringType()),
]
MEASURES = ["chars_per_token", "byte_share", "entropy_excess"]


def measured(
    docs: DataFrame, vocabulary: str, keep: tuple[str, ...] = ("doc_id",), prefix: str = ""
) -> DataFrame:
    """The ``keep`` columns and, named with ``prefix``, the counts and measures of every text.

    The band is the language if it is a code of two or three letters, else the script of the text,
    so there are fewer than 20,000 bands however many rows there are.
    """

    def measure(texts, langs):
        model = _fertility(vocabulary)
        out = [[] for _ in FIELDS]
        encoded = [(text or "").encode("utf-8", "surrogatepass") for text in texts]
        split = [data.split() for data in encoded]
        known = model.known.of(set(chain.from_iterable(split)))
        for text, lang, data, words in zip(texts, langs, encoded, split):
            counts = base_counts(data, words)
            code = (lang or "").lower()
            script = script_of(text or "")
            band = code if re.fullmatch("[a-z]{2,3}", code) else f"script {script}"
            row = (len(words), *counts, *model.measure(counts[0], words, known), band, script)
            for column, value in zip(out, row):
                column.append(value)
        types = [pa.int64()] * 6 + [pa.float64()] * 3 + [pa.string()] * 2
        return [pa.array(c, t) for c, t in zip(out, types)]

    fields = [StructField(prefix + f.name, f.dataType) for f in FIELDS]
    return append(docs, list(keep), ["text", "lang"], measure, fields)


def _scripts_of_bands(long: DataFrame, prefix: str) -> tuple[dict, dict]:
    """Rows of each band, with the script that most of them have, and of each script.

    Fewer than 20,000 bands. All counts are merged from partial ones, so a language with a third of
    the rows is as cheap as another.
    """
    band, script = F.col(prefix + "band").alias("band"), F.col(prefix + "script").alias("script")
    rows = F.count("*").alias("rows")
    bands = long.groupBy(band).agg(rows, F.mode(prefix + "script", True).alias("script")).collect()
    scripts = {r["script"]: r["rows"] for r in long.groupBy(script).agg(rows).collect()}
    return {r["band"]: (r["rows"], r["script"]) for r in bands}, scripts


def _by_band(found: dict[str | None, list[float | None]], band: str) -> Column:
    """The numbers of a row's band, or those under None for a band without rows of enough words."""

    def numbers(values) -> Column:
        return F.array(*(F.lit(v).cast("double") for v in values))

    pairs = [x for b, v in found.items() if b is not None for x in (F.lit(b), numbers(v))]
    own = F.create_map(*pairs)[F.col(band)] if pairs else F.lit(None).cast("array<double>")
    return F.coalesce(own, numbers(found[None]))


def with_excess(rows: DataFrame, long: DataFrame, prefix: str = "") -> tuple[DataFrame, DataFrame]:
    """Both with ``entropy_excess``: entropy beyond what the band has in texts as long.

    A long text has more entropy than a short one. What is usual is a parabola over the logarithm
    of the number of tokens, fitted to the sums over all rows of the band and ``PRIOR_ROWS`` rows as
    its script has them, to which as many with ``PRIOR_ENTROPY`` are added. The sums are exact, so
    they do not depend on the order of rows.
    """
    c = lambda name: F.col(prefix + name)
    x, y = F.log2(F.greatest(c("n_tokens"), F.lit(1))), c("token_entropy")
    names = [f"x{i}" for i in range(5)] + [f"y{i}" for i in range(3)]
    terms = [F.pow(x, F.lit(i)) for i in range(5)] + [F.pow(x, F.lit(i)) * y for i in range(3)]
    sums = [F.sum(F.round(t, 6).cast("decimal(24,6)")).alias(n) for t, n in zip(terms, names)]

    def numbers(row) -> np.ndarray:
        return np.array([float(row[n]) for n in names])

    def parabola(v: np.ndarray) -> list[float]:
        matrix = np.array([[v[i + j] for j in range(3)] for i in range(3)])
        return np.linalg.lstsq(matrix, v[5:], rcond=None)[0].tolist()

    bands, scripts = _scripts_of_bands(long, prefix)
    by_band = {r[0]: numbers(r) for r in long.groupBy(c("band")).agg(*sums).collect()}
    by_script = {r[0]: numbers(r) for r in long.groupBy(c("script")).agg(*sums).collect()}
    powers = [(PRIOR_LENGTHS**i).mean() for i in range(5)]
    prior = np.array([*powers, *(PRIOR_ENTROPY * p for p in powers[:3])])
    fitted: dict = {None: parabola(prior)}
    for band, (_, script) in bands.items():
        usual = (by_script[script] + PRIOR_ROWS * prior) / (scripts[script] + PRIOR_ROWS)
        fitted[band] = parabola(by_band[band] + PRIOR_ROWS * usual)
    k = _by_band(fitted, prefix + "band")
    # The fewer tokens, the wider the scatter: short texts are drawn towards the usual.
    steady = F.least(F.sqrt(c("n_tokens") / STEADY_TOKENS), F.lit(1.0))
    excess = steady * (y - (k[0] + x * (k[1] + x * k[2])))
    name = prefix + "entropy_excess"
    return rows.withColumn(name, excess), long.withColumn(name, excess)


def _quartiles(long: DataFrame, prefix: str, by: str) -> dict[str, dict[str, np.ndarray]]:
    """The quartiles of every measure for each band or script, by the counts of its values.

    A group has a row for each value of a measure to one part in ``PARTS``, however many rows it
    has; places among them are counted in Spark, and three of them come to the driver.
    """
    value = F.greatest(F.least(F.col("value"), F.lit(RANGE)), F.lit(-RANGE))
    measures = F.array(
        *(F.struct(F.lit(m).alias("measure"), F.col(prefix + m).alias("value")) for m in MEASURES)
    )
    counts = (
        long.select(F.col(prefix + by).alias("of"), F.explode(measures).alias("m"))
        .select("of", "m.measure", "m.value")
        .groupBy("of", "measure", F.round(value * PARTS).cast("int").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    group = Window.partitionBy("of", "measure")
    up_to = F.sum("n").over(group.orderBy("value")) / F.sum("n").over(group)
    firsts = [
        F.min(F.when(F.col("up_to") >= q, F.col("value"))).alias(f"q{i}")
        for i, q in enumerate((0.25, 0.5, 0.75))
    ]
    found: dict = {}
    for r in counts.withColumn("up_to", up_to).groupBy("of", "measure").agg(*firsts).collect():
        found.setdefault(r["of"], {})[r["measure"]] = np.array([r["q0"], r["q1"], r["q2"]]) / PARTS
    return found


def _limits(long: DataFrame, prefix: str) -> Column:
    """Low and high bound of every measure, for a row's band; NULL without any rows.

    The quartiles of a band are drawn towards its script's, and these towards those that any script
    may have, the more the fewer rows there are. There is no number of rows at which that ends.
    """
    bands, scripts = _scripts_of_bands(long, prefix)
    by_band, by_script = _quartiles(long, prefix, "band"), _quartiles(long, prefix, "script")
    found: dict = {None: [None, None] * len(MEASURES)}
    for band, (rows, script) in bands.items():
        own = rows / (rows + PRIOR_ROWS)
        known = scripts[script] / (scripts[script] + PRIOR_ROWS)
        bounds: list[float | None] = []
        for m in MEASURES:
            usual = known * by_script[script][m] + (1 - known) * np.array(PRIOR[m])
            low, middle, high = (own * by_band[band][m] + (1 - own) * usual).tolist()
            least = LEAST_WIDTH[m] * (middle if m == "chars_per_token" else 1)
            bounds.append(middle - max(least, WIDTH * (middle - low)) if m in LOW_SIDE else None)
            bounds.append(middle + max(least, WIDTH * (high - middle)) if m in HIGH_SIDE else None)
        found[band] = bounds
    return _by_band(found, prefix + "band")


def judged(rows: DataFrame, measures: DataFrame, prefix: str = "") -> DataFrame:
    """Adds ``entropy_excess``, ``base_failed``, ``out_of_band`` with the measures that are, ``kept``.

    The bands are those of ``measures``, from its rows of at least ``MIN_WORDS`` words.
    """
    c = lambda name: F.col(prefix + name)
    rows, long = with_excess(rows, measures.where(c("n_words") >= MIN_WORDS), prefix)
    limits = _limits(long, prefix)
    failed = (c("n_words") < MIN_WORDS) | (
        100 * c("n_repeat_words") > MOST_REPEATED * c("n_words")
    )
    outside = [
        F.when((c(m) < limits[2 * i]) | (c(m) > limits[2 * i + 1]), F.lit(m))
        for i, m in enumerate(MEASURES)
    ]
    return (
        rows.withColumn(prefix + "base_failed", failed)
        .withColumn(prefix + "out_of_band", F.concat_ws(",", *outside))
        .withColumn(prefix + "kept", ~c("base_failed") & (c("out_of_band") == ""))
    )


def quality(docs: DataFrame, vocabulary: str) -> DataFrame:
    """A row for each row of ``docs``: counts, measures, ``base_failed``, ``kept``.

    Reads ``doc_id``, ``text`` and ``lang``; other columns are ignored. A NULL or empty text has
    no words, so it fails the base rules and all its measures are 0. A NULL language is judged by
    script. The band of a language is drawn towards that of its script, and this towards one that
    keeps prose of any script, as far as they have few rows. Repeated rows are each judged alike, and
    so are the same rows in another order; an empty table gives an empty result. A very long text
    counts as one row, by all of its tokens.
    """
    rows = durable(measured(docs, vocabulary))
    return judged(rows, rows).drop("script")


def kept_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The rows of ``docs`` that are kept, with the same columns.

    The texts are measured twice, once for the bands and once for the verdict: that costs time, but
    no text is shuffled or stored.
    """
    prefix = "__quality_"
    measures = durable(measured(docs, vocabulary, (), prefix))
    rows = measured(docs, vocabulary, tuple(docs.columns), prefix)
    return judged(rows, measures, prefix).where(F.col(prefix + "kept")).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
