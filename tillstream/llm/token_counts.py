"""Token counts of documents from the piece counts of their distinct pre-tokens."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillstream.llm.common import SLICE_ROWS, append, emit, found_by_workers

LIMIT = 4096
#: Pre-tokens whose counts are broadcast, at about 100 bytes each: those in most documents.
COMMON = 200_000
#: Distinct pre-tokens that a task holds before it hands their document counts on.
HELD = 400_000
#: What the model writes for a space.
MARK = "▁"


class Pieces:
    """A sentencepiece model, and a pattern for the pre-tokens that it never joins.

    Each merge makes a piece of the vocabulary. Where the character before and the one after stand
    side by side in no piece, no merge crosses, and the parts on both sides can be counted each by
    itself. ``signs`` are ASCII characters that stand beside no other than signs in any piece, or
    after a space. A pre-token is a run of signs, or of others, with the spaces before it.
    """

    def __init__(self, path: str):
        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        pairs = {
            p[k : k + 2]
            for i in range(m.get_piece_size())
            if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))
            for p in [m.id_to_piece(i)]
            for k in range(len(p) - 1)
        }
        signs = {chr(c) for c in range(1, 128) if not chr(c).isalnum()} - {" "}
        while True:
            beside = {
                c
                for a, b in pairs
                for c, other, before in ((a, b, False), (b, a, True))
                if c in signs and other not in signs and not (before and other == MARK)
            }
            if not beside:
                break
            signs -= beside
        inside = "".join(map(re.escape, sorted(signs)))
        run = f"(?:[^ {inside}]+|[{inside}]+)" if inside else "[^ ]+"
        joins_spaces = any(b == MARK != a for a, b in pairs)
        self.parts = re.compile(".+" if joins_spaces else f" *{run}| +", re.S)
        # A character of no pair may stand before a pre-token without a space.
        self.anchor = next(
            chr(c) for c in range(1, 0x3000) if not any(chr(c) in p for p in pairs)
        )
        self.anchored = len(m.encode(self.anchor))

    def split(self, text: str) -> list[str]:
        """The pre-tokens of a text, which the model begins with a space.

        To the model its mark for a space is one wherever it stands.
        """
        return self.parts.findall(" " + text.replace(MARK, " ")) if text else []

    def count(self, parts: list[str]) -> list[int]:
        """Pieces of each pre-token. The model puts a space before every text it is given."""
        spaced = [p[1:] if p[0] == " " else self.anchor + p for p in parts]
        encoded = self.model.encode(spaced, num_threads=1)
        # Of a lone space nothing is left to encode.
        return [
            len(e) - (0 if p[0] == " " else self.anchored) if s else 1
            for p, s, e in zip(parts, spaced, encoded)
        ]


@lru_cache(maxsize=2)
def _pieces(path: str) -> Pieces:
    return Pieces(path)


def _common(docs: DataFrame, vocabulary: str, most: int) -> dict[str, int]:
    """The pre-tokens of most documents with their piece counts; at most ``most``.

    A task holds few enough at a time and leaves out what it met in one document only.
    """

    def count(parts: Iterator[tuple[list]]) -> Iterator[list[pa.Array]]:
        model = _pieces(vocabulary)
        counts: Counter = Counter()

        def out() -> list[pa.Array]:
            often = {p: n for p, n in counts.items() if n > 1}
            counts.clear()
            return [pa.array(often, pa.string()), pa.array(often.values(), pa.int64())]

        for (texts,) in parts:
            for text in texts:
                counts.update(set(model.split(text or "")))
            if len(counts) > HELD:
                yield out()
        yield out()

    schema = StructType([StructField("part", StringType()), StructField("n", LongType())])
    chosen = (
        emit(docs, ["text"], count, schema)
        .groupBy("part")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "part")
        .limit(most)
        .select("part")
    )
    parts = [row["part"] for row in chosen.collect()]
    return dict(zip(parts, _pieces(vocabulary).count(parts))) if parts else {}


def _frequencies(docs: DataFrame, vocabulary: str, common: dict[str, int]) -> DataFrame:
    """For each row of ``docs`` one with ``doc_id, n_bytes`` and the pieces of common pre-tokens
    as ``times``, and one with ``part, times`` for each of its other distinct pre-tokens. ``uid``
    tells the rows of ``docs`` apart.
    """
    known = docs.sparkSession.sparkContext.broadcast(common)
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts = _pieces(vocabulary), known.value
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                uids, texts = part.column(0).to_pylist(), part.column(2).to_pylist()
                sizes, sums = [], []
                rare: list[tuple[int, str, int]] = []
                for uid, text in zip(uids, texts):
                    total = 0
                    for p, times in Counter(model.split(text or "")).items():
                        if p in counts:
                            total += counts[p] * times
                        else:
                            rare.append((uid, p, times))
                    sums.append(total)
                    sizes.append(len((text or "").encode("utf-8", "surrogatepass")))
                n, m = len(uids), len(rare)
                ids = part.column(1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*uids, *(r[0] for r in rare)], pa.int64()),
                        pa.concat_arrays([ids, pa.nulls(m, ids.type)]),
                        pa.array([*sizes, *[None] * m], pa.int64()),
                        pa.array([*[None] * n, *(r[1] for r in rare)], pa.string()),
                        pa.array([*sums, *(r[2] for r in rare)], pa.int64()),
                    ],
                    names=["uid", "doc_id", "n_bytes", "part", "times"],
                )

    schema = StructType(
        [
            StructField("uid", LongType()),
            StructField("doc_id", id_type),
            StructField("n_bytes", LongType()),
            StructField("part", StringType()),
            StructField("times", LongType()),
        ]
    )
    found_by_workers(docs)
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text")
    return numbered.mapInArrow(run, schema)


def token_counts(
    docs: DataFrame, vocabulary: str, limit: int = LIMIT, common: int = COMMON
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    A NULL text is an empty one, with no bytes and tokens. Repeated rows get a row each; a NULL
    ``doc_id`` is carried along; other columns are ignored; an empty table gives an empty result.

    The pieces of each distinct pre-token are counted once and joined to the frequencies of
    pre-tokens in documents. Those in most documents, at most ``common``, are joined within the
    task by a broadcast of that bound, so no key of the shuffled join is in more than a small
    share of the documents, and most frequencies are never shuffled.
    """
    rows = _frequencies(docs, vocabulary, _common(docs, vocabulary, common))
    distinct = rows.where("part is not null").select("part").distinct()

    def count(parts):
        return [pa.array(_pieces(vocabulary).count(parts) if parts else [], pa.int64())]

    pieces = append(distinct, ["part"], ["part"], count, [StructField("pieces", LongType())])
    # Rows without a part keep away from each other in the join: their key is their number.
    key = F.coalesce("part", F.concat(F.lit("\0"), F.col("uid").cast("string")))
    joined = rows.select("uid", "doc_id", "n_bytes", "times", key.alias("key")).join(
        pieces.withColumnRenamed("part", "key"), "key", "left"
    )
    sums = joined.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("times") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
    )
    return sums.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
