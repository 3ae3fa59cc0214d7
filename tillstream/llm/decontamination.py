"""Benchmark passages in documents, by a prefix-filtered join of word windows."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillstream.llm.common import append, durable, emit

WINDOW = 13
#: A document is contaminated if at least one in so many of its words is hit.
SHARE = 20
#: Windows of one index. Larger sets of items are searched in blocks of so many.
BLOCK_WINDOWS = 200_000

#: A-Z to a-z; every other ASCII character that is no digit or letter separates words.
_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD).split()


def _windows(words: list[bytes], size: int) -> Iterator[list[bytes]]:
    for i in range(max(1, len(words) - size + 1) if words else 0):
        yield words[i : i + size]


def _blocks(benchmark: DataFrame, size: int, most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most so many windows, read one partition at a time."""
    block, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        words = words_of(row[1])
        if not words:
            continue
        block.append((row[0] if row[0] is not None else "null", words))
        held += max(1, len(words) - size + 1)
        if held >= most:
            yield block
            block, held = [], 0
    if block:
        yield block


def document_counts(docs: DataFrame, vocabulary: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the vocabulary stands. At most a row for each word."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(parts):
        counts: Counter = Counter()
        for (texts,) in parts:
            for text in texts:
                counts.update(shared.value.intersection(words_of(text)))
        yield [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]

    schema = StructType([StructField("word", BinaryType()), StructField("n", LongType())])
    totals = emit(docs, ["text"], count, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(row["word"]): row["n"] for row in totals.collect()}


class WindowIndex:
    """The windows of some items, listed under their rarest word.

    A window must be contained whole, so its necessary prefix in the order of rarity is one word.
    An entry has the word's place in the window, the window's second rarest word with its place,
    the window, and the items that have it.
    """

    def __init__(self, items, counts: dict[bytes, int], size: int):
        holders: dict[bytes, set[str]] = defaultdict(set)
        for item, words in items:
            for window in _windows(words, size):
                holders[b" ".join(window)].add(item)
        self.under: dict[bytes, list] = defaultdict(list)
        for joined, held in holders.items():
            window = joined.split(b" ")
            order = sorted(range(len(window)), key=lambda i: (counts.get(window[i], 0), window[i], i))
            first, second = order[0], order[min(1, len(order) - 1)]
            self.under[window[first]].append((first, second, window, tuple(sorted(held))))
        self.under = dict(self.under)

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Where windows stand, as start and end, and the items they belong to."""
        places, items = set(), set()
        under, n = self.under, len(words)
        for at, word in enumerate(words):
            if word in under:
                for first, second, window, held in under[word]:
                    start = at - first
                    end = start + len(window)
                    # Length and position bounds, then the next rarest word, then the window.
                    if (
                        start >= 0
                        and end <= n
                        and words[start + second] == window[second]
                        and words[start:end] == window
                    ):
                        places.add((start, end))
                        items.update(held)
        return sorted(places), items


def _merged(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for start, end in sorted(places):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("n_items", LongType()),
    StructField("items_sha256", StringType()),
    StructField("contaminated", BooleanType()),
]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    window: int = WINDOW,
    share: int = SHARE,
    block_windows: int = BLOCK_WINDOWS,
    prefix: str = "",
) -> DataFrame:
    """The ``keep`` columns and, named with ``prefix``, what of the benchmark each row holds.

    A window is ``window`` consecutive words of an item; an item with fewer, but not none, is one
    window. ``n_hit`` counts the words inside an occurrence of any, ``n_items`` the item ids with
    one; ``contaminated`` is ``n_hit > 0 and share * n_hit >= n_words``. A NULL text has no words
    and is clean; a NULL item id counts as the id "null"; items or rows that repeat change nothing
    for the others; without items all is clean.

    The benchmark is a stated query set. It is searched in blocks of at most ``block_windows``
    windows (and one item more), the only thing that is broadcast. Words are ordered by the number
    of documents that hold them, counted over all. With more than one block, what was found so far
    is carried along with the rows through a checkpoint, so that one index is in memory at a time.
    """
    names = [prefix + f.name for f in FIELDS]
    hits, found = "__hits", "__found"
    state = [StructField(hits, StringType()), StructField(found, StringType())]
    rows = docs
    carried: list[str] = []
    context = docs.sparkSession.sparkContext
    blocks = _blocks(benchmark, window, block_windows)
    block = next(blocks, [])
    while True:
        counts = document_counts(docs, frozenset(w for _, ws in block for w in ws)) if block else {}
        index = context.broadcast(WindowIndex(block, counts, window))
        block = next(blocks, None)
        if block is None:
            break

        def partly(texts, *before, index=index):
            out_hits, out_found = [], []
            for i, text in enumerate(texts):
                places, items = index.value.search(words_of(text))
                if before:
                    places = [*_places(before[0][i]), *places]
                    items = {*_items(before[1][i]), *items}
                out_hits.append(",".join(f"{a}:{b}" for a, b in _merged(places)))
                out_found.append("\0".join(sorted(items)))
            return [pa.array(out_hits, pa.string()), pa.array(out_found, pa.string())]

        kept = list(dict.fromkeys([*keep, "text"]))
        rows = append(rows, kept, ["text", *carried], partly, state)
        carried = [hits, found]
        rows = durable(rows)

    def whole(texts, *before):
        out = [[], [], [], [], []]
        for i, text in enumerate(texts):
            words = words_of(text)
            places, items = index.value.search(words)
            if before:
                places = [*_places(before[0][i]), *places]
                items = {*_items(before[1][i]), *items}
            hit = sum(b - a for a, b in _merged(places))
            digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
            for column, value in zip(
                out, (len(words), hit, len(items), digest, hit > 0 and share * hit >= len(words))
            ):
                column.append(value)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return [pa.array(c, t) for c, t in zip(out, types)]

    fields = [StructField(n, f.dataType) for n, f in zip(names, FIELDS)]
    return append(rows, list(keep), ["text", *carried], whole, fields)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with the same columns."""
    prefix = "__benchmark_"
    rows = contamination(docs, benchmark, tuple(docs.columns), prefix=prefix)
    return rows.where(~F.col(prefix + "contaminated")).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )


def _places(text: str) -> list[tuple[int, int]]:
    return [tuple(map(int, p.split(":"))) for p in text.split(",") if p]


def _items(text: str) -> list[str]:
    return text.split("\0") if text else []
