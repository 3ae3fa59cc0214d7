"""Fill-in-middle: texts cut by code points, found through a learned index of their offsets."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from tillstream.llm.common import append

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts left as they are, and of the others that begin with the suffix.
PLAIN, SUFFIX_FIRST = 10, 20
#: The most by which a prediction misses an offset; a residual is then one byte.
BOUND = 127


@dataclass
class RankIndex:
    """Where the code point of each rank starts in a text's bytes, its end included.

    The offsets rise piecewise in straight lines. ``first`` holds the first rank of each segment,
    ``base`` its offset, ``rise`` and ``run`` its slope. A prediction misses by ``BOUND`` bytes at
    most, and ``residual`` says by how many.
    """

    first: list[int]
    base: list[int]
    rise: list[int]
    run: list[int]
    residual: np.ndarray

    @staticmethod
    def fit(offsets: np.ndarray, bound: int = BOUND) -> RankIndex:
        """Segments for rising offsets: a range that one line does not fit is halved."""
        index = RankIndex([], [], [], [], np.zeros(len(offsets), dtype=np.int8))
        ranges = [(0, len(offsets))]
        while ranges:
            start, end = ranges.pop()
            base, run = int(offsets[start]), max(1, end - 1 - start)
            rise = int(offsets[end - 1]) - base
            missed = offsets[start:end] - (base + np.arange(end - start) * rise // run)
            if end - start > 2 and np.abs(missed).max() > bound:
                middle = (start + end) // 2
                ranges += [(middle, end), (start, middle)]
                continue
            for column, value in zip(
                (index.first, index.base, index.rise, index.run), (start, base, rise, run)
            ):
                column.append(value)
            index.residual[start:end] = missed
        return index

    def predict(self, rank: int) -> int:
        i = bisect_right(self.first, rank) - 1
        return self.base[i] + (rank - self.first[i]) * self.rise[i] // self.run[i]

    def offset(self, rank: int) -> int:
        return self.predict(rank) + int(self.residual[rank])


def boundaries(data: bytes) -> np.ndarray:
    """Where code points start in UTF-8, and where the last one ends."""
    octets = np.frombuffer(data, dtype=np.uint8)
    return np.append(np.flatnonzero((octets & 0xC0) != 0x80), len(data))


def draws(doc_id) -> list[int]:
    """The four numbers that decide on a document; of a NULL id, those of an empty one."""
    name = f"1:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(name.encode()).hexdigest()
    return [int(digits[i : i + 8], 16) for i in range(0, 32, 8)]


def cut(doc_id, text: str) -> tuple[int, str, int | None, int | None, str]:
    """Number of code points, form, code points of prefix and middle, and the text transformed."""
    data = text.encode()
    offsets = boundaries(data)
    n = len(offsets) - 1
    h1, h2, h3, h4 = draws(doc_id)
    if not n or h3 % 100 >= 100 - PLAIN or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    index = RankIndex.fit(offsets)
    a, b = index.offset(one), index.offset(two)
    prefix, middle, suffix = (part.decode() for part in (data[:a], data[a:b], data[b:]))
    if h4 % 100 < SUFFIX_FIRST:
        return n, "spm", one, two - one, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", one, two - one, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for each row of ``docs``.

    Cuts and form depend on the id and the text alone, so repeated rows get equal results. A NULL
    text counts as empty; an empty one, and one that holds a marker, stays as it is. A NULL id
    draws as an empty one. A very long text costs a few numbers for each of its bytes while it is
    cut, nothing more; no row waits for another, there is no shuffle. Other columns are ignored,
    whatever their names; an empty table gives an empty result.
    """

    def transform(ids, texts):
        rows = [cut(i, t or "") for i, t in zip(ids, texts)]
        types = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        return [pa.array(c, t) for c, t in zip(zip(*rows), types)]

    fields = [
        StructField("n", LongType()),
        StructField("form", StringType()),
        StructField("prefix_chars", LongType()),
        StructField("middle_chars", LongType()),
        StructField("output", StringType()),
    ]
    return append(docs, ["doc_id"], ["doc_id", "text"], transform, fields)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. The parts hold no marker, nor do they form one."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    return (
        F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
        .when(form == "spm", F.concat(parts[2], parts[3], parts[1]))
        .otherwise(output)
    )
