"""Repeated passages removed, by paths of a de Bruijn graph over words.

Windows of twenty words are the edges of the graph. Each window has a minimizer, the least of its
runs of eight words by their hash, and consecutive windows that share one form a path, written as
a single row. Equal windows have equal minimizers, so only paths of one minimizer can share any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tillstream.llm.common import append, found_by_workers

#: Words of a window, and of the run that its minimizer is.
WINDOW, RUN = 20, 8
#: Bytes of text whose paths are compared at once before they are shuffled.
AT_ONCE = 4 << 20
#: One in so many documents is looked at for minimizers with very many different paths. Those in
#: ``COMMON_SHARE`` of them, and ``COMMON_LEAST`` at least, are written window by window, which
#: spreads them; results do not depend on it, so the list may be cut at ``COMMON_MOST``.
SAMPLED, COMMON_SHARE, COMMON_LEAST, COMMON_MOST = 128, 0.01, 32, 10_000

_MANY = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that looks random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_MANY), n, 1 << 64))


def _joined(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Hashes of runs of words, each of which is followed by a run of ``n`` words."""
    return left[: len(right)] * _power(n) + right


def _runs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of eight and of twenty words that start at each word."""
    two = _joined(hashes, hashes[1:], 1)
    four = _joined(two, two[2:], 2)
    eight = _joined(four, four[4:], 4)
    sixteen = _joined(eight, eight[8:], 8)
    return _mixed(eight), _mixed(_joined(sixteen, four[16:], 4))


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Where the first least of ``width`` values is that start at each place."""
    at = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        done += step
    return at


class _Paths:
    """The paths of some documents, in order, as columns."""

    def __init__(self, texts: list[str | None], common: np.ndarray):
        words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(lengths)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(w) for part in words for w in part], dtype=np.uint64)
        self.n = 0
        if len(hashes) < WINDOW:
            return
        eights, windows = _runs(hashes)
        document = np.repeat(np.arange(len(texts)), lengths)[: len(windows)]
        # Windows lie within a document.
        at = np.flatnonzero(np.arange(len(windows)) + WINDOW <= ends[document])
        if not len(at):
            return
        minimizer = _least(eights, WINDOW - RUN + 1)[at]
        hashed = windows[at]
        spread = np.isin(eights[minimizer], common)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (np.diff(minimizer) != 0) | (np.diff(at) != 1) | spread[1:]
        first = np.flatnonzero(new)
        self.n = len(first)
        self.count = np.diff(np.append(first, len(at)))
        self.document = document[at[first]]
        self.start = at[first] - (ends - lengths)[self.document]
        anchor = eights[minimizer[first]]
        self.anchor = np.where(spread[first], _mixed(anchor ^ hashed[first]), anchor)
        self.print = _mixed(hashed[first] * _MANY + hashed[first + self.count - 1])
        self.first = first
        #: Four bytes of each window's hash; those of a path are neighbours.
        self.windows = (hashed >> np.uint64(32)).astype("<u4")

    def seen(self, rank: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which paths to hand on, which start earlier among these documents, and for each path
        the number of the earliest that equals it."""
        place = rank[self.document]
        order = np.lexsort((row[self.document], self.start, place, self.count, self.print, self.anchor))
        same = np.zeros(self.n, dtype=bool)
        a, b = order[:-1], order[1:]
        same[1:] = (
            (self.anchor[a] == self.anchor[b])
            & (self.print[a] == self.print[b])
            & (self.count[a] == self.count[b])
        )
        source = np.empty(self.n, dtype=np.int64)
        source[order] = order[np.maximum.accumulate(np.where(same, 0, np.arange(self.n)))]
        earlier = (place[source] != place) | (self.start[source] != self.start)
        # Of repeated rows one speaks for all.
        repeated = np.zeros(self.n, dtype=bool)
        repeated[order[1:]] = (
            same[1:]
            & (place[a] == place[b])
            & (self.start[a] == self.start[b])
            & (row[self.document[a]] == row[self.document[b]])
        )
        return ~earlier & ~repeated, earlier & ~repeated, source

    def path_bytes(self, chosen: np.ndarray) -> pa.Array:
        sizes = self.count[chosen]
        offsets = np.append(0, np.cumsum(sizes))
        places = np.repeat(self.first[chosen] - offsets[:-1], sizes) + np.arange(offsets[-1])
        return pa.Array.from_buffers(
            pa.binary(),
            len(chosen),
            [
                None,
                pa.py_buffer((4 * offsets).astype(np.int32).tobytes()),
                pa.py_buffer(self.windows[places].tobytes()),
            ],
        )


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``AT_ONCE`` bytes of text, or of one row."""
    for batch in batches:
        sizes = np.cumsum([0, *pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()])
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, sizes[start] + AT_ONCE, side="right")) - 1
            end = max(end, start + 1)
            yield batch.slice(start, end - start)
            start = end


def paths(docs: DataFrame, common: np.ndarray | None = None) -> DataFrame:
    """Paths of ``docs``, which has ``doc_id, row, text``; not those that equal an earlier one of
    documents read at the same time. ``known`` tells of these where they are, joined as long as
    their source goes on too."""
    id_field = docs.schema["doc_id"]
    shared = np.zeros(0, dtype=np.uint64) if common is None else common
    known_type = StructType(
        [
            StructField("count", IntegerType()),
            StructField("source", id_field.dataType),
            StructField("source_start", IntegerType()),
        ]
    )
    schema = StructType(
        [
            StructField("anchor", LongType()),
            id_field,
            StructField("row", LongType()),
            StructField("start", IntegerType()),
            StructField("path", BinaryType()),
            StructField("known", known_type),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _portions(batches):
            found = _Paths(part.column("text").to_pylist(), shared)
            if not found.n:
                continue
            ids, row_ids = part.column("doc_id"), part.column("row")
            # A NULL id comes after all others.
            rank = pc.rank(ids, null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
            keep, earlier, source = found.seen(rank, row_ids.to_numpy())
            chosen, old = np.flatnonzero(keep), np.flatnonzero(earlier)
            known = [pa.int32(), ids.type, pa.int32()]
            if len(old):
                shift = found.start[old] - found.start[source[old]]
                new = np.ones(len(old), dtype=bool)
                new[1:] = (
                    (np.diff(old) != 1)
                    | (np.diff(found.document[old]) != 0)
                    | (np.diff(found.start[old]) != found.count[old[:-1]])
                    | (np.diff(found.document[source[old]]) != 0)
                    | (np.diff(shift) != 0)
                )
                heads = np.flatnonzero(new)
                counts = np.add.reduceat(found.count[old], heads)
                old = old[heads]
                spans = [
                    pa.array(counts, known[0]),
                    ids.take(pa.array(found.document[source[old]])),
                    pa.array(found.start[source[old]], known[2]),
                ]
            else:
                spans = [pa.array([], t) for t in known]
            names = ["count", "source", "source_start"]
            struct = pa.StructArray.from_arrays(spans, names)
            both = np.concatenate([chosen, old])
            where = pa.array(found.document[both])
            rows = row_ids.take(where)
            anchors = np.concatenate(
                [found.anchor[chosen].view(np.int64), row_ids.to_numpy()[found.document[old]]]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors),
                    ids.take(where),
                    rows,
                    pa.array(found.start[both], pa.int32()),
                    pa.concat_arrays([found.path_bytes(chosen), pa.nulls(len(old), pa.binary())]),
                    pa.concat_arrays([pa.nulls(len(chosen), struct.type), struct]),
                ],
                names=schema.fieldNames(),
            )

    found_by_workers(docs)
    return docs.select("doc_id", "row", "text").mapInArrow(run, schema)


def common_anchors(docs: DataFrame) -> np.ndarray:
    """Minimizers with very many different paths, from a share of the documents."""
    some = docs.where(F.pmod("row", F.lit(SAMPLED)) == 0)
    total = some.count()
    found = (
        paths(some)
        .where("path is not null")
        .groupBy("anchor")
        .count()
        .where(F.col("count") >= max(COMMON_LEAST, COMMON_SHARE * total))
        .orderBy(F.desc("count"), "anchor")
        .limit(COMMON_MOST)
        .collect()
    )
    return np.array([r["anchor"] for r in found], dtype=np.int64).view(np.uint64)


def with_rows(docs: DataFrame) -> DataFrame:
    """``doc_id, row, text``, where equal rows have equal numbers."""
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``doc_id, row, start, count, source, source_start`` for rows as ``with_rows`` gives them.

    The ``count`` windows of a document from word ``start`` all stand elsewhere too, first in
    document ``source``, from word ``source_start``. A span goes on as long as its source does.

    Paths are dealt by minimizer. A path that is the same wherever its minimizer stands does not
    branch, and all its places but the first are repeats. Where a minimizer has different paths,
    the first place of each is taken apart into windows, and these are compared.
    """
    order = [F.col("doc_id").asc_nulls_last(), "start"]
    of_path = Window.partitionBy("anchor", "path").orderBy(*order)
    of_anchor = Window.partitionBy("anchor")
    of_window = Window.partitionBy("anchor", "window").orderBy(*order)
    sized = F.expr("cast(length(path) div 4 as int)")
    edges = (
        paths(rows, common_anchors(rows))
        .repartition("anchor")
        .withColumn("branches", F.min("path").over(of_anchor) != F.max("path").over(of_anchor))
        .withColumn("place", F.rank().over(of_path))
        .withColumn("source", F.first("doc_id").over(of_path))
        .withColumn("source_start", F.first("start").over(of_path))
    )

    def piece(shift, count, window, source, source_start):
        return F.struct(
            (F.col("start") + shift).alias("start"), count.alias("count"), window.alias("window"),
            source.alias("source"), source_start.alias("source_start"),
        )

    no_window = F.lit(None).cast("binary")
    zero = F.lit(0)
    pieces = (
        F.when(
            F.col("path").isNull(),
            F.array(piece(zero, F.col("known.count"), no_window, F.col("known.source"), F.col("known.source_start"))),
        )
        .when(
            F.col("place") > 1,
            F.array(piece(zero, sized, no_window, F.col("source"), F.col("source_start"))),
        )
        .when(
            F.col("branches"),
            F.transform(
                F.sequence(zero, sized - 1),
                lambda i: piece(
                    i, F.lit(1), F.col("path").substr(4 * i + 1, F.lit(4)), F.col("doc_id"), F.col("start") + i
                ),
            ),
        )
    )
    windows = (
        edges.select("anchor", "doc_id", "row", F.explode(pieces).alias("p"))
        .select("anchor", "doc_id", "row", "p.*")
        .withColumn("place", F.rank().over(of_window))
        .withColumn("first", F.struct(F.first("doc_id").over(of_window).alias("id"), F.first("start").over(of_window).alias("start")))
        .where("window is null or place > 1")
    )
    repeated = windows.select(
        "doc_id", "row", "start", "count",
        F.when(F.col("window").isNull(), F.col("source")).otherwise(F.col("first.id")).alias("source"),
        F.when(F.col("window").isNull(), F.col("source_start")).otherwise(F.col("first.start")).alias("source_start"),
    )
    # Paths and windows that go on in the document and in its source are one span.
    in_row = Window.partitionBy("row", "doc_id").orderBy("start")
    goes_on = (
        (F.lag(F.col("start") + F.col("count")).over(in_row) == F.col("start"))
        & F.lag("source").over(in_row).eqNullSafe(F.col("source"))
        & (F.lag(F.col("source_start") + F.col("count")).over(in_row) == F.col("source_start"))
    )
    return (
        repeated.repartition("row")
        .dropDuplicates(["row", "doc_id", "start"])
        .withColumn("new", F.when(goes_on, 0).otherwise(1))
        .withColumn("span", F.sum("new").over(in_row))
        .groupBy("row", "doc_id", "span")
        .agg(
            F.min("start").alias("start"),
            F.sum("count").cast("int").alias("count"),
            F.min_by("source", "start").alias("source"),
            F.min("source_start").alias("source_start"),
        )
        .select("doc_id", "row", "start", "count", "source", "source_start")
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for each row of ``docs``.

    Words covered by a window of twenty that also starts earlier are removed, where a smaller
    ``doc_id`` is earlier, and in one document a smaller word number; a NULL id comes last. Rows
    that share an id are as early as each other: a window of theirs is earlier only if it starts at
    a smaller number. Repeated rows so get equal results. A NULL or empty text has no words, and
    one of under twenty loses none. Very long texts are whole: their windows are rows, and one
    text at a time is held by a task. An empty table gives an empty result; other columns are
    ignored, whatever their names.

    Windows are told apart by 96 bits or more: 64 of the minimizer and 32 of each window.
    """
    rows = with_rows(docs)
    spans = (
        repeated_spans(rows)
        .groupBy("row", "doc_id")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts"))
        .select(F.col("row").alias("of"), F.col("doc_id").alias("id"), "starts", "counts")
    )
    joined = rows.join(
        spans, (F.col("row") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id")), "left"
    )

    def remove(texts, starts, counts):
        out = []
        for text, begins, sizes in zip(texts, starts, counts):
            words = (text or "").encode("utf-8", "surrogatepass").split()
            n = len(words)
            if begins:
                gone = np.zeros(n, dtype=bool)
                for start, count in zip(begins, sizes):
                    gone[start : start + count + WINDOW - 1] = True
                words = [words[i] for i in np.flatnonzero(~gone)]
            kept = b" ".join(words)
            out.append((n, n - len(words), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
        types = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return [pa.array(c, t) for c, t in zip(zip(*out), types)]

    fields = [
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("kept_sha256", StringType()),
        StructField("kept", StringType()),
    ]
    return append(joined, ["doc_id"], ["text", "starts", "counts"], remove, fields)
