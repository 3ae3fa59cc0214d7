"""Near duplicates by SimHash, found through an inverted index over fingerprint bytes."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tillstream.llm.common import append, durable, emit
from tillstream.llm.components import components

SEED = 42
#: Hashes whose bits are counted at once.
COUNTED = 1 << 16
#: Fingerprints of one posting list that one task compares with as many others.
CHUNK = 2048
#: Three differing bits spoil at most three of the eight bytes. These fourteen sets of four byte
#: positions are the blocks of the Steiner system S(3, 4, 8): every three positions lie in one,
#: and the complement of a block is a block. So whichever three bytes are spoilt, the four of
#: some block are whole.
BLOCKS = [b for b in combinations(range(8), 4) if b[0] ^ b[1] ^ b[2] ^ b[3] == 0]
#: Bytes that must agree, and the most bits for which that is guaranteed.
SHARED, MOST_BITS = 5, 3


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text as a signed 64-bit number.

    Letters A-Z in lower case, words at ASCII white space, shingles with repeats, XXH64. A bit is
    set if it is set in over half of the hashes. No text and no words: zero. Fewer words than a
    shingle: one shingle of them all.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[: n - 1])]
    last = ends[len(words) - n :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, n, COUNTED):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + COUNTED], last[i : i + COUNTED])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view("<i8")[0])


def with_fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id") -> DataFrame:
    """The ids and ``fp``, the fingerprint as BIGINT."""

    def prints(texts: list) -> list[pa.Array]:
        return [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    return append(docs, [id_column], ["text"], prints, [StructField("fp", LongType())])


def _mask(block: tuple[int, ...]) -> int:
    mask = sum(0xFF << 8 * b for b in block)
    return mask - (1 << 64) if mask >> 63 else mask


def _near(one: np.uint64, others: np.ndarray, most: int) -> np.ndarray:
    """Which of the others share enough bytes with one, and then differ in few enough bits."""
    x = np.bitwise_xor(others, one)
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    found = shared >= SHARED
    found[found] = np.bitwise_count(x[found]) <= most
    return found


def _forest(values: list[int], most: int) -> list[tuple[int, int]]:
    """Links that hold together whatever is linked among the values; fewer than the values."""
    links = []
    left = np.unique(np.array(values, dtype=np.int64)).view(np.uint64)
    front: list[np.uint64] = []
    while len(left):
        if not front:
            front, left = [left[0]], left[1:]
            continue
        one = front.pop()
        found = _near(one, left, most)
        if found.any():
            new = left[found]
            links += [(int(one.view(np.int64)), int(v)) for v in new.view(np.int64)]
            front += list(new)
            left = left[~found]
    return links


def near_links(prints: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """Links ``u``, ``v`` that join exactly the fingerprints which chains of near ones join.

    ``prints`` has distinct ``fp``. Posting lists are keyed by four positional bytes. Lists longer
    than ``CHUNK`` are split by hash, and every two parts compared in a task of their own; a task
    hands on a forest, not all pairs. Single bytes as keys would make 2,048 lists, each with one
    in 256 of all rows.
    """
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"the index holds for up to {MOST_BITS} bits")
    postings = prints.select(
        "fp",
        F.explode(
            F.array(
                *(
                    F.struct(
                        F.lit(i).alias("block"),
                        F.col("fp").bitwiseAND(F.lit(_mask(b)).cast("long")).alias("part"),
                    )
                    for i, b in enumerate(BLOCKS)
                )
            )
        ).alias("key"),
    ).select("fp", "key.block", "key.part")
    sizes = postings.groupBy("block", "part").agg(F.count("*").alias("size")).where("size > 1")
    chunks = F.ceil(F.col("size") / CHUNK)
    own = F.pmod(F.xxhash64("fp"), chunks)
    pairs = (
        postings.join(sizes, ["block", "part"])
        .select("fp", "block", "part", own.alias("own"), chunks.alias("chunks"))
        .select(
            "fp",
            "block",
            "part",
            "own",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"),
        )
        .groupBy(
            "block",
            "part",
            F.least("own", "other").alias("a"),
            F.greatest("own", "other").alias("b"),
        )
        .agg(F.collect_list("fp").alias("fps"))
        .where(F.size("fps") > 1)
    )

    def forests(parts):
        for (lists,) in parts:
            links = [link for fps in lists for link in _forest(fps, most)]
            yield [
                pa.array([u for u, _ in links], pa.int64()),
                pa.array([v for _, v in links], pa.int64()),
            ]

    schema = StructType([StructField("u", LongType()), StructField("v", LongType())])
    return emit(pairs, ["fps"], forests, schema)


def _classes(prints: DataFrame, most: int, id_column: str) -> DataFrame:
    """``fp``, ``least_id`` of its rows, and ``root``, the same for all fingerprints in reach."""
    distinct = durable(prints.groupBy("fp").agg(F.min(id_column).alias("least_id")))
    roots = components(near_links(distinct.select("fp"), most))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame, shingle: int = 3, most: int = MOST_BITS, id_column: str = "doc_id"
) -> DataFrame:
    """The id, ``fingerprint`` in hexadecimal and ``component_id``, the least id in reach.

    A row for each row of ``docs``, repeated rows too. Texts without words have fingerprint zero
    and are linked like others. A NULL id is no one's component unless all in reach are NULL. Other
    columns are ignored; an empty table gives an empty result. Copies are one fingerprint, so a
    group of copies of any size costs one entry in the index.
    """
    prints = durable(with_fingerprints(docs, shingle, id_column))
    classes = _classes(prints, most, id_column)
    least = classes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = classes.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        F.col(id_column),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def kept_documents(docs: DataFrame, shingle: int = 3, most: int = MOST_BITS) -> DataFrame:
    """One row of each component, the one with the least ``doc_id``, with the columns of ``docs``.

    Of repeated rows one stays; of a component without ids any one. The fingerprints are computed
    once to find the components and again to pick the rows, which are shuffled once, by
    fingerprint and id, so that copies of one text are spread.
    """
    classes = _classes(durable(with_fingerprints(docs, shingle)), most, "doc_id")
    first = F.min(F.struct(F.col("least_id").isNull(), "least_id", "fp")).alias("first")
    chosen = classes.groupBy("root").agg(first).select(
        F.col("first.fp").alias("__fp"),
        F.coalesce(F.col("first.least_id").cast("string"), F.lit("")).alias("__id"),
    )

    def prints(texts: list) -> list[pa.Array]:
        return [pa.array([fingerprint(t, shingle) for t in texts], pa.int64())]

    rows = append(docs, docs.columns, ["text"], prints, [StructField("__fp", LongType())])
    own = F.coalesce(F.col("`doc_id`").cast("string"), F.lit(""))
    one = Window.partitionBy("__fp", "__id").orderBy(F.xxhash64("`text`"))
    return (
        rows.withColumn("__id", own)
        .join(chosen, ["__fp", "__id"])
        .withColumn("__n", F.row_number().over(one))
        .where("__n = 1")
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )
