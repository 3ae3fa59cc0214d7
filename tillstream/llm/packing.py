"""Packing token sequences into as few bins as can be, by bin completion over lengths."""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Tokenizer, pre_tokenizers

from tillstream.llm.common import Memo, append, durable

CAPACITY = 2048
#: Fillings that are sought around one largest piece, steps of that search, and nodes altogether.
FILLINGS, STEPS, NODES = 12, 240, 3_000
#: Nodes from one best fit of the rest to the next.
REFIT = 100
#: Rows of one length that are numbered together.
NUMBERED = 50_000
#: Words whose ids a worker remembers.
REMEMBERED = 200_000

#: A character other than white space, ASCII, and letters of which lower case and normal form are
#: one character each.
_UNUSUAL = re.compile(r"[^\t\n\r -~À-ÖØ-öø-ÿ]")
#: Texts that tell whether a tokeniser cuts as is taken for granted below.
_PROBES = [
    "It's 3.14, we'll (say) \"a-b\" x2y... don't AB,cd. they're 1,000 #tags! plain words only",
    "naïve\u00a0text in 漢字 and Ελληνικά, mixed3 with ascii's\tand\n\nlines",
]
#: What the tokeniser parts from letters, in its order of trial.
_PARTED = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[0-9]|[!-/:-@\[-`{-~]+")
#: Texts without these hold no parted runs but single commas and full stops.
_MORE = re.compile(rb"[.,]{2}|[!-+/:-@\[-`{-~0-9-]")


def _runs(text: str) -> list[bytes]:
    """The runs that the tokeniser would take from a text of usual characters."""
    low = text.lower().encode()
    if _MORE.search(low):
        return _PARTED.sub(rb" \g<0> ", low).split()
    return low.replace(b",", b" , ").replace(b".", b" . ").split()


class WordIds:
    """Token ids of the vocabulary, remembered for each run of letters or punctuation.

    Texts of usual characters are cut as the tokeniser cuts them, and the runs go to its model.
    In others the words between white space, which the tokeniser never joins, go to the tokeniser
    itself; a text with a special token goes there whole. What is remembered is bounded and only
    saves time. A vocabulary whose tokeniser cuts some of ``_PROBES`` otherwise gets all texts whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.CharDelimiterSplit(" "),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.special = tuple(
            t.content for t in self.whole.get_added_tokens_decoder().values()
        )
        self.runs = Memo(self._learn_runs, REMEMBERED)
        self.words = Memo(self._learn_words, REMEMBERED // 8)
        self.alike = True
        self.alike = self._cuts_alike()

    def _cuts_alike(self) -> bool:
        if not self.ends.any():
            return False
        whole = [self.whole.encode(t, add_special_tokens=False).ids for t in _PROBES]
        try:
            return self.encode(_PROBES) == [np.array(ids, dtype="<u4").tobytes() for ids in whole]
        except KeyError:  # A run that did not end in a token that ends words.
            return False

    def _learn_runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """Ids of runs, a hundred in one call. The last token of each ends it."""
        found = {}
        groups = [runs[i : i + 100] for i in range(0, len(runs), 100)]
        encoded = self.letters.encode_batch_fast(
            [b" ".join(g).decode() for g in groups], add_special_tokens=False
        )
        for group, e in zip(groups, encoded):
            ids = np.array(e.ids, dtype="<u4")
            data = ids.tobytes()
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            found.update((r, data[a:b]) for r, a, b in zip(group, [0, *cuts], cuts))
        return found

    def _learn_words(self, words: list[bytes]) -> dict[bytes, bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        encoded = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return {w: np.array(e.ids, dtype="<u4").tobytes() for w, e in zip(words, encoded)}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian numbers of four bytes."""
        encoded: list[bytes] = [b""] * len(texts)
        usual: dict[int, list[bytes]] = {}
        unusual: dict[int, list[bytes]] = {}
        for i, text in enumerate(texts):
            if not text:
                continue
            if not self.alike or any(s in text for s in self.special):
                ids = self.whole.encode(text, add_special_tokens=False).ids
                encoded[i] = np.array(ids, dtype="<u4").tobytes()
            elif _UNUSUAL.search(text):
                unusual[i] = text.encode("utf-8", "surrogatepass").split()
            else:
                usual[i] = _runs(text)
        for units, memo in ((usual, self.runs), (unusual, self.words)):
            known = memo.of(set(chain.from_iterable(units.values())))
            for i, parts in units.items():
                encoded[i] = b"".join(map(known.__getitem__, parts))
        return encoded


@lru_cache(maxsize=2)
def _word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length`` and ``ids_crc32`` of every piece.

    A document is its ids and one id 0. Only longer ones than ``capacity`` are cut.
    """

    def cut(texts):
        model = _word_ids(vocabulary)
        rows = []
        for data in model.encode(texts):
            data += b"\0\0\0\0"
            step = 4 * capacity
            rows.append(
                [
                    {
                        "piece": k,
                        "start": k * capacity,
                        "length": min(step, len(data) - i) // 4,
                        "ids_crc32": zlib.crc32(data[i : i + step]),
                    }
                    for k, i in enumerate(range(0, len(data), step))
                ]
            )
        kind = pa.struct(
            [
                ("piece", pa.int32()),
                ("start", pa.int64()),
                ("length", pa.int64()),
                ("ids_crc32", pa.int64()),
            ]
        )
        return [pa.array(rows, pa.list_(kind))]

    field = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
    cut_up = append(docs, ["doc_id"], ["text"], cut, _fields(f"p {field}"))
    return cut_up.select("doc_id", F.inline("p"))


def _fields(ddl: str) -> list[StructField]:
    return list(StructType.fromDDL(ddl))


@dataclass
class Filling:
    """Lengths that share a bin, longest first, and how many bins are filled so."""

    lengths: tuple[int, ...]
    bins: int


class Left:
    """How many pieces of each length are left; the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {n: c for n, c in counts.items() if c}
        self.order = sorted(self.counts)

    def copy(self) -> Left:
        new = Left({})
        new.counts, new.order = dict(self.counts), list(self.order)
        return new

    def total(self) -> int:
        return sum(n * c for n, c in self.counts.items())

    def fitting(self, room: int, used: Counter) -> int | None:
        """The longest length up to ``room`` of which a piece is left beside those used."""
        i = bisect_right(self.order, room) - 1
        while i >= 0:
            n = self.order[i]
            if self.counts[n] > used[n]:
                return n
            i -= 1
        return None

    def alike(self, lengths: tuple[int, ...]) -> int:
        """How many bins the counts allow to be filled this way."""
        return min(self.counts[n] // k for n, k in Counter(lengths).items())

    def fill(self, lengths: tuple[int, ...], most: int | None = None) -> Filling:
        """Fills as many bins this way as the counts allow, or ``most``, and takes the pieces out."""
        need = Counter(lengths)
        bins = most or self.alike(lengths)
        for n, k in need.items():
            self.counts[n] -= k * bins
            if not self.counts[n]:
                del self.counts[n]
                del self.order[bisect_left(self.order, n)]
        return Filling(lengths, bins)


def best_fit(left: Left, capacity: int) -> list[Filling]:
    """Best fit of all that is left, which is used up: the longest piece, then always the longest
    that fits. Alike bins are filled at once."""
    plan = []
    while left.order:
        room, lengths, used = capacity, [], Counter()
        while (n := left.fitting(room, used)) is not None:
            lengths.append(n)
            used[n] += 1
            room -= n
        plan.append(left.fill(tuple(lengths)))
    return plan


def fillings(
    left: Left, capacity: int, most_waste: int
) -> tuple[list[tuple[int, ...]], bool]:
    """Undominated fillings around the longest piece that waste at most ``most_waste``, least first,
    and whether these are all.

    A filling is dominated if another piece that is left fits on top, or one longer than one of its
    pieces fits in that one's place: the other filling leaves no harder a rest. The longest pieces
    are tried first, so the first filling met is the best fit. Where the search is cut before it has
    met an undominated one, nothing is known of the rest, and the best fit stands in.
    """
    largest = left.order[-1]
    found: list[tuple[int, tuple[int, ...]]] = []
    first: tuple[int, ...] | None = None
    steps = 0
    cut = False

    def dominated(chosen: list[int], used: Counter, room: int) -> bool:
        for c in set(chosen):
            i = bisect_right(left.order, c)
            while i < len(left.order) and left.order[i] <= c + room:
                if left.counts[left.order[i]] > used[left.order[i]]:
                    return True
                i += 1
        return False

    def search(most: int, room: int, chosen: list[int], used: Counter) -> None:
        nonlocal steps, first, cut
        n = left.fitting(min(most, room), used)
        if n is None:
            if room <= most_waste and left.fitting(room, used) is None:
                first = first or (largest, *chosen)
                if not dominated(chosen, used, room):
                    found.append((room, (largest, *chosen)))
            return
        while n is not None:
            if steps >= STEPS or len(found) >= FILLINGS:
                cut = True
                return
            steps += 1
            used[n] += 1
            search(n, room - n, [*chosen, n], used)
            used[n] -= 1
            n = left.fitting(min(n - 1, room), used)

    search(capacity, capacity - largest, [], Counter([largest]))
    if cut and not found and first:
        return [first], False
    return [lengths for _, lengths in sorted(found, key=lambda f: f[0])], not cut


def bin_completion(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[Filling]:
    """The plan of :func:`search_plan`."""
    return search_plan(counts, capacity, nodes)[0]


def search_plan(
    counts: dict[int, int], capacity: int, nodes: int = NODES
) -> tuple[list[Filling], bool]:
    """A plan for all pieces with as few bins as the search finds, and whether none has fewer.

    Branch and bound: at each node the longest piece left is completed in every undominated way,
    least waste first. A branch fills as many alike bins as the counts allow, one after these fills a
    single one, so no plan is out of reach. Best fit gives the first incumbent, and again and again
    the rest below a node. A node is pruned if its bins and the bound on its rest, total length over
    capacity rounded up, reach the incumbent. The search ends at the lower bound, when nothing is
    open, or after ``nodes`` nodes. The plan is proven least if it meets the bound, or if the search
    has ended with all nodes' fillings known (``FILLINGS`` and ``STEPS`` bound these). What it costs
    goes by the number of lengths, at most ``capacity``, not by that of pieces.
    """
    total = sum(n * c for n, c in counts.items())
    bound = -(-total // capacity)
    best = best_fit(Left(counts), capacity)
    best_bins = sum(f.bins for f in best)
    whole = True
    seen = 0
    #: An entry: what was left before its filling, the filling and its bins (None: as many as there
    #: can be), the plan before it as a linked list, its bins and rest. The last goes first.
    stack: list[tuple[Left, tuple[int, ...], int | None, tuple | None, int, int]] = []
    state: tuple[Left, tuple | None, int, int] | None = (Left(counts), None, 0, total)
    while best_bins > bound and seen < nodes and (state or stack):
        if state is None:
            before, lengths, most, plan, bins, rest = stack.pop()
            if bins + -(-rest // capacity) >= best_bins:
                continue
            left = before.copy()
            filled = left.fill(lengths, most)
            state = left, (filled, plan), bins + filled.bins, rest - filled.bins * sum(lengths)
        left, plan, bins, rest = state
        state = None
        if bins + -(-rest // capacity) >= best_bins:
            continue
        if not left.order:
            best, best_bins = _unlinked(plan), bins
            continue
        seen += 1
        if seen % REFIT == 0:
            fitted = best_fit(left.copy(), capacity)
            fitted_bins = bins + sum(f.bins for f in fitted)
            if fitted_bins < best_bins:
                best, best_bins = _unlinked(plan) + fitted, fitted_bins
        # The waste that all further bins can bear together, if the incumbent is to be beaten.
        bearable = (best_bins - 1 - bins) * capacity - rest
        ways, known = fillings(left, capacity, bearable)
        whole = whole and known
        for most in (1, None):
            for lengths in reversed(ways):
                if most is None or left.alike(lengths) > 1:
                    stack.append((left, lengths, most, plan, bins, rest))
    return best, best_bins <= bound or (whole and not stack and state is None)


def _unlinked(plan: tuple | None) -> list[Filling]:
    fillings_so_far = []
    while plan:
        fillings_so_far.append(plan[0])
        plan = plan[1]
    return fillings_so_far[::-1]


def slots(plan: list[Filling]) -> dict[int, np.ndarray]:
    """For each length, rows of first rank, first sequence and offset, by first rank.

    The k-th piece of a length, from 0, goes to the row with the last first rank up to k, and as
    many sequences further as it is beyond that. A plan has at most as many fillings as there are
    lengths plus those of the search, so this does not grow with the number of pieces.
    """
    taken: dict[int, int] = {}
    rows: dict[int, list[tuple[int, int, int]]] = {}
    sequence = 0
    for filling in plan:
        offset = 0
        for n in filling.lengths:
            rank = taken.get(n, 0)
            rows.setdefault(n, []).append((rank, sequence, offset))
            taken[n] = rank + filling.bins
            offset += n
        sequence += filling.bins
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def _ranked(rows: DataFrame) -> DataFrame:
    """Adds ``rank``, the place of a row among those of its length, from 0.

    Rows of a length are dealt to so many groups by a hash of ``uid``, their number, that a group has
    about ``NUMBERED``, also of rows that are alike in all columns; ranks are the place in the group and the sizes of the groups before, so one length may hold
    any share of the rows.
    """
    most = rows.groupBy("length").count().agg(F.max("count")).first()[0] or 0
    groups = max(1, -(-most // NUMBERED))
    dealt = rows.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = (
        dealt.groupBy("length", "group")
        .agg(F.count("*").alias("size"))
        .withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .drop("size")
    )
    place = F.row_number().over(Window.partitionBy("length", "group").orderBy("uid")) - 1
    return (
        dealt.withColumn("place", place)
        .join(sizes, ["length", "group"])
        .withColumn("rank", F.col("place") + F.col("before"))
        .drop("group", "place", "before", "uid")
    )


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, nodes: int = NODES
) -> DataFrame:
    """A row for each piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A NULL or empty text is the one id 0. Repeated rows are packed each; a NULL ``doc_id`` is
    carried along. An empty table gives an empty result. Columns beside ``doc_id`` and ``text``
    are ignored.

    Only the number of pieces of each length, at most ``capacity`` numbers, comes to the driver,
    where the search runs; the pieces are then dealt to their places by their rank among those of
    their length.
    """
    cut = pieces(docs, vocabulary, capacity)
    # The numbers are kept with the rows, so they are the same in whatever reads these.
    rows = durable(cut.withColumn("uid", F.monotonically_increasing_id()))
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}
    places = rows.sparkSession.sparkContext.broadcast(
        slots(bin_completion(counts, capacity, nodes))
    )

    def place(lengths, ranks):
        sequences, offsets = [], []
        for n, rank in zip(lengths, ranks):
            of_length = places.value[n]
            first, sequence, offset = of_length[
                np.searchsorted(of_length[:, 0], rank, side="right") - 1
            ]
            sequences.append(int(sequence + rank - first))
            offsets.append(int(offset))
        return [pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())]

    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    fields = [StructField("sequence_id", LongType()), StructField("offset", LongType())]
    return append(_ranked(rows), keep, ["length", "rank"], place, fields)
