"""Conversations damaged and repaired: the cheapest edits to a well-formed order of roles.

A row shows one of nine symbols: it must go, or it has the role system, user, assistant or another
and is whole or truncated. What went before is one of four states: nothing, system, user or
assistant. A symbol is then a matrix of four by four least costs, and equal consecutive symbols
are a power of it in the min-plus algebra.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillstream.llm.common import found_by_workers

#: What is done to a row, by the remainder of its checksum.
DROPPED, EMPTIED, UNPUNCTUATED, REPEATED, AS_USER, KINDS = 0, 1, 2, 3, 4, 20
#: Costs of edits; an undeleted truncated row adds one more.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: White space, as the contracts see it.
SPACES = "\t\n\x0b\x0c\r "
#: Rows of a run whose costs are held at once while its edits are read off.
UNROLLED = 4096
#: Short conversations whose edits a worker remembers, and the most symbols of one.
REMEMBERED, SHORT = 50_000, 64

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEVER = 1 << 60
#: The state after a user or assistant turn that may follow a state.
TURN = (USER, USER, ASSISTANT, USER)
#: Least cost from a state after the last row to an end.
END = (0, 2 * INSERT, INSERT, 0)
#: The symbol of a row that must go; others are 1 + 2 * class + truncated.
GONE = 0


def _kept(state: int, role: int) -> int | None:
    """The state after a row is kept, if it may be. Roles: system, user, assistant, another."""
    if role == 0:
        return SYSTEM if state == NOTHING else None
    return TURN[state] if role < 3 and TURN[state] == role + 1 else None


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of what may be done to a row, by letter."""
    edits = [("D", DELETE, state)]
    if symbol != GONE:
        role, cut = divmod(symbol - 1, 2)
        kept = _kept(state, role)
        if kept is not None:
            edits.append(("K", TRUNCATED * cut, kept))
        edits.append(("R", RENAME + TRUNCATED * cut, TURN[state]))
    return edits


def _times(a: tuple, b: tuple) -> tuple:
    """The min-plus product of two matrices."""
    return tuple(
        tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4)
    )


def _apply(a: tuple, v: tuple) -> tuple:
    return tuple(min(row[k] + v[k] for k in range(4)) for row in a)


@cache
def _power(symbol: int, k: int) -> tuple:
    """Least costs over 2**k rows of a symbol, with insertions before each."""
    if k:
        half = _power(symbol, k - 1)
        return _times(half, half)
    out = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        at = state
        for inserted in range(3):
            for _, cost, after in _edits(symbol, at):
                out[state][after] = min(out[state][after], inserted * INSERT + cost)
            at = TURN[at]
    return tuple(map(tuple, out))


def _advance(symbol: int, n: int, v: tuple) -> tuple:
    """The costs from before ``n`` rows of a symbol, from those after them."""
    k = 0
    while n:
        if n & 1:
            v = _apply(_power(symbol, k), v)
        n >>= 1
        k += 1
    return v


def _unroll(symbol: int, n: int, end: tuple, state: int, letters: list[str]) -> int:
    """Adds the letters of ``n`` rows of a symbol to a list, and gives the state after them."""
    while n:
        block = min(n, UNROLLED)
        costs = [_advance(symbol, n - block, end)]
        for _ in range(block):
            costs.append(_apply(_power(symbol, 0), costs[-1]))
        for after, before in zip(costs[-2::-1], costs[:0:-1]):
            while True:
                options = _edits(symbol, state)
                options.insert(1, ("I", INSERT, TURN[state]))
                letter, follows = next(
                    (a, s) for a, c, s in options
                    if c + (before if a == "I" else after)[s] == before[state]
                )
                letters.append(letter)
                state = follows
                if letter != "I":
                    break
        n -= block
    return state


class Runs:
    """Symbols, equal consecutive ones collapsed."""

    def __init__(self):
        self.symbols, self.counts = array("B"), array("q")

    def add(self, symbol: int) -> None:
        if self.symbols and self.symbols[-1] == symbol:
            self.counts[-1] += 1
        else:
            self.symbols.append(symbol)
            self.counts.append(1)

    def solve(self) -> tuple[int, str]:
        """The least cost, and of the cheapest edits the least letters."""
        ends = [END]
        for symbol, n in zip(reversed(self.symbols), reversed(self.counts)):
            ends.append(_advance(symbol, n, ends[-1]))
        cost, state, letters = ends.pop()[NOTHING], NOTHING, []
        for symbol, n in zip(self.symbols, self.counts):
            state = _unroll(symbol, n, ends.pop(), state, letters)
        while END[state]:
            letters.append("I")
            state = TURN[state]
        return cost, "".join(letters)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage that depends on ``conv_id`` and ``turn`` alone,
    and ``dropped``: rows that are gone, kept here so that no conversation is lost.

    NULL roles and texts become one space, as do NULLs in the checksum.
    """

    def shown(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % KINDS
    rows = conversations.select("conv_id", "turn", kind.alias("kind"), shown("role").alias("role"), shown("text").alias("text"))
    copies = F.when(F.col("kind") == REPEATED, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("kind") == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == EMPTIED, "")
        .when(F.col("kind") == UNPUNCTUATED, F.translate("text", ".!?", ""))
        .otherwise(F.col("text")).alias("text"),
        (F.col("kind") == DROPPED).alias("dropped"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _same() -> Column:
    """What two rows of one role and text share. It also orders rows of one turn."""
    return F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))


def _symbol() -> Column:
    ended = F.rtrim(F.col("text"), F.lit(SPACES))
    role = F.coalesce(
        *(F.when(F.startswith("role", F.lit(c)), i) for i, c in enumerate("sua")), F.lit(3)
    )
    cut = ~F.right(ended, F.lit(1)).isin(".", "!", "?")
    return F.when(ended == "", GONE).otherwise(1 + 2 * role + cut.cast("int"))


#: Legal neighbours, by class of role.
_LEGAL = {(0, 1), (1, 2), (2, 1)}
_FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


class _Conversation:
    """What is counted of one conversation while its rows go by, in order of turn."""

    def __init__(self):
        self.runs = Runs()
        self.least = self.most = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, symbol: int, role: int, again: bool) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        self.illegal += self.last is not None and (self.last, role) not in _LEGAL
        self.last = role
        if symbol == GONE:
            self.blank += 1
        elif again:
            self.duplicate += 1
            symbol = GONE
        else:
            self.truncated += (symbol - 1) % 2
        self.runs.add(symbol)

    def result(self, memo: dict) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        runs = self.runs
        if len(runs.symbols) <= SHORT:
            key = (bytes(runs.symbols), runs.counts.tobytes())
            if key not in memo:
                if len(memo) >= REMEMBERED:
                    memo.clear()
                memo[key] = runs.solve()
            cost, audit = memo[key]
        else:
            cost, audit = runs.solve()
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id``, the counts of faults, ``cost`` and ``audit``, from rows as ``damaged`` gives.

    Only a symbol, a digest and the turn of a row are shuffled. A conversation's rows stream
    through a task in order; it holds one symbol and count a run, and the audit.
    """
    role = F.coalesce(
        *(F.when(F.startswith("role", F.lit(c)), i) for i, c in enumerate("sua")), F.lit(3)
    )
    narrow = rows.select(
        "conv_id", "turn", "dropped",
        F.when(~F.col("dropped"), _same()).alias("same"),
        _symbol().alias("symbol"), role.alias("role"),
    ).repartition("conv_id")
    earlier = Window.partitionBy("conv_id", "same").orderBy(F.col("turn").asc_nulls_first())
    marked = narrow.withColumn("again", F.row_number().over(earlier) > 1).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "same"
    )
    names = ["conv_id", *_FIELDS, "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, results, memo = [], [], {}
        current, open_ = None, None

        def out() -> pa.RecordBatch:
            columns = list(zip(*results)) or [()] * (len(names) - 1)
            arrays = [pa.array(ids, id_type)]
            arrays += [pa.array(c, pa.int64()) for c in columns[:-1]]
            arrays.append(pa.array(columns[-1], pa.string()))
            ids.clear()
            results.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "symbol", "role", "again", "dropped")]
            for conv, turn, symbol, role, again, dropped in zip(*columns):
                if open_ is None or conv != current:
                    if open_ is not None:
                        ids.append(current)
                        results.append(open_.result(memo))
                    current, open_ = conv, _Conversation()
                if not dropped:
                    open_.add(turn, symbol, role, again)
            if len(ids) >= 1000:
                yield out()
        if open_ is not None:
            ids.append(current)
            results.append(open_.result(memo))
            yield out()

    found_by_workers(rows)
    schema = StructType(
        [rows.schema["conv_id"], *(StructField(f, LongType()) for f in _FIELDS), StructField("audit", StringType())]
    )
    return marked.mapInArrow(run, schema)


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Of audits, each followed by its rows: the audit's row, then ``(role, text)`` of each repaired
    turn, then ``None``."""
    letters, at, state = "", 0, NOTHING

    def inserted():
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            at, state = at + 1, TURN[state]
            yield "user" if state == USER else "assistant", ""

    started = False
    for row in rows:
        *result, audit, role, text = row
        if audit is not None:
            if started:
                yield from inserted()
                yield None
            started, letters, at, state = True, audit, 0, NOTHING
            yield (*result, audit)
            continue
        yield from inserted()
        letter = letters[at]
        at += 1
        if letter == "R":
            state = TURN[state]
            yield "user" if state == USER else "assistant", text
        elif letter == "K":
            state = SYSTEM if role.startswith("s") else TURN[state]
            yield role, text
    if started:
        yield from inserted()
        yield None


def _with_audits(rows: DataFrame) -> DataFrame:
    """Each conversation's audit and after it its rows, in order, in one partition."""
    found = audits(rows)
    texts = rows.where(~F.col("dropped")).select(
        "conv_id", "turn", _same().alias("same"), F.lit(1).alias("place"), "role", "text"
    )
    return (
        found.withColumn("place", F.lit(0))
        .unionByName(texts, allowMissingColumns=True)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "place", F.col("turn").asc_nulls_first(), "same")
        .select("conv_id", *_FIELDS, "audit", "role", "text")
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the turns of each repaired conversation, from 0."""
    names = ["conv_id", "position", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, n = [], None, 0
        for item in _edited(_rows(batches)):
            if item is None:
                continue
            if len(item) > 2:
                conv, n = item[0], 0
                continue
            out.append((conv, n, *item))
            n += 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    found_by_workers(rows)
    id_type = pa.int64() if isinstance(rows.schema["conv_id"].dataType, LongType) else None
    types = (id_type, pa.int64(), pa.string(), pa.string())
    schema = StructType(
        [rows.schema["conv_id"], StructField("position", LongType()), StructField("role", StringType()), StructField("text", StringType())]
    )
    return _with_audits(rows).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` for each
    conversation of rows as ``damaged`` gives them: ``conv_id, turn, role, text, dropped``.

    Rows stand in order of turn, NULL turns first, equal turns by a digest of role and text, so
    repeated rows are neighbours. A NULL ``conv_id`` is a conversation too. An empty role counts as
    none of the three. Conversations of which every row was dropped have zeros, an empty audit and
    the hash of an empty text; an empty table gives an empty result; other columns are ignored,
    whatever their names. Very long texts are shuffled once and hashed as they stream by. The hash
    of a conversation and its audit are one value each, so its rows meet in one task; that task
    holds one row's text, one count a run and the audit, never the conversation.
    """
    names = ["conv_id", *_FIELDS, "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, result, digest, first = [], None, None, True

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for item in _edited(_rows(batches)):
            if item is None:
                out.append((*result, digest.hexdigest()))
                if len(out) >= 1000:
                    yield batch()
                    out = []
            elif len(item) > 2:
                result, digest, first = item, hashlib.sha256(), True
            else:
                digest.update(("" if first else "\n").encode() + f"{item[0]}:{item[1]}".encode())
                first = False
        if out:
            yield batch()

    found_by_workers(rows)
    id_type = pa.int64() if isinstance(rows.schema["conv_id"].dataType, LongType) else None
    types = (id_type, *[pa.int64()] * len(_FIELDS), pa.string(), pa.string())
    schema = StructType(
        [rows.schema["conv_id"], *(StructField(f, LongType()) for f in _FIELDS)]
        + [StructField("audit", StringType()), StructField("repaired_sha256", StringType())]
    )
    return _with_audits(rows).mapInArrow(run, schema)
