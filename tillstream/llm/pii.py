"""Personal data by weak supervision, all in DataFrame functions."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.common import durable, span_text

#: The base kinds. Each pattern matches where the plain one in the comment does, and
#: says in front where a match can begin, so that no start is tried within a run.
BASE = {
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    # [0-9]([\x20-]?[0-9])+ of 13 to 19 digits
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}(?![\x20-]?[0-9])",
    # \+[0-9][\x20().0-9-]+[0-9]
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: First names, in lower case.
NAMES = (
    "james|mary|john|patricia|robert|jennifer|michael|linda|david|elizabeth|william|barbara|"
    "richard|susan|joseph|jessica|thomas|sarah|charles|karen|anna|maria|peter|paul|laura|"
    "hans|klaus|marie|pierre|jean|carlos|juan|jose|luis|carmen|sofia|martin|julia"
)
#: Further kinds that the labelers decide on.
MORE = {
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "local_phone": r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
    # A title or a name of the gazetteer, and a capitalised word in any letters.
    "person": (
        r"(?<!\p{L})(?:(?:Mr|Mrs|Ms|Dr)\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?"
        rf"|(?:{NAMES.title()})\x20\p{{Lu}}\p{{Ll}}++)(?!\p{{L}})"
    ),
}
KINDS = [*BASE, *MORE]

#: Code points before a span in which context labelers look.
CONTEXT = 40
#: Gazetteers and context words, in lower case.
DOMAINS = "com|org|net|edu|gov|io|info|de|fr|es|uk|eu|ch|at|it|nl"
COUNTRIES = "AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|IE|IT|LU|NL|NO|PL|PT|SE"
CUES = (
    "phone|tel|call|mobile|fax|contact|email|e-mail|mail|ssn|social|iban|account|konto|compte|"
    "cuenta|card|visa|name|address|write to|reach"
)
COUNTER_CUES = "version|isbn|issn|order|invoice|serial|page|figure|section|part|total|price|ratio"
#: Prior counts of a labeler's votes, for and against, on true and on false spans.
RIGHT, WRONG = 8.0, 2.0
EM_ROUNDS, FIT_ROUNDS = 50, 200
#: Elements of a running sum that are added up one after the other, spans that are looked through
#: together, and code points of a chunk.
BLOCK, TOGETHER, CHUNK = 64, 256, 64
LABELERS = ["shape", "gazetteer", "cue", "counter_cue", "edges"]
ABSTAIN, FOR, AGAINST = 0, 1, 2

_SPAN = "array<struct<kind:int,start:int,end:int,found:string>>"


def _bound(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, with the value worked out once even if ``of`` uses it for many elements."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _few_before(values: Column, step: Callable[[Column, Column], Column], first: Column) -> Column:
    """For each of some integers what ``step`` makes of all before it, from ``first`` on."""
    nothing = F.array().cast("array<int>")
    return F.aggregate(
        values,
        F.struct(first.alias("at"), nothing.alias("out")),
        lambda s, x: F.struct(
            step(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")
        ),
        lambda s: s["out"],
    )


def _before(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """For each of many integers what ``step``, a sum or a maximum, makes of all before it and 0.

    An array grows by copying, so it is built in blocks; that is linear in all but very long ones.
    """
    zero = F.lit(0)

    def blocks(values: Column) -> Column:
        parts = F.transform(
            F.sequence(zero, ((F.size(values) - 1) / BLOCK).cast("int")),
            lambda k: F.slice(values, k * BLOCK + 1, F.lit(BLOCK)),
        )
        return _bound(
            parts,
            lambda parts: F.flatten(
                F.zip_with(
                    parts,
                    _few_before(F.transform(parts, lambda p: F.aggregate(p, zero, step)), step, zero),
                    lambda part, first: _few_before(part, step, first),
                )
            ),
        )

    return F.when(F.size(values) > 0, _bound(values, blocks)).otherwise(F.array().cast("array<int>"))


def _spans(text: Column, matches: Column, pattern: str, kind: Column) -> Column:
    """Where the matches stand, in code points.

    What the same pattern splits the text into gives the distances between them.
    """

    def placed(m: Column) -> Column:
        both = F.arrays_zip(m["gap"], m["found"])
        ends = _before(
            F.transform(both, lambda b: b["gap"] + F.length(b["found"])), lambda x, y: x + y
        )
        return F.zip_with(
            both,
            ends,
            lambda b, at: F.struct(
                kind.alias("kind"),
                (at + b["gap"]).alias("start"),
                (at + b["gap"] + F.length(b["found"])).alias("end"),
                b["found"].alias("found"),
            ),
        )

    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pieces = F.struct(F.slice(gaps, F.lit(1), F.size(matches)).alias("gap"), matches.alias("found"))
    nothing = F.array().cast(_SPAN)
    return F.when(F.size(matches) > 0, _bound(pieces, placed)).otherwise(nothing)


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), 0)


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` of a text in chunks, without passing over others."""
    first, last = (start / CHUNK).cast("int"), (end / CHUNK).cast("int")

    def chunk(i: Column) -> Column:
        return F.coalesce(F.get(chunks, i), F.lit(""))

    head = F.substring(chunk(first), start - first * CHUNK + 1, F.least(end - start, F.lit(CHUNK)))
    between = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    tail = F.substring(chunk(last), F.lit(1), end - last * CHUNK)
    return F.when(first == last, head).otherwise(F.concat(head, between, tail))


def _apart(spans: Column, others: Column) -> Column:
    """The spans that overlap none of the others, which are looked through by blocks."""

    def crosses(s: Column, b: Column) -> Column:
        return (s["start"] < b["end"]) & (b["start"] < s["end"])

    def blocks(others: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), (F.size(others) / TOGETHER).cast("int")),
            lambda k: _bound(
                F.slice(others, k * TOGETHER + 1, F.lit(TOGETHER)),
                lambda part: F.struct(
                    F.array_min(F.transform(part, lambda b: b["start"])).alias("start"),
                    F.array_max(F.transform(part, lambda b: b["end"])).alias("end"),
                    part.alias("part"),
                ),
            ),
        )

    def free(blocks: Column) -> Column:
        return F.filter(
            spans,
            lambda s: ~F.exists(
                blocks,
                lambda k: F.when(crosses(s, k), F.exists(k["part"], lambda b: crosses(s, b))).otherwise(F.lit(False)),
            ),
        )

    by_start = F.array_sort(
        F.transform(others, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))
    )
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), _bound(_bound(by_start, blocks), free)).otherwise(spans)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(i % 2 == 1, 2 * digit).otherwise(digit)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _valid(kind: str, span: Column) -> Column:
    """The further conditions of a base kind."""
    found = span["found"]
    if kind == "ip":
        return found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return _luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(9, 15)
    return F.lit(True)


def _with_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Adds ``__base`` and ``__more``, the spans of base kinds and of further ones, to ``keep``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*(F.col(f"`{k}`") for k in keep), text.alias("__text"))
    t = F.col("__text")
    #: What a text must have for any match; most texts have no digit.
    needs = {
        "email": t.contains("@"),
        "ip": t.rlike(r"[0-9]\.[0-9]"),
        "card": t.rlike("[0-9][ -]?[0-9][ -]?[0-9]"),
        "phone": t.contains("+"),
        "national_id": t.rlike("[0-9]-[0-9]"),
        "iban": t.rlike("[A-Z]{2}[0-9]{2}"),
        "local_phone": t.rlike("[0-9]{3}[ .-][0-9]{4}"),
        "person": t.rlike(rf"(?<!\p{{L}})(?:Mr|Mrs|Ms|Dr|{NAMES.title()})\.? "),
    }
    patterns = {**BASE, **MORE}
    none = F.array().cast("array<string>")
    rows = rows.select(
        "*",
        *(
            F.when(needs[k], F.regexp_extract_all("__text", F.lit(p), 0))
            .otherwise(none)
            .alias(f"__{k}")
            for k, p in patterns.items()
        ),
    )
    spans = {
        k: _spans(t, F.col(f"__{k}"), p, F.lit(i)) for i, (k, p) in enumerate(patterns.items())
    }
    base = [F.filter(spans[k], partial(_valid, k)) for k in BASE]
    rows = rows.select(
        *(F.col(f"`{k}`") for k in keep),
        "__text",
        F.concat(*base).alias("__base"),
        F.concat(*(spans[k] for k in MORE)).alias("__found"),
    )
    return rows.withColumn("__more", _apart(F.col("__found"), F.col("__base"))).drop("__found")


def _votes(chunks: Column, span: Column) -> Column:
    """The vote of each labeler on a span: 0 abstains, 1 is for, 2 is against."""
    found, kind = span["found"], span["kind"]
    before = F.lower(_cut(chunks, F.greatest(span["start"] - CONTEXT, F.lit(0)), span["start"]))
    edge = F.concat(
        F.when(
            span["start"] > 0, _cut(chunks, F.greatest(span["start"] - 1, F.lit(0)), span["start"])
        ).otherwise(F.lit(" ")),
        F.lit("\n"),
        _cut(chunks, span["end"], span["end"] + 1),
    )
    number = {k: i for i, k in enumerate(KINDS)}

    def when(kind_name: str, condition: Column) -> Column:
        return F.when(
            kind == number[kind_name], F.when(condition, F.lit(FOR)).otherwise(F.lit(AGAINST))
        )

    shape = F.coalesce(
        when("national_id", ~found.rlike("^(?:000|666|9)|-00-|-0000$")),
        when("local_phone", found.rlike(r"^\(?[2-9][0-9]{2}\)?[ .-][2-9]")),
        when("iban", F.length(F.regexp_replace(found, " ", "")).between(15, 34)),
        when("card", _luhn(_digits(found))),
        F.when(kind < len(BASE), F.lit(FOR)),
        F.lit(ABSTAIN),
    )
    gazetteer = F.coalesce(
        when("email", found.rlike(rf"(?i)\.(?:{DOMAINS})$")),
        when("iban", found.rlike(f"^(?:{COUNTRIES})")),
        F.when((kind == number["person"]) & found.rlike(rf"(?i)\b(?:{NAMES})\b"), F.lit(FOR)),
        F.lit(ABSTAIN),
    )
    cue = F.when(before.rlike(rf"\b(?:{CUES})\b"), F.lit(FOR)).otherwise(F.lit(ABSTAIN))
    counter = F.when(before.rlike(rf"\b(?:{COUNTER_CUES})\b\W*$"), F.lit(AGAINST)).otherwise(
        F.lit(ABSTAIN)
    )
    edges = F.when(edge.rlike(r"^[\w#/=]|[\w/=]$"), F.lit(AGAINST)).otherwise(F.lit(FOR))
    return F.array(shape, gazetteer, cue, counter, edges)


def _voted(rows: DataFrame) -> DataFrame:
    """Adds ``__voted``: every span with its kind, place and votes."""

    def voted(m: Column) -> Column:
        return F.transform(
            m["spans"],
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                _votes(m["chunks"], s).alias("votes"),
            ),
        )

    spans = F.concat("__base", "__more")
    nothing = F.array().cast("array<struct<kind:int,start:int,end:int,votes:array<int>>>")
    both = F.struct(spans.alias("spans"), _chunks(F.col("__text")).alias("chunks"))
    return rows.withColumn(
        "__voted", F.when(F.size(spans) > 0, _bound(both, voted)).otherwise(nothing)
    )


@dataclass
class SpanModel:
    """A linear classifier of spans: weights of the kinds, and of each labeler's three votes."""

    kinds: list[float]
    votes: list[list[float]]

    def score(self, kind: Column, votes: Column) -> Column:
        total = F.get(F.array(*map(F.lit, self.kinds)), kind)
        for i, weights in enumerate(self.votes):
            total = total + F.get(F.array(*map(F.lit, weights)), F.get(votes, F.lit(i)))
        return total


def _posteriors(counts: dict[tuple[int, tuple[int, ...]], int]) -> dict[tuple, float]:
    """By expectation-maximisation: how likely spans of a kind with given votes are personal data.

    Labelers vote independently given the truth, each with its own rates, which the kinds share; a
    kind has its own share of true spans. Prior counts hold labelers better than chance.
    """
    n = len(LABELERS)
    right = {FOR: RIGHT, AGAINST: WRONG, ABSTAIN: RIGHT}
    wrong = {FOR: WRONG, AGAINST: RIGHT, ABSTAIN: RIGHT}
    prior = {k: 0.5 for k in range(len(KINDS))}
    rates = [
        [{v: right[v] / sum(right.values()) for v in right}, {v: wrong[v] / sum(wrong.values()) for v in wrong}]
        for _ in range(n)
    ]
    posterior: dict[tuple, float] = {}
    for _ in range(EM_ROUNDS):
        for kind, votes in counts:
            true, false = math.log(prior[kind]), math.log(1 - prior[kind])
            for i, vote in enumerate(votes):
                true += math.log(rates[i][0][vote])
                false += math.log(rates[i][1][vote])
            posterior[kind, votes] = 1 / (1 + math.exp(max(-500.0, min(500.0, false - true))))
        for kind in prior:
            true = sum(posterior[key] * c for key, c in counts.items() if key[0] == kind)
            total = sum(c for key, c in counts.items() if key[0] == kind)
            prior[kind] = (true + 1) / (total + 2)
        for i in range(n):
            tallies = [dict(right), dict(wrong)]
            for key, c in counts.items():
                tallies[0][key[1][i]] += c * posterior[key]
                tallies[1][key[1][i]] += c * (1 - posterior[key])
            rates[i] = [{v: t / sum(tally.values()) for v, t in tally.items()} for tally in tallies]
    return posterior


def _fit(counts: dict, posterior: dict) -> SpanModel:
    """Logistic regression on the posteriors, by gradient steps with a small penalty."""
    kinds = [0.0] * len(KINDS)
    votes = [[0.0, 0.0, 0.0] for _ in LABELERS]
    total = sum(counts.values()) or 1
    for _ in range(FIT_ROUNDS):
        g_kinds = [-0.001 * w for w in kinds]
        g_votes = [[-0.001 * w for w in ws] for ws in votes]
        for (kind, vote), c in counts.items():
            z = kinds[kind] + sum(votes[i][v] for i, v in enumerate(vote))
            error = (posterior[kind, vote] - 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))) * c / total
            g_kinds[kind] += error
            for i, v in enumerate(vote):
                g_votes[i][v] += error
        kinds = [w + 2.0 * g for w, g in zip(kinds, g_kinds)]
        votes = [[w + 2.0 * g for w, g in zip(ws, gs)] for ws, gs in zip(votes, g_votes)]
    return SpanModel(kinds, votes)


def train(voted: DataFrame) -> SpanModel:
    """The classifier from the votes on all spans.

    What comes to the driver is a count for each kind and combination of votes, at most
    ``8 * 3 ** 5`` rows.
    """
    rows = (
        voted.select(F.explode("__voted").alias("s"))
        .groupBy("s.kind", "s.votes")
        .agg(F.count("*").alias("n"))
        .collect()
    )
    counts = {(r["kind"], tuple(r["votes"])): r["n"] for r in rows}
    return _fit(counts, _posteriors(counts))


def _all_spans(model: SpanModel) -> Column:
    """Base spans, and those further ones that the classifier takes for personal data."""
    chosen = F.filter(
        "__voted",
        lambda s: (s["kind"] < len(BASE)) | (model.score(s["kind"], s["votes"]) >= 0),
    )
    return F.array_sort(
        F.transform(
            chosen,
            lambda s: F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        )
    )


def _text_of(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return span_text(
        F.transform(
            spans,
            lambda s: F.struct(
                F.get(kinds, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")
            ),
        )
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more`` for each row.

    Spans are in code points by kind, then start, with the end exclusive. A NULL text is an empty
    one, without spans. Repeated rows get the same result each; a NULL ``doc_id`` is carried along;
    other columns are ignored, whatever their names; an empty table gives an empty result. Very
    long texts, matches and runs of matches take time in proportion. One pass over the texts; spans
    and votes are kept in a checkpoint, the texts are not.
    """
    rows = _voted(_with_spans(docs, ["doc_id"])).select("doc_id", "__voted")
    rows = durable(rows)
    spans = rows.select("doc_id", _all_spans(train(rows)).alias("__all"))
    base = F.filter("__all", lambda s: s["kind"] < len(BASE))

    def count(i: int) -> Column:
        return F.size(F.filter("__all", lambda s: s["kind"] == i)).cast("long")

    return spans.select(
        "doc_id",
        *(count(i).alias(f"n_{k}") for i, k in enumerate(BASE)),
        F.sha2(_text_of(base), 256).alias("base_sha256"),
        _text_of(F.col("__all")).alias("spans"),
        (F.size("__all") - F.size(base)).cast("long").alias("n_more"),
    )


def masked_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind, as in ``<EMAIL>``.

    Overlapping spans become one mark, that of the first. ``n_chars``, if there is such a column,
    is that of the new text; a NULL text stays NULL, an empty one empty, and repeated rows stay as
    many. Very long texts take time in proportion. The texts are read twice, once to train the
    classifier and once to mask them, and never shuffled. Columns may have any names.
    """
    model = train(durable(_voted(_with_spans(docs, [])).select("__voted")))
    # The columns are kept apart from those that are made here, so no name clashes.
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row")
    rows = _voted(_with_spans(docs.select(whole, F.col("`text`").alias("text")), ["__row"]))
    marks = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))
    by_place = F.array_sort(
        F.transform(
            _all_spans(model),
            lambda s: F.struct(
                s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")
            ),
        )
    )
    text = F.col("__text")

    def join(m: Column) -> Column:
        """Each span that no earlier one reaches, after the text since the end of those."""
        done = _before(F.transform(m["spans"], lambda s: s["end"]), lambda x, y: F.greatest(x, y))
        pieces = F.zip_with(
            m["spans"],
            done,
            lambda s, at: F.when(
                s["start"] >= at, F.concat(_cut(m["chunks"], at, s["start"]), F.get(marks, s["kind"]))
            ).otherwise(F.lit("")),
        )
        last = F.array_max(F.transform(m["spans"], lambda s: s["end"]))
        return F.concat(F.array_join(pieces, ""), _cut(m["chunks"], last, m["size"]))

    parts = F.struct(
        by_place.alias("spans"), _chunks(text).alias("chunks"), F.length(text).alias("size")
    )
    masked = _bound(parts, lambda m: F.when(F.size(m["spans"]) > 0, join(m)).otherwise(text))
    masked = F.when(F.col("__row")["text"].isNotNull(), masked)
    rows = rows.select("__row", masked.alias("__masked"))
    columns = {c: F.col("__row")[c] for c in docs.columns}
    columns["text"] = F.col("__masked")
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        columns["n_chars"] = F.length("__masked").cast(kind)
    return rows.select(*(c.alias(n) for n, c in columns.items()))
