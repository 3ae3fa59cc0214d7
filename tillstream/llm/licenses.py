"""License statements in texts: fixed phrases, and a set-similarity join with templates."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import durable

#: The base phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Statements by which licenses are granted, with their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "licensed under the gnu general public license version 3 or later"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("gpl-2", "licensed under the gnu general public license version 2 or later"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl-3", "licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "licensed under cc by nd 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
#: Share of a template's words that a block or a run of words must hold.
THRESHOLD = 0.8

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Blocks are lines, and the sentences of a line.
_BLOCK = r"\n|(?<=[.!?;])\s+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _base(low: Column) -> Column:
    """For each phrase ``n``, ``first``, ``last`` and its label; nothing where no phrase can be."""
    joined = F.concat(
        F.lit(" "), F.array_join(F.regexp_extract_all(low, F.lit(_WORD), 0), " "), F.lit(" ")
    )

    def of(norm: Column) -> Column:
        found = []
        for phrase, label in PHRASES.items():
            parts = F.split(norm, f"(?<= ){phrase}(?= )", -1)
            n = F.size(parts) - 1
            words = _spaces(norm) - 1
            first = _spaces(F.get(parts, F.lit(0))) - 1
            last = words - (_spaces(F.get(parts, n)) - 1) - len(phrase.split())
            found.append(
                F.struct(
                    n.cast("long").alias("n"),
                    first.cast("long").alias("first"),
                    last.cast("long").alias("last"),
                    F.lit(label).alias("label"),
                )
            )
        return F.filter(F.array(*found), lambda f: f["n"] > 0)

    nothing = F.array().cast("array<struct<n:bigint,first:bigint,last:bigint,label:string>>")
    norms = F.when(
        low.contains("license") | low.contains("cc"), F.array(joined)
    ).otherwise(F.array().cast("array<string>"))
    return F.coalesce(F.get(F.transform(norms, of), F.lit(0)), nothing)


def _low(docs: DataFrame) -> Column:
    return F.translate(F.coalesce(F.col("text"), F.lit("")), _UPPER, _LOWER)


def _template_words(templates: list[tuple[str, str]]) -> list[str]:
    return sorted({w for _, text in templates for w in text.split()})


def global_order(docs: DataFrame, words: list[str]) -> list[str]:
    """The words from the rarest on, by the number of documents that hold them.

    All documents are counted; a row for each of the given words comes to the driver.
    """
    held = F.array_intersect(
        F.regexp_extract_all(_low(docs), F.lit(_WORD), 0), F.array(*map(F.lit, words))
    )
    counts = docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()
    times = {r["word"]: r["count"] for r in counts}
    return sorted(words, key=lambda w: (times.get(w, 0), w))


def _surroundings(low: Column, hinted: Column, prefixes: list[str], longest: int) -> Column:
    """Each place of a rare word, with the words around it that a run through it may have."""

    def of(words: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, i).isin(prefixes)
        )

        def around(i: Column) -> Column:
            first = F.greatest(i - (longest - 1), F.lit(0))
            return F.struct(
                i.alias("at"),
                first.alias("first"),
                F.slice(words, first + 1, i - first + longest).alias("near"),
            )

        return F.transform(places, around)

    texts = F.when(hinted, F.array(F.regexp_extract_all(low, F.lit(_WORD), 0)))
    nothing = F.array().cast("array<struct<at:int,first:int,near:array<string>>>")
    return F.coalesce(F.get(F.transform(texts, of), F.lit(0)), nothing)


def _in_runs(found: DataFrame, index: DataFrame) -> DataFrame:
    """``uid, label, share, held`` of the templates that stand in runs of words and are kept.

    Around each rare word the run with most of a template's words counts, of these the shortest,
    then the first.
    """

    def runs(near, first, at, words, run):
        def of(a):
            part = F.slice(near, a - first + 1, run)
            held = F.array_intersect("words", part)
            return F.struct(
                F.size(held).alias("shared"),
                a.alias("a"),
                F.transform(held, lambda w: (a - 1 + F.array_position(part, w)).cast("int")).alias("at"),
                held.alias("held"),
            )

        def ranked(r):
            return F.struct(
                r["shared"].alias("shared"),
                (r["a"] - F.array_max(r["at"])).alias("span"),
                (-r["a"]).alias("from"),
                r["at"].alias("at"),
                r["held"].alias("held"),
            )

        starts = F.sequence(F.greatest(first, at - run + 1), at)
        return F.array_max(F.transform(F.transform(starts, of), ranked))

    places = (
        found.select("uid", F.explode("near").alias("n"))
        .select("uid", "n.*", F.get("n.near", F.col("n.at") - F.col("n.first")).alias("word"))
        .join(index, "word")
        .where(F.size(F.array_intersect("words", "near")) >= F.col("need"))
        .withColumn("r", runs(*map(F.col, ("near", "first", "at", "words", "run"))))
        .where(F.col("r.shared") >= F.col("need"))
        .select(
            "uid",
            "template",
            "label",
            (F.col("r.shared") / F.size("words")).alias("share"),
            F.size("words").alias("size"),
            F.array_min("r.at").alias("a"),
            F.array_max("r.at").alias("b"),
            (F.size("words") - F.col("r.shared")).alias("lacks"),
            F.col("r.at").alias("at"),
            F.col("r.held").alias("held"),
        )
        .dropDuplicates(["uid", "template", "a", "b"])
    )
    # Runs that overlap, also by way of others, are judged together.
    before = Window.partitionBy("uid").orderBy("a", "b", "template")
    reach = F.max("b").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("a") <= F.col("reach"), 0).otherwise(1)
    match = F.struct("share", "size", "label", "a", "b", "lacks", "at", "held")

    def keep(kept, m):
        own = F.size(
            F.filter(m["at"], lambda x: ~F.exists(kept, lambda k: x.between(k["a"], k["b"])))
        )
        stands = (own == F.size(m["at"])) | (own > m["lacks"])
        return F.when(stands, F.concat(kept, F.array(m))).otherwise(kept)

    return (
        places.withColumn("reach", reach)
        .withColumn("group", F.sum(opens).over(before))
        .groupBy("uid", "group")
        .agg(F.sort_array(F.collect_list(match), asc=False).alias("m"))
        .select("uid", F.explode(F.aggregate("m", F.slice("m", 1, 0), keep)).alias("m"))
        .select("uid", "m.label", "m.share", "m.held")
    )


def _in_blocks(
    found: DataFrame, index: DataFrame, prefixes: set[str], in_runs: DataFrame
) -> DataFrame:
    """``uid, label, share`` of the templates whose words are scattered over a block.

    What is kept is judged as for runs, by words instead of places; the runs within the block come
    before it.
    """
    shared = F.array_intersect("held", "words")
    pairs = (
        found.select("uid", F.posexplode("blocks").alias("block", "held"))
        .select("uid", "block", "held", F.posexplode("held").alias("j", "word"))
        .where(F.col("word").isin(sorted(prefixes)))
        .join(index, "word")
        .where(F.size("held") >= F.col("need"))
        .where(
            F.col("i") + 1 + F.least(F.size("words") - F.col("i"), F.size("held") - F.col("j")) - 1
            >= F.col("need")
        )
        .withColumn("shared", shared)
        .where(F.size("shared") >= F.col("need"))
    )
    size = F.size("words")
    match = F.struct(
        (F.size("shared") / size).alias("share"),
        size.alias("size"),
        "label",
        (size - F.size("shared")).alias("lacks"),
        "shared",
    )
    runs = in_runs.groupBy("uid").agg(F.collect_set(F.struct("label", "held")).alias("runs"))
    within = F.filter(
        F.coalesce("runs", F.array().cast("array<struct<label:string,held:array<string>>>")),
        lambda r: F.size(F.array_except(r["held"], F.col("held"))) == 0,
    )
    start = F.struct(
        F.flatten(F.transform("within", lambda r: r["held"])).alias("words"),
        F.transform("within", lambda r: r["label"]).alias("labels"),
        F.lit(0.0).alias("share"),
    )

    def keep(kept, m):
        own = F.size(F.array_except(m["shared"], kept["words"]))
        stands = (own == F.size(m["shared"])) | (own > m["lacks"])
        stands = stands | F.array_contains(kept["labels"], m["label"])
        more = F.struct(
            F.concat(kept["words"], m["shared"]).alias("words"),
            F.concat(kept["labels"], F.array(m["label"])).alias("labels"),
            F.greatest(kept["share"], m["share"]).alias("share"),
        )
        return F.when(stands, more).otherwise(kept)

    return (
        pairs.groupBy("uid", "block")
        .agg(F.first("held").alias("held"), F.sort_array(F.collect_set(match), asc=False).alias("m"))
        .join(runs, "uid", "left")
        .withColumn("within", within)
        .select("uid", F.aggregate("m", start, keep).alias("kept"))
        .select("uid", F.explode("kept.labels").alias("label"), F.col("kept.share").alias("share"))
    )


def licenses(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row.

    The method's labels are those of the templates, ``threshold`` of whose distinct words stand in
    one run of words, at most ``1 / threshold`` times as long as the template, wherever lines and
    sentences end, or in one block, a line or sentence of any length. ``score`` is the largest share
    contained, 1 with a base phrase, 0 without a label. A NULL text has no words and no labels,
    which are empty strings; first and last word are NULL without a base phrase. Repeated rows get a
    row each; a NULL ``doc_id`` is carried along; other columns are ignored; an empty table gives an
    empty result.

    Words are ordered by their frequency over all documents. A run or block that holds a template
    well enough holds one of its ``size - need + 1`` rarest words, so only the surroundings of these
    are looked at; they are joined with the templates by word, and pass a bound on their common
    words before runs are compared. The table of templates is a parameter, not data, and is small
    enough to broadcast.
    """
    spark = docs.sparkSession
    order = global_order(docs, _template_words(templates))
    place = {w: i for i, w in enumerate(order)}
    prefixes, rows, longest = set(), [], 0
    for number, (label, text) in enumerate(templates):
        words = sorted(set(text.split()), key=place.__getitem__)
        need = math.ceil(threshold * len(words) - 1e-9)
        prefix = words[: len(words) - need + 1]
        prefixes.update(prefix)
        run = math.ceil(len(text.split()) / threshold)
        longest = max(longest, run)
        rows += [(w, i, number, label, words, need, run) for i, w in enumerate(prefix)]
    index = F.broadcast(
        spark.createDataFrame(
            rows,
            "word string, i int, template int, label string, words array<string>, need int, run int",
        )
    )
    vocabulary = F.array(*map(F.lit, order))
    rare = F.array(*map(F.lit, sorted(prefixes)))

    low = F.col("__low")
    hint = "|".join(sorted(prefixes))
    hinted = low.rlike(rf"(?<![a-z0-9])(?:{hint})(?![a-z0-9])")
    blocks = F.filter(
        F.transform(
            F.when(hinted, F.split(low, _BLOCK, -1)).otherwise(F.array().cast("array<string>")),
            # The block's words that any template has, rarest first.
            lambda b: F.array_intersect(vocabulary, F.regexp_extract_all(b, F.lit(_WORD), 0)),
        ),
        lambda words: F.arrays_overlap(words, rare),
    )
    found = durable(
        docs.select("doc_id", _low(docs).alias("__low")).select(
            F.monotonically_increasing_id().alias("uid"),
            "doc_id",
            F.regexp_count("__low", F.lit(_WORD)).cast("long").alias("n_words"),
            _base(low).alias("base"),
            blocks.alias("blocks"),
            _surroundings(low, hinted, sorted(prefixes), longest).alias("near"),
        )
    )
    in_runs = durable(_in_runs(found, index))
    in_blocks = _in_blocks(found, index, prefixes, in_runs)
    matched = (
        in_runs.select("uid", "label", "share")
        .unionByName(in_blocks)
        .groupBy("uid")
        .agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    )
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    more = F.coalesce("more", F.array().cast("array<string>"))
    has_base = F.size("base") > 0
    return found.join(matched, "uid", "left").select(
        "doc_id",
        "n_words",
        F.aggregate("base", F.lit(0).cast("long"), lambda n, b: n + b["n"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base_labels, more)), ",").alias("labels"),
        F.when(has_base, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
