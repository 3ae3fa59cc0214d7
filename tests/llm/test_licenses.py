"""License statements that are wrapped over lines, and several of them in one line."""

import re

import pytest

from tests.llm import plain
from tillstream.llm import licenses

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License."""
NOTICES = {"mit": MIT, "bsd": BSD, "gpl": GPL}


def labelled(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licenses.licenses(docs).collect()
    return [(r["labels"], round(r["score"], 9)) for r in sorted(rows, key=lambda r: r["doc_id"])]


def best_run(text):
    """Every run of words against every template: the label held best, and its share."""
    words, best = plain.WORD.findall(plain.lower(text)), (0.0, 0, "")
    for label, template in licenses.TEMPLATES:
        t = set(template.split())
        length = -(-len(template.split()) * 5 // 4)
        for a in range(len(words)):
            share = len(t & set(words[a : a + length])) / len(t)
            if share >= licenses.THRESHOLD:
                best = max(best, (share, len(t), label))
    return best[2], round(best[0], 9)


@pytest.mark.parametrize("mark", ["", "# ", " * ", "// "])
def test_wrapped_notices(spark, mark):
    texts = [re.sub("^", mark, t, flags=re.M) for t in NOTICES.values()]
    texts += [f"Some words before.\n\n{t}\n\nAnd some words after it." for t in texts]
    texts += ["\n".join(t.split()) for t in NOTICES.values()]
    want = [best_run(t) for t in texts]
    assert [label for label, _ in want] == list(NOTICES) * 3
    assert labelled(spark, texts) == want


def test_all_licenses_of_a_line(spark):
    texts = {
        "docs are licensed under cc by sa 4 0 and code is licensed under the gnu affero general "
        "public license version 3": "agpl-3,cc-by-sa",
        "this work is licensed under the gnu general public license version 2 or the gnu lesser "
        "general public license version 3": "gpl-2,lgpl-3",
        "licensed under cc by 4 0 and cc by sa 4 0": "cc-by,cc-by-sa",
        "this work is licensed under the gnu general public license version 2": "gpl-2",
        "licensed under cc by 4 0": "cc-by",
        # Scattered over one line, farther than a run reaches.
        "released " + "x " * 40 + "under " + "x " * 40 + "the mit " + "x " * 40 + "license": "mit",
    }
    assert [labels for labels, _ in labelled(spark, texts)] == list(texts.values())


def test_one_line_with_thousands_of_statements(spark):
    text = "licensed under cc by 4 0 " * 1_000 + "licensed under cc by nd 4 0"
    assert labelled(spark, [text]) == [("cc-by,cc-by-nd", 1.0)]
