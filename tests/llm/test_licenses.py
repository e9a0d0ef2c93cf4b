import random
import re

import pytest
from frames import awkward, docs, prose, rows

from alambique.llm.licenses import BASE_PHRASES, evaluate, scan_licenses, to_postfix

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = WORD.findall(low)
    hits = [
        (i, label)
        for phrase, label in BASE_PHRASES.items()
        for i in range(len(words))
        if words[i : i + phrase.count(" ") + 1] == phrase.split()
    ]
    at = [i for i, _ in hits]
    labels = ",".join(sorted({label for _, label in hits}))
    return len(words), len(hits), min(at, default=None), max(at, default=None), labels


def test_base_figures(spark):
    draw = random.Random(5)
    parts = ["CC", "by", "cc-BY", "All Rights\nReserved", "general", "public", "license", "é", "x1", ".", "all",
             "rights", "reserved", "CC BY-SA 4.0", "\x7f", "Ñ", "cc"]
    texts = [draw.choice(" -\n").join(draw.choices(parts, k=draw.randrange(30))) for _ in range(500)]
    found = {r.doc_id: r for r in scan_licenses(docs(spark, rows(texts))).collect()}
    for i, text in enumerate(texts):
        r = found[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


@pytest.mark.parametrize(
    ("text", "postfix", "openness"),
    [
        ("MIT", ["MIT"], 0.9),
        ("MIT OR GPL-2.0-only", ["MIT", "GPL-2.0-only", "or"], 0.9),
        ("MIT and GPL-2.0+", ["MIT", "GPL-2.0+", "and"], 0.4),
        ("(MIT OR GPL-3.0) AND CC-BY-NC-4.0", ["MIT", "GPL-3.0", "or", "CC-BY-NC-4.0", "and"], 0.2),
        ("MIT OR GPL-2.0 AND ISC", ["MIT", "GPL-2.0", "ISC", "and", "or"], 0.9),
        ("GPL-2.0 WITH Classpath-exception-2.0", ["GPL-2.0", "Classpath-exception-2.0", "with"], 0.5),
        ("MIT see the file", ["MIT"], 0.9),
    ],
)
def test_expressions(text, postfix, openness):
    assert to_postfix(text) == postfix
    assert evaluate(postfix).openness == pytest.approx(openness)


@pytest.mark.parametrize("text", ["", "AND", "(MIT", "MIT OR", ")", "MIT)"])
def test_what_is_no_expression(text):
    assert to_postfix(text) == []


def test_tags_are_read(spark):
    texts = [
        "intro\n# SPDX-License-Identifier: Apache-2.0 OR (MIT AND BSD-3-Clause)\ncode",
        "é SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0",
        "SPDX-License-Identifier:",
    ]
    one, two, three = scan_licenses(docs(spark, rows(texts))).orderBy("doc_id").collect()
    assert one.labels == "apache,bsd,mit" and one.expression == "Apache-2.0 MIT BSD-3-Clause and or"
    assert two.labels == "gpl" and two.openness == pytest.approx(0.5)
    assert three.expression is None and three.labels == ""


def test_prose_after_a_tag_gives_no_label(spark):
    texts = [
        "the license identifier is missing here",
        "a license expression of the author",
        "SPDX license identifier The usual one",
        "SPDX-License-Identifier: is missing",
        "SPDX-License-Identifier: WTFPL OR MIT",
        "License identifier: MIT",
        "license expression GPL-2.0 and more",
        "license identifier: Beerware",
    ]
    found = [r.labels for r in scan_licenses(docs(spark, rows(texts))).orderBy("doc_id").collect()]
    assert found == ["", "", "", "", "mit,wtfpl", "mit", "", ""]


def test_awkward_rows(spark):
    table = awkward(spark)
    found = scan_licenses(table).collect()
    assert len(found) == table.count()
    assert sum(r.n_words == 0 for r in found) == 4
    assert scan_licenses(table.limit(0)).isEmpty()
    long = prose(3, 200_000) + " all rights reserved"
    (row,) = scan_licenses(docs(spark, rows([long]))).collect()
    assert (row.n_words, row.first_word) == (200_003, 200_000)
