"""Small tables with every awkward case."""

from __future__ import annotations

import random

WORDS = "river stone cloud paper green table night small seven bread light house".split()

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use or return themselves.
    "size int, kept boolean, label string, node long, next string, score double, term long"
)


def rows(texts, source=lambda i: f"s{i % 2}", lang="en"):
    return [
        (i, t, lang, source(i), len(t or ""), -1, None, "x", 0, "y", 0.5, 1)
        for i, t in enumerate(texts)
    ]


def docs(spark, data):
    return spark.createDataFrame(data, DOCS)


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + str(draw.randrange(900)) for _ in range(n))


def awkward(spark):
    """NULL, empty and blank texts, no id, no source, repeated rows, one id twice."""
    texts = [None, "", " \t\n ", "a", "Grüße, 世界! 😀", prose(1, 80), prose(1, 80), prose(2, 5000)]
    data = rows(texts)
    data += [data[5], data[5], (5, "another text of the same id", *data[5][2:])]
    data += [(None, "no id here", *data[0][2:]), (None, None, None, None, *data[0][4:])]
    return docs(spark, data)
