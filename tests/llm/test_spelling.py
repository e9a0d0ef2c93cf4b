import random
import re
import zlib
from collections import Counter

import pytest
from frames import awkward, docs, rows

from alambique.llm import spelling


def brute(table):
    uses = Counter()
    for doc_id, text in table:
        for found in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in found)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            uses[low] += 1
    uses = {w: n for w, n in uses.items() if len(w) >= 7 and n >= 2}
    shorter = {}
    for w in uses:
        for i in range(len(w)):
            shorter.setdefault(w[:i] + w[i + 1 :], set()).add(w)
            shorter.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    forms, near = {}, {}
    for w, n in uses.items():
        found = set(shorter.get(w, ()))
        for i in range(len(w)):
            found |= shorter.get((w[:i], w[i + 1 :]), set())
            found |= {w[:i] + w[i + 1 :]} & set(uses)
        near[w] = found - {w}
        best = min(near[w], key=lambda x: (-uses[x], x), default=None)
        forms[w] = best if best is not None and uses[best] >= 10 * n else None
    for w, n in uses.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        yield w, forms[w], root, n, len(near[w]), uses.get(forms[w])


def check(table, **options):
    found = sorted(map(str, map(tuple, spelling.variants(table, **options).collect())))
    assert found == sorted(map(str, brute([(r.doc_id, r.text) for r in table.collect()])))
    return len(found)


def misspelt(draw, word):
    at = draw.randrange(len(word) + 1)
    kind, letter = draw.randrange(3), draw.choice("abceiouéÿÀ")
    if kind == 0:
        return word[:at] + letter + word[at:]
    return word[:at] + (letter if kind == 1 else "") + word[at + 1 :]


def corpus(seed, letters, bases, rows_):
    """Words at one, two and three edits of common ones."""
    draw = random.Random(seed)
    words = ["".join(draw.choices(letters, k=draw.randrange(6, 13))) for _ in range(bases)]
    texts = []
    for _ in range(rows_):
        some = []
        for _ in range(200):
            word = draw.choice(words[: 1 + int(bases * draw.random() ** 3)])
            while draw.random() < 0.12:
                word = misspelt(draw, word)
            some.append(word if draw.random() < 0.8 else word.capitalize())
        texts.append(draw.choice([" ", "\n", "1", ", "]).join(some))
    return texts


@pytest.mark.parametrize("indexed", [1 << 13, 5])
@pytest.mark.parametrize("letters", ["ab", "abcdefgé"])
def test_against_brute_force(spark, letters, indexed):
    texts = corpus(1, letters, 30, 150)
    assert check(docs(spark, rows(texts)), indexed=indexed) > 300


@pytest.mark.parametrize("limits", [(1, 1 << 22, 1 << 18), (64, 1 << 22, 3), (1 << 15, 1 << 22, 1 << 18)])
def test_blocks_cut_anywhere(spark, monkeypatch, limits):
    for name, value in zip(("ROWS", "READ", "TOGETHER"), limits):
        monkeypatch.setattr(spelling, name, value)
    words = ["aaaa" + "".join(random.Random(i).choices("abc", k=4)) for i in range(300)]
    check(docs(spark, rows([" ".join(words)] * 3)), indexed=20)


def test_chain_of_forms(spark):
    texts = ["abcdefgh " * 5000, "abcdefgi " * 400, "abcdefji " * 30, "abcdekji " * 2]
    table = docs(spark, rows(texts))
    check(table)
    found = {r.word: r.root for r in spelling.variants(table).collect()}
    assert found["abcdekji"] == "abcdefgh"


def test_given_documents(spark, small_dir):
    check(spark.read.parquet(f"{small_dir}/documents.parquet"))


def test_awkward_rows(spark):
    table = awkward(spark)
    check(table.union(docs(spark, rows(["ABCDEFG abcdefg ×÷abcdefg " + "z" * 3000 + " " + "z" * 3000]))))
    assert spelling.variants(table.limit(0)).isEmpty()
    assert spelling.variants(docs(spark, rows([None, "", "short"]))).isEmpty()
