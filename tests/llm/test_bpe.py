import hashlib
import random

import numpy as np
import pytest
from frames import awkward, docs, prose, rows

from alambique.llm import bpe
from alambique.llm.queries import WORD_TOKENIZER

LETTERS = ["abcdefghijklmnopqrstuvwxyz", "ab", "'strelvmd", "aA 1'.,", "éÉüßİΣς", "日本語中文字",
           "가각ㄱ각", "ȩ́ö", "😀👍🏽  ‍", "=-_*"]
JOINS = ["<|endoftext|>", "<|startoftext|>", "'re", "'ll", " ", "\n", "<|ENDOFTEXT|>", "<|endof"]


def awkward_text(draw):
    parts = []
    for _ in range(draw.randrange(1, 6)):
        letters = draw.choice(LETTERS)
        n = draw.randrange(1, draw.choice([5, 60, 400]))
        parts += ["".join(draw.choice(letters) for _ in range(n)), draw.choice(JOINS)]
    return "".join(parts[:-1])


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(WORD_TOKENIZER, window=4)


def joined(encoder, text, size):
    parts = []
    for at in range(0, len(text), size):
        own = bpe._SPACE.split(text[at : at + size])
        parts.append(encoder.part(own[0], encoder.plain(" ".join(own[1:-1])), own[-1] if len(own) > 1 else None))
    return encoder.concatenate(parts).ids().tolist()


def library(encoder, text):
    return encoder.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("seed", range(400))
def test_joins_give_the_librarys_ids(encoder, seed):
    draw = random.Random(seed)
    text = awkward_text(draw)
    expected = library(encoder, text)
    assert encoder.plain(text).tolist() == expected
    for size in (1, 3, 7, 20, 50):
        assert joined(encoder, text, size) == expected


def test_a_long_word_is_joined_within(encoder, monkeypatch):
    """Only windows of a word's halves are encoded again."""
    word = "".join(random.Random(3).choices("abcdefghij", k=20_000))
    expected, longest = library(encoder, word), []
    whole = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda t: longest.append(len(t)) or whole(t))
    assert joined(encoder, word, 1000) == expected
    assert max(longest) == 1000


def brute(encoder, text):
    encoded = library(encoder, text or "")
    decoded = encoder.library.decode(encoded, skip_special_tokens=False)
    raw = np.array(encoded, "<u4").tobytes()
    return len(encoded), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def check(table, encoder, piece):
    expected = sorted(str((r.doc_id, *brute(encoder, r.text))) for r in table.collect())
    found = bpe.encode(table, WORD_TOKENIZER, piece).collect()
    assert sorted(str(tuple(r)) for r in found) == expected


@pytest.mark.parametrize("piece", [16, 300, bpe.PIECE])
def test_rows(spark, encoder, piece):
    draw = random.Random(9)
    texts = [awkward_text(draw) for _ in range(60)] + [prose(4, 4000), "x" * 30_000]
    check(docs(spark, rows(texts)), encoder, piece)


def test_given_documents(spark, encoder, small_dir):
    check(spark.read.parquet(f"{small_dir}/documents.parquet"), encoder, 512)


def test_awkward_rows(spark, encoder):
    for piece in (8, bpe.PIECE):
        check(awkward(spark), encoder, piece)
    assert bpe.encode(awkward(spark).limit(0), WORD_TOKENIZER).isEmpty()
