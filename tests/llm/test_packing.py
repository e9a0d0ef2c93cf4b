from array import array

import pytest
from frames import awkward, docs, prose, rows
from tokenizers import Tokenizer

from alambique.llm.packing import END_ID, TIERS, pack
from alambique.llm.queries import TOKENIZER


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]


def check(pieces, expected):
    """Every id is in one piece, and every sequence is gapless and in its window."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        ids = array("I", bytes(p.ids)).tolist()
        assert len(ids) == p.length > 0
        by_doc.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, ids in expected.items():
        parts = sorted(by_doc[doc_id])
        assert [i for _, part, _ in parts for i in part] == ids
        assert [s for s, _, _ in parts] == [sum(len(q) for _, q, _ in parts[:k]) for k in range(len(parts))]
        assert {n for _, _, n in parts} == {len(ids)}
    short = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        total = 0
        for p in own:
            assert p.offset == total
            total += p.length
        assert total <= own[0].window and own[0].window in TIERS
        short += total != own[0].window
    return by_sequence, short


def test_given_documents(spark, small_dir, reference):
    table = spark.read.parquet(f"{small_dir}/documents.parquet").coalesce(1)
    expected = {r.doc_id: reference(r.text) for r in table.collect()}
    sequences, short = check(pack(table, TOKENIZER).collect(), expected)
    assert short <= 1  # one padded sequence a task
    assert {own[0].window for own in sequences.values()} == set(TIERS)


def test_step_groups_are_balanced(spark):
    table = docs(spark, rows([prose(i, 20 + i * 13 % 900) for i in range(600)])).coalesce(1)
    pieces = pack(table, TOKENIZER, step_tokens=1 << 14).collect()
    tokens, windows = {}, {}
    for p in pieces:
        tokens[p.step_group] = tokens.get(p.step_group, 0) + p.length
        windows.setdefault(p.step_group, set()).add(p.window)
    assert all(len(w) == 1 for w in windows.values()) and max(tokens.values()) <= 1 << 14
    long = [n for g, n in tokens.items() if windows[g] == {2048}]
    assert max(long) - min(long) <= 2 * 2048


def test_odd_texts(spark, reference):
    texts = ["a  b\n c", "  x", " ", "<|endoftext|> y", "it's 'll 12 3a \x1c", "é　世界 😀", "x" * 9000, None, ""]
    table = docs(spark, rows(texts))
    check(pack(table, TOKENIZER).collect(), {i: reference(t) for i, t in enumerate(texts)})


def test_awkward_rows(spark, reference):
    table = awkward(spark)
    pieces = pack(table.coalesce(1), TOKENIZER).collect()
    _, short = check(pieces, {})
    assert short <= 1
    assert sum(p.length for p in pieces) == sum(len(reference(r.text)) for r in table.collect())
    assert pack(table.limit(0), TOKENIZER).isEmpty()
    again = pack(table.coalesce(1), TOKENIZER).collect()
    assert again == pieces


def test_strings_of_added_tokens_are_one_id(spark, reference):
    texts = ["x <|endoftext|> y", "<|endoftext|>" * 3, "<|endoftext|", "a<|endoftext|>\n b"]
    assert reference(texts[0]) == [87, 220, 50256, 331, END_ID]
    expected = {i: reference(t) for i, t in enumerate(texts)}
    check(pack(docs(spark, rows(texts)).coalesce(1), TOKENIZER).collect(), expected)
