import hashlib

import pytest
from frames import awkward, docs, prose, rows

from alambique.llm.fingerprints import Band, fingerprint_edits


def edited(texts):
    out = []
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        quarter = len(text) // 4
        out.append(text[: len(text) - quarter] + after[:quarter])
    return out


def test_edited_texts(spark):
    texts = [prose(i, 3 + 7 * i) for i in range(30)] + ["", "é" * 9, "x"]
    found = {r.doc_id: r for r in fingerprint_edits(docs(spark, rows(texts))).collect()}
    for i, (text, changed) in enumerate(zip(texts, edited(texts))):
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert 0 <= found[i].near_edited <= 1 and 0 <= found[i].near_next <= 1


def test_edits_are_nearer_than_others(spark):
    texts = [prose(i, 120) for i in range(300)]
    found = fingerprint_edits(docs(spark, rows(texts)), Band(low=0.005, high=0.5)).collect()
    assert sum(r.near_edited for r in found) > 10 * sum(r.near_next for r in found)
    assert len({r.fingerprint for r in found}) == 300


def test_awkward_rows(spark):
    table = awkward(spark)
    found = fingerprint_edits(table).collect()
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(
        str(r.doc_id) for r in table.collect()
    )
    by_text = {}
    texts = {(r.doc_id, r.n_chars): r for r in found}
    for r in table.select("doc_id", "text").collect():
        print_ = texts[r.doc_id, len(r.text or "")].fingerprint
        assert by_text.setdefault(r.text or "", print_) == print_
    copies = [r for r in found if r.doc_id == 5 and r.n_chars == len(prose(1, 80))]
    assert len(copies) == 3 and len(set(copies)) == 1


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(spark, n):
    found = fingerprint_edits(docs(spark, rows([prose(1, 40)])).limit(n)).collect()
    assert len(found) == n
    assert all(r.near_next == 1 for r in found)  # a lone document is its own next


def test_copies_do_not_push_their_terms_out(spark):
    """Half of all rows are copies of one text; its terms are in few distinct texts."""
    texts = [prose(999, 120)] * 60 + [prose(i, 120) for i in range(60)]
    found = {r.doc_id: r for r in fingerprint_edits(docs(spark, rows(texts))).collect()}
    assert len({found[i].fingerprint for i in range(60)}) == 1
    assert not found[0].fingerprint.startswith("x:")
    assert found[59].near_edited > 0  # the last copy, edited by another text


def test_texts_without_terms_of_the_lexicon_have_subsets(spark):
    texts = [f"all {'same ' * i}words here" for i in range(60)]
    found = fingerprint_edits(docs(spark, rows(texts))).collect()
    assert not any(r.fingerprint.startswith("x:") for r in found)
