import zlib

import numpy as np
import pytest
from frames import awkward, docs, prose, rows

from alambique.llm import langid


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def table(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_accuracy(table):
    truth = {r.doc_id: r.lang for r in table.collect()}
    found = langid.predict(table, langid.fit(table)).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if crc(i) == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_rows_are_not_learned(spark):
    ids = [i for i in range(200) if crc(i) == 0]
    data = [(i, *r[1:]) for i, r in zip(ids, rows([prose(i, 30) for i in ids], lang="xx"))]
    assert langid.fit(docs(spark, data)).langs == ()


def test_false_positives_are_corrected():
    """A language whose filter is full claims every n-gram, and counts for none."""
    settings = langid.Settings(slot_bits=12)
    slots = np.ones((1 << 12, 1), np.uint64)
    known = np.unique(np.concatenate([g for g, _ in langid.grams(["river stone"], 4, langid._letters())]))
    for slot in langid.slot_numbers(known, settings):
        slots[slot, 0] |= np.uint64(2)
    model = langid.Filters(("full", "some"), slots, np.array([1.0, 0.0]), settings)
    names, scores = langid.predict_texts(["stone river", "zzzz", "12"], model, langid._letters())
    assert names[0] == "some" and scores[0] > 0.5
    assert names[2] == langid.UNKNOWN


def test_long_texts_are_read_whole(monkeypatch):
    text = prose(4, 400)
    letters = langid._letters()
    whole = np.sort(np.concatenate([g for g, _ in langid.grams([text], 4, letters)]))
    monkeypatch.setattr(langid, "CHUNK", 50)
    parts = np.sort(np.concatenate([g for g, _ in langid.grams([text], 4, letters)]))
    assert (whole == parts).all()


def test_awkward_rows(spark, table):
    odd = awkward(spark)
    model = langid.fit(table)
    found = langid.predict(odd, model).collect()
    assert len(found) == odd.count()
    assert sum(r.lang_pred == langid.UNKNOWN for r in found) == 4
    assert langid.predict(odd.limit(0), model).isEmpty()
    empty = langid.fit(odd.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {langid.UNKNOWN}
    kept = langid.identified_documents(odd, model, least=0.0)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 4


def test_more_languages_than_a_word_has_bits(spark):
    data = []
    for k in range(70):
        name = chr(0x4E00 + 40 * k)
        text = " ".join(chr(0x4E00 + 40 * k + j) * 5 for j in range(30))
        data += [(100 * k + j, *rows([text], lang=name)[0][1:]) for j in range(12)]
    table = docs(spark, data)
    found = langid.predict(table, langid.fit(table)).collect()
    truth = {d[0]: d[2] for d in data}
    assert sum(r.lang_pred == truth[r.doc_id] for r in found) >= 0.99 * len(found)


def test_texts_without_ngrams_are_training_texts_too(spark):
    ids = [i for i in range(60) if crc(i) != 0]
    texts = ["", " ", "7", "a", *[prose(i, 20) for i in ids[4:]]]
    data = [(i, *r[1:]) for i, r in zip(ids, rows(texts))]
    assert langid.fit(docs(spark, data)).langs == ("en",)
    assert langid.fit(docs(spark, data[:1])).langs == ("en",)
    assert langid.fit(awkward(spark)).langs == ("en",)
