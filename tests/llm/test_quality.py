import duckdb
import pytest
from compare import compare
from frames import awkward, docs, prose, rows

from alambique.llm import quality
from alambique.llm.oracle import ORACLES
from alambique.llm.quality import Limits, cleaned_documents, judge

NOTICE = "Subscribe to our letter number 7 today"


def table(spark):
    """Sixty texts of one source share a line, and ten more say little else."""
    texts = [f"{prose(i, 70)}\n{NOTICE.replace('7', str(i))}\n{prose(900 + i, 30)}" for i in range(60)]
    texts += [f"{prose(i, 9)}\n" + "\n".join([NOTICE] * 9) for i in range(60, 70)]
    return docs(spark, rows(texts, source=lambda i: "a"))


def test_frequent_lines(spark):
    found = {r.doc_id: r for r in judge(table(spark)).collect()}
    assert all(found[i].kept and found[i].words_lost == 7 for i in range(60))
    assert not any(found[i].kept for i in range(60, 70))
    clean = {r.doc_id: r for r in cleaned_documents(table(spark)).collect()}
    assert set(clean) == set(range(60))
    assert all("Subscribe" not in r.text and r.n_chars == len(r.text) for r in clean.values())
    assert all(r.text.count("\n") == 1 for r in clean.values())


def test_other_sources_keep_the_line(spark):
    texts = [f"{prose(i, 70)}\n{NOTICE}" for i in range(40)]
    found = judge(docs(spark, rows(texts, source=lambda i: f"s{i}"))).collect()
    assert not any(r.words_lost for r in found)


def test_copies_do_not_make_a_line_frequent(spark):
    body = [prose(i, 12) for i in range(8)]
    copies = ["\n".join(body)] * 40
    near = ["\n".join([*body[:7], prose(700 + i, 12)]) for i in range(4)]
    others = [prose(100 + i, 80) for i in range(40)]
    data = docs(spark, rows(copies + near + others, source=lambda i: "a"))
    assert all(r.kept and not r.words_lost for r in judge(data).collect())


def brute_repeats(words):
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    at = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    return len(at)


def test_base_figures(spark):
    texts = ["a b c a b c", "x x x x x", "a b c d a b c", " a b  c\x0b", "l 1\nl 1\n\n \nl 1\n", "#*$ %&| <>", "a b"]
    found = {r.doc_id: r for r in judge(docs(spark, rows(texts))).collect()}
    for i, text in enumerate(texts):
        words = [w for w in text.translate({c: 32 for c in range(9, 14)}).split(" ") if w]
        lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        r = found[i]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in text)
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == brute_repeats(words)
        assert r.base_failed and not r.kept


def test_awkward_rows(spark):
    data = awkward(spark)
    found = judge(data).collect()
    assert len(found) == data.count()
    assert sum(r.n_words == 0 and r.base_failed for r in found) == 4
    kept = cleaned_documents(data, Limits(min_words=1))
    assert kept.columns == data.columns and kept.count() == data.count() - 4
    assert judge(data.limit(0)).isEmpty() and cleaned_documents(data.limit(0)).isEmpty()


SHARED = [
    "Write to editorial-department@neighbourhood-chronicle-archive.example for corrections",
    "Home News Sport Culture Travel Weather",
    "All rights reserved by the owners of this site",
]


@pytest.mark.parametrize("listed", [quality.LISTED, 0])
def test_a_shared_long_word_hides_no_other_shared_line(spark, monkeypatch, listed):
    monkeypatch.setattr(quality, "LISTED", listed)
    texts = ["\n".join([*SHARED, prose(i, 70)]) for i in range(60)]
    table = docs(spark, rows(texts, source=lambda i: "a"))
    words = sum(len(x.split()) for x in SHARED)
    assert all(r.kept and r.words_lost == words for r in judge(table).collect())
    left = {r.doc_id: r.text for r in cleaned_documents(table).collect()}
    assert left == {i: prose(i, 70) for i in range(60)}


def test_few_words_and_many_copies_hide_no_shared_line(spark):
    """All words are from a small vocabulary, and most rows are copies of one text."""
    plain = lambda i, n: "".join(c for c in prose(i, n) if not c.isdigit())
    texts = [f"{plain(i, 70)}\n{SHARED[1]}" for i in range(40)] + [plain(999, 80)] * 3000
    found = judge(docs(spark, rows(texts, source=lambda i: "a"))).collect()
    assert all(r.words_lost == (6 if r.doc_id < 40 else 0) for r in found)


@pytest.mark.parametrize("own", [5, 20, 70])
def test_shared_words_count_however_few_are_the_documents_own(spark, own):
    """Sixty documents share eight lines of thirty words and have ``own`` others."""
    shared = [prose(5000 + i, 30) for i in range(8)]
    texts = ["\n".join([*shared, prose(i, own)]) for i in range(60)]
    found = judge(docs(spark, rows(texts, source=lambda i: "a"))).collect()
    assert all(r.words_lost == 240 and not r.kept for r in found)


def test_verdict_against_sql(spark, tmp_path):
    """Sources in which lines are frequent by their rows, by their distinct texts,
    in some sources only, and not at all."""
    texts, names = [], []
    for i in range(300):
        name = "abcd"[i % 4]
        lines = [prose(i, 40)] * (1 + i % 2) + [prose(i + 1000, 30)]
        if name in "ab":
            lines += [SHARED[1], NOTICE.replace("7", str(i))]
        if name == "c":
            lines = [prose(7, 40), prose(8, 40), prose(2000 + i, 20)]
        if name == "d" and i % 20 == 3:
            lines += [SHARED[2]] * 60
        texts.append("\n".join(lines) if i % 17 else None)
        names.append(name if i % 29 else None)
    table = docs(spark, rows(texts, source=lambda i: names[i])).union(
        docs(spark, rows([texts[1]] * 200, source=lambda i: "d"))
    )
    table.select("doc_id", "text", "source").toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet'")
    run = lambda spark, path: judge(table)
    assert compare(spark, con, run, ORACLES["op9_quality_rules"], str(tmp_path)) == ""
    found = judge(table).collect()
    assert {r.kept for r in found if not r.base_failed} == {True, False}
    assert any(r.words_lost for r in found)


def test_lines_in_many_documents_are_frequent(spark):
    texts = [f"{prose(i, 70)}\n{SHARED[1] if i < 30 else ''}" for i in range(400)]
    table = docs(spark, rows(texts, source=lambda i: "a"))
    assert not any(r.words_lost for r in judge(table, Limits(doc_share=0.1)).collect())
    found = judge(table, Limits(doc_share=0.1, many_docs=20)).collect()
    assert all(r.words_lost == (6 if r.doc_id < 30 else 0) for r in found)
