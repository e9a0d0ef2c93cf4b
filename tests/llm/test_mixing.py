import pytest
from frames import awkward, docs, prose, rows
from pyspark.sql import functions as F

from alambique.llm.mixing import mix, mixed_documents, targets


@pytest.fixture(scope="module")
def table(spark):
    names = ["a"] * 60 + ["b"] * 30 + ["c"] * 5 + [None] * 3
    texts = [prose(i, 1 + i * 7 % 90) for i in range(len(names))]
    return docs(spark, rows(texts, source=lambda i: names[i]))


def fill(sizes, weights, cap):
    """Targets by taking the excess away and sharing it again, over and over."""
    total, fixed = sum(sizes), {}
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        rest = total - sum(fixed.values())
        share = {i: rest * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > cap * sizes[i]]
        if not over:
            return [fixed.get(i, share.get(i)) for i in range(len(sizes))]
        fixed |= {i: cap * sizes[i] for i in over}


@pytest.mark.parametrize("sizes", [[100, 3, 2, 50, 1], [5, 5, 5], [0, 10], [7], [1, 1, 1, 1000, 1, 1]])
def test_targets(spark, sizes):
    data = [(chr(97 + i), n) for i, n in enumerate(sizes)]
    found = targets(spark.createDataFrame(data, "source string, source_size long"))
    got = {r.source: r.target for r in found.collect()}
    expected = fill(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))], 3)
    assert [got[s] for s, _ in data] == pytest.approx(expected)


def test_taken_words_meet_the_targets(table):
    found = mix(table).collect()
    assert len(found) == 98
    by_source = {}
    for r in found:
        by_source.setdefault(r.source, []).append(r)
        assert 0 <= r.taken <= 3 * r.size
    for own in by_source.values():
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) < 1
        # Whole epochs come first: no document is two repeats ahead of another.
        times = [r.taken / r.size for r in own]
        assert max(times) - min(times) <= 1


def test_reruns_agree_on_any_partitions(table):
    one = {(r.doc_id, r.taken) for r in mix(table.coalesce(1)).collect()}
    assert one == {(r.doc_id, r.taken) for r in mix(table.repartition(7)).collect()}


def test_the_mixed_texts(spark, table):
    out = mixed_documents(table)
    assert out.columns == table.columns
    counts = out.groupBy("doc_id").agg(F.sum(F.size(F.split("text", " "))).alias("n"))
    got = {r.doc_id: r.n for r in counts.collect()}
    assert got == {r.doc_id: r.taken for r in mix(table).collect() if r.taken}
    assert out.filter("n_chars <> length(text)").isEmpty()


def test_quality_draws_first(spark):
    texts = [prose(i, 50) + (" ###" * 100 if i % 2 else "") for i in range(400)]
    found = mix(docs(spark, rows(texts, source=lambda i: "a" if i < 200 else "b"))).collect()
    drawn = [r for r in found if r.source == "b"]
    clean = sum(r.taken > 0 for r in drawn if r.doc_id % 2 == 0)
    assert clean > 1.5 * sum(r.taken > 0 for r in drawn if r.doc_id % 2)


def test_awkward_rows(spark):
    table = awkward(spark)
    found = mix(table).collect()
    assert len(found) == table.count()
    assert all(r.taken == 0 for r in found if r.size == 0)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) < 3  # three equal rows
    assert mix(table.limit(0)).isEmpty() and mixed_documents(table.limit(0)).isEmpty()
    assert mixed_documents(table).columns == table.columns
