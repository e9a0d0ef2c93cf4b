import random
import re
from itertools import combinations

import numpy as np
import pytest
from frames import awkward, docs, prose, rows
from pyspark.sql import functions as F

from alambique.llm import neardup, shingles as sh
from alambique.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(zip(*[words[i:] for i in range(k)])) or frozenset([tuple(words)])


def brute(texts, k, percent):
    sets = [shingles(t, k) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return [(i, len(sets[i]), find(i), find(i) == i) for i in range(len(texts))]


def edited(text, seed, share):
    draw = random.Random(seed)
    return " ".join(f"w{draw.random()}" if draw.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def corpus():
    """Lone texts, small groups at every similarity, and one large group."""
    texts = [prose(i, 30 + i) for i in range(60)]
    for g in range(40):
        base = prose(1000 + g, 60 + 5 * g)
        texts += [edited(base, 10 * g + j, 0.002 * g) for j in range(4)]
    center = prose(5000, 150)
    texts += [center] * 30 + [edited(center, 9000 + j, 0.04) for j in range(250)]
    random.Random(8).shuffle(texts)
    return texts


@pytest.mark.parametrize("node_rows", [2048, 64])
@pytest.mark.parametrize("words", [2, 5])
def test_components(spark, corpus, words, node_rows):
    settings = neardup.Settings(words=words, node_rows=node_rows)
    found = neardup.near_duplicates(docs(spark, rows(corpus)), settings).collect()
    assert sorted(map(tuple, found)) == brute(corpus, words, 80)


def test_a_large_group_gives_few_candidates(spark):
    center = prose(5000, 150)
    texts = [edited(center, j, 0.03) for j in range(400)]
    described = neardup.described(docs(spark, rows(texts)))
    classes = described.select("sig", "coords").withColumn("label", F.col("sig"))
    for node_rows in (2048, 64):
        settings = neardup.Settings(node_rows=node_rows)
        assert neardup.first_pairs(classes, settings).count() < 400 * 24


def test_one_document_of_each_group_stays(spark, corpus):
    table = docs(spark, rows(corpus))
    kept = neardup.deduplicated(table.union(table))
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(corpus, 2, 80) if r[3]]


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (102, 101), (7, 7), (3, 2)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    labels = {r.node: r.label for r in found}
    assert labels == {**{i: 0 for i in range(1, 61)}, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_awkward_rows(spark):
    table = awkward(spark)
    found = neardup.near_duplicates(table).collect()
    assert len(found) == table.count()
    empty = [r for r in found if r.n_shingles == 0]
    assert len(empty) == 4 and all(r.component_id == r.doc_id for r in empty)
    same = {r.component_id for r in found if r.doc_id in (5, 6) and r.n_shingles > 10}
    assert same == {5}
    assert [r.kept for r in found if r.doc_id is None] == [False, False]
    assert neardup.near_duplicates(table.limit(0)).isEmpty()
    # Two texts that are not linked share the id 5.
    assert neardup.deduplicated(table).filter("doc_id = 5").count() == 2
    assert neardup.deduplicated(table.limit(0)).isEmpty()


@pytest.mark.parametrize("percent", [60, 95])
def test_other_limits(spark, percent):
    base = prose(3, 90)
    texts = [edited(base, j, 0.01 * (j % 12)) for j in range(60)]
    settings = neardup.Settings(percent=percent)
    found = neardup.near_duplicates(docs(spark, rows(texts)), settings).collect()
    assert sorted(map(tuple, found)) == brute(texts, 2, percent)


def test_trees_allow_for_chance_in_sketches():
    """Links at the limit meet in some tree, whatever steps large nodes take."""
    np.seterr(over="ignore")
    settings, pairs = neardup.Settings(), 2_000
    draw = np.random.default_rng(3)
    one = draw.integers(0, 1 << 16, (pairs, settings.coords), dtype=np.uint16)
    equal = draw.random(one.shape) < settings.limit
    both = np.concatenate([one, np.where(equal, one, one ^ np.uint16(1))])
    trees, met = settings.trees(3), np.zeros(pairs, int)
    width = settings.coords // trees
    for t in range(trees):
        node, row = np.full(2 * pairs, sh.mix(np.array([t + 1], np.uint64))[0]), np.arange(2 * pairs)
        own = both[:, t * width : (t + 1) * width]
        walks = [(3, own, settings.twice[0]), *[(1, own, settings.twice[1])] * neardup.OWN_STEPS]
        for steps, coords, twice in [*walks, *[(1, both, settings.twice[1])] * 2]:
            node, row = neardup._walk(node, row, coords, steps, twice)
            # Only nodes that hold both of a pair matter.
            left = set(zip(node[row < pairs].tolist(), row[row < pairs].tolist()))
            held = {(n, r - pairs) for n, r in zip(node[row >= pairs].tolist(), row[row >= pairs].tolist())}
            ends = left & held
            node = np.array([n for n, _ in ends] * 2, np.uint64)
            row = np.array([r for _, r in ends] + [r + pairs for _, r in ends])
        met[np.unique([r for _, r in ends])] += 1
    assert (met > 0).all()
    assert (equal[:, : settings.compared].sum(axis=1) >= settings.maybe).all()


def test_rows_without_an_id_stay_once(spark):
    texts = [prose(1, 80), prose(2, 80), prose(3, 80), prose(3, 80), None]
    data = [(i, *r[1:]) for i, r in zip([1, None, None, None, None], rows(texts))]
    # Of two rows with one id, one is a copy of the first document.
    data += [(7, *data[0][1:]), (7, *rows([prose(4, 80)])[0][1:]), (None, *data[0][1:])]
    kept = neardup.deduplicated(docs(spark, data)).select("doc_id", "text").collect()
    expected = [(1, texts[0]), (None, texts[1]), (None, texts[2]), (None, None), (7, prose(4, 80))]
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, expected))


def test_unlinked_texts_of_one_id_stay(spark):
    texts = [prose(i, 60) for i in range(3)]
    data = docs(spark, [(1, *r[1:]) for r in rows(texts)]).withColumn("text_hash", F.lit("own"))
    kept = neardup.deduplicated(data).collect()
    assert sorted(r.text for r in kept) == sorted(texts)
    assert {r.text_hash for r in kept} == {"own"}


def test_nodes_cut_into_parts(spark, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "SET_BYTES", 4096)
    found = neardup.near_duplicates(docs(spark, rows(corpus))).collect()
    assert sorted(map(tuple, found)) == brute(corpus, 2, 80)


def test_nodes_that_stay_large_are_compared_in_parts(spark, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "ROUNDS", 1)
    settings = neardup.Settings(node_rows=8)
    found = neardup.near_duplicates(docs(spark, rows(corpus)), settings).collect()
    assert sorted(map(tuple, found)) == brute(corpus, 2, 80)


@pytest.mark.parametrize("percent", [50, 60, 80, 95])
def test_trees_for_every_limit(percent):
    settings = neardup.Settings(percent=percent).fitted(3)
    assert settings.missed(3, settings.trees(3)) <= 0.6 * settings.miss


def test_a_limit_without_trees_is_refused():
    with pytest.raises(ValueError):
        neardup.Settings(percent=20).fitted(3)
    with pytest.raises(ValueError):
        neardup.Settings(percent=50).trees(3)


def test_links_near_a_low_limit(spark):
    """Pairs on both sides of the limit, against brute force."""
    base = [prose(40 + g, 80) for g in range(40)]
    texts = [edited(b, 100 * g + j, 0.16) for g, b in enumerate(base) for j in range(3)]
    settings = neardup.Settings(percent=50)
    found = neardup.near_duplicates(docs(spark, rows(texts)), settings).collect()
    assert sorted(map(tuple, found)) == brute(texts, 2, 50)


def test_a_class_is_in_one_open_group(spark):
    center = prose(5000, 150)
    texts = [edited(center, j, 0.0003 * j) for j in range(400)]
    described = neardup.described(docs(spark, rows(texts)))
    classes = described.select("sig", "coords").distinct().withColumn("label", F.col("sig"))
    found = neardup.open_rows(classes, neardup.Settings()).select("cls")
    assert found.count() == found.distinct().count() > 300


def test_large_nodes_of_one_label_but_for_a_few_rows_do_not_walk(spark, monkeypatch):
    steps, one_step = [], neardup._one_step
    monkeypatch.setattr(
        neardup, "_one_step", lambda rows, n, *a: steps.append(n) or one_step(rows, n, *a)
    )
    center = prose(5000, 150)
    texts = [edited(center, j, 0.02) for j in range(300)]
    described = neardup.described(docs(spark, rows(texts)))
    own = F.when(F.col("sig") % 25 == 0, F.col("sig")).otherwise(F.lit(0))
    classes = described.select("sig", "coords").distinct().withColumn("label", own)
    few = classes.filter("label <> 0").count()
    found = neardup.open_rows(classes, neardup.Settings(node_rows=32))
    assert 0 < few < 32 and sum(steps) == 0
    assert found.filter("label <> 0").select("cls").distinct().count() == few
    assert found.filter("label = 0").select("cls").distinct().count() == classes.count() - few


def test_nodes_of_many_sets_are_cut(spark, corpus, monkeypatch):
    monkeypatch.setattr(neardup, "SETS", 8)
    found = neardup.near_duplicates(docs(spark, rows(corpus))).collect()
    assert sorted(map(tuple, found)) == brute(corpus, 2, 80)


def test_sketches_tell_the_similarity_of_sets():
    np.seterr(over="ignore")
    draw, factors = np.random.default_rng(5), sh.factors(192, 1)
    for size in (20, 700):
        both = sh.mix(draw.integers(0, 1 << 63, (40, 5 * size // 4), dtype=np.uint64))
        one = [sh.sketch(x[:size], factors) for x in both]
        other = [sh.sketch(x[size // 4 :], factors) for x in both]
        assert abs(np.mean(np.equal(one, other)) - 0.6) < 0.02
