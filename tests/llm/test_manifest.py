import hashlib
import zlib
from collections import defaultdict

import pytest
from frames import awkward, docs, rows

from alambique.llm import manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, text):
    return h("".join(map(field, (r.doc_id, r.source, r.lang, r.n_chars, text))))


def tree(nodes):
    """Root, and the siblings (left, right) of each node on its way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place - place % 3 :][:3]
            paths[i].append((run[: place % 3], run[place % 3 + 1 :]))
            at[i] = place // 3
        nodes = [h("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
    return nodes[0], paths


def brute(table):
    groups = defaultdict(list)
    for r in table:
        groups[r.source].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    first = lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))
    trees = {s: (sorted(groups[s], key=first),) for s in names}
    for s, (own,) in trees.items():
        trees[s] = own, *tree([leaf(r, r.text) for r in own])
    root, outer = tree([trees[s][1] for s in names])
    for s, above in zip(names, outer):
        own, subroot, paths = trees[s]
        for r, path in zip(own, paths):
            path = path + above
            hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            text = r.text.replace("\n", "") if hit and r.text is not None else r.text
            folded = leaf(r, text)
            for left, right in path:
                folded = h("".join([*left, folded, *right]))
            proof = h("".join("".join([*left, *right]) for left, right in path))
            yield r.doc_id, leaf(r, r.text), subroot, root, proof, folded, folded == root


def check(table):
    found = sorted(map(str, map(tuple, manifest.manifest(table).collect())))
    assert found == sorted(map(str, brute(table.collect())))


@pytest.mark.parametrize("block", [(1, 3), (2, 9), (7, 3**7)])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(manifest, "HEIGHT", block[0])
    monkeypatch.setattr(manifest, "BLOCK", block[1])
    texts = [f"line {i}\nand more" for i in range(100)]
    names = ["hot"] * 60 + ["b"] * 28 + ["ä", "z", None, None, "one", "c", "c", "c", "c", "d", "d", "e"]
    check(docs(spark, rows(texts, source=lambda i: names[i])))


def test_many_sources_and_one_source(spark, monkeypatch):
    monkeypatch.setattr(manifest, "HEIGHT", 1)
    monkeypatch.setattr(manifest, "BLOCK", 3)
    check(docs(spark, rows(["a\nb", None, "c"] * 8, source=lambda i: f"s{i}")))
    check(docs(spark, rows(["a\nb"], source=lambda i: "s")))
    check(docs(spark, rows(["a\nb", "c\n"], source=lambda i: None)))


def test_awkward_rows(spark):
    check(awkward(spark))
    assert manifest.manifest(awkward(spark).limit(0)).isEmpty()


def test_given_documents(spark, small_dir):
    check(spark.read.parquet(f"{small_dir}/documents.parquet"))


def test_a_changed_character_is_found(spark):
    table = docs(spark, rows([f"a\n{i}" for i in range(30)], source=lambda i: "a"))
    found = {r.doc_id: r.verified for r in manifest.manifest(table).collect()}
    assert found == {i: bool(zlib.crc32(str(i).encode()) % 2) for i in range(30)}
