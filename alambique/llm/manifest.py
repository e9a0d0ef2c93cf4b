"""Merkle manifest of a dataset, with a proof for each row.

Rows are leaves, ordered by id within their source; runs of three nodes become
their parent until one is left, the source's root, and the roots of the sources
become the dataset's root in the same way. Leaves are numbered without one
sorting task, and a tree is cut into superblocks of BLOCK consecutive nodes:
each is reduced in its own task, and their roots are the nodes of the next
level of superblocks, up to the root. On the way down each superblock is
cogrouped with the one row of outer nodes that it needs, which its roots' own
superblock has found, and finishes its proofs and folds there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.llm.order import numbered
from alambique.operators.joins import lookup_join
from alambique.storage import materialize

#: Nodes of a run, levels of a superblock, and its leaves.
RUN, HEIGHT = 3, 7
BLOCK = RUN**HEIGHT

_NODE = "grp string, at long, n long, digest binary"
_PLACED = (
    "grp string, at long, digest binary, siblings binary, shape binary, "
    "subroot binary, root binary"
)
_FOLDED = (
    "doc_id string, leaf string, subroot string, root string, "
    "proof_sha256 string, folded_root string"
)


def _hash(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _field(value: Column) -> Column:
    value = value.cast("string")
    held = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
    return F.coalesce(held, F.lit("-"))


def _leaf(text: Column) -> Column:
    fields = [F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
    return F.unhex(F.sha2(F.concat(*map(_field, fields)), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """``grp`` (the source, the NULL one first in order), ``doc_id``, ``digest``,
    and ``changed``, the digest after tampering, NULL where that changes nothing."""
    text = F.col("text").cast("string")
    hit = F.crc32(F.col("doc_id").cast("long").cast("string")) % 2 == 0
    cut = F.translate(text, "\n", "")
    group = F.when(F.col("source").isNull(), "").otherwise(
        F.concat(F.lit("s"), F.col("source").cast("string"))
    )
    return docs.select(
        group.alias("grp"),
        F.col("doc_id").cast("long").alias("doc_id"),
        _leaf(text).alias("digest"),
        F.when(hit & F.contains(text, F.lit("\n")), _leaf(cut)).alias("changed"),
        # Rows that repeat are alike in all but this, so they share out evenly.
        F.rand(1).alias("draw"),
    )


def _levels(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The nodes of a superblock and all above them within it. A superblock of a
    larger group has all its levels, also where it has few nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1 or (n > BLOCK and len(levels) <= HEIGHT):
        last = levels[-1]
        levels.append([_hash(last[i : i + RUN]) for i in range(0, len(last), RUN)])
    return levels


def _texts(digests: pd.Series) -> list[bytes]:
    return [bytes(d).hex().encode() for d in digests]


def _block() -> Column:
    return F.expr(f"at div {BLOCK}")


def _reduced(nodes: DataFrame) -> DataFrame:
    """The superblocks' roots, as nodes of the next level."""

    def reduce(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        n, at = int(block["n"].iloc[0]), int(block["at"].iloc[0]) // BLOCK
        top = _levels(_texts(block["digest"]), n)[-1][0]
        row = (block["grp"].iloc[0], at, -(-n // BLOCK), bytes.fromhex(top.decode()))
        return pd.DataFrame([row], columns=["grp", "at", "n", "digest"])

    return (
        nodes.select("grp", "at", "n", "digest", _block().alias("block"))
        .groupBy("grp", "block")
        .applyInPandas(reduce, _NODE)
    )


def _up(nodes: DataFrame, label: str) -> list[DataFrame]:
    """All levels of superblocks, up to one node for each group."""
    levels = [nodes.select("grp", "at", "n", "digest")]
    most = nodes.agg(F.max("n")).first()[0] or 1
    while most > 1:
        levels.append(materialize(_reduced(levels[-1]), f"{label}-{len(levels)}"))
        most = -(-most // BLOCK)
    return levels


def _paths(block: pd.DataFrame, outer: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """Siblings of each node, level by level to the root, and for each level a
    byte: four times those to its left, plus those to its right."""
    levels = _levels(_texts(block["digest"]), int(block["n"].iloc[0]))
    above = [(bytes(outer["siblings"].iloc[0]), bytes(outer["shape"].iloc[0]))]
    for level in reversed(levels[:-1]):
        paths = []
        for i in range(len(level)):
            start = i - i % RUN
            left, right = level[start:i], level[i + 1 : start + RUN]
            siblings, shape = above[i // RUN]
            paths.append(
                (b"".join((*left, *right, siblings)), bytes([4 * len(left) + len(right)]) + shape)
            )
        above = paths
    return above


def _down(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """The nodes with their paths; ``outer`` has those of their superblocks."""

    def place(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        paths = _paths(block, above)
        return pd.DataFrame(
            {
                "grp": block["grp"].to_numpy(),
                "at": block["at"].to_numpy(),
                "digest": block["digest"].to_numpy(),
                "siblings": [p[0] for p in paths],
                "shape": [p[1] for p in paths],
                "subroot": above["subroot"].iloc[0],
                "root": above["root"].iloc[0],
            }
        )

    return _cogrouped(nodes, outer).applyInPandas(place, _PLACED)


def _cogrouped(nodes: DataFrame, outer: DataFrame):
    blocks = nodes.withColumn("block", _block()).groupBy("grp", "block")
    above = outer.withColumnRenamed("at", "block").groupBy("grp", "block")
    return blocks.cogroup(above)


def fold(leaf: bytes, siblings: bytes, shape: bytes) -> bytes:
    """The root that a leaf and its siblings give, all as hex text."""
    at = 0
    for places in shape:
        left, right = divmod(places, 4)
        middle, end = at + 64 * left, at + 64 * (left + right)
        leaf = _hash((siblings[at:middle], leaf, siblings[middle:end]))
        at = end
    return leaf


def _fold_blocks(nodes: DataFrame, outer: DataFrame) -> DataFrame:
    """Proofs and folds of the leaves (with ``doc_id`` and ``changed``)."""

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("at")
        own = _texts(block["digest"])
        changed = [
            o if c is None else bytes(c).hex().encode() for o, c in zip(own, block["changed"])
        ]
        paths = _paths(block, above)
        return pd.DataFrame(
            {
                "doc_id": block["doc_id"].to_numpy(),
                "leaf": [o.decode() for o in own],
                "subroot": bytes(above["subroot"].iloc[0]).hex(),
                "root": bytes(above["root"].iloc[0]).hex(),
                "proof_sha256": [_hash((p[0],)).decode() for p in paths],
                "folded_root": [fold(c, *p).decode() for c, p in zip(changed, paths)],
            }
        )

    # Text, as pandas holds integers that may be NULL as inexact numbers.
    rows = nodes.withColumn("doc_id", F.col("doc_id").cast("string"))
    return _cogrouped(rows, outer).applyInPandas(finish, _FOLDED)


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots, proof and its check of each row.

    ``docs`` needs ``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text``;
    other columns are ignored, whatever their names. Returns ``doc_id, leaf,
    subroot, root, proof_sha256, folded_root, verified``, a row for each row.
    NULL in any column is hashed as ``-``; rows without a source are a source
    that comes first, and rows without an id come first in their source and are
    not tampered with. Rows that share an id are ordered by their leaf; rows that
    repeat have leaves and places of their own. An empty table gives no rows.
    """
    held = numbered(materialize(leaves(docs), "leaves"), ["doc_id", "digest", "draw"], "leaf-places")
    if not held.rows:
        empty = docs.sparkSession.createDataFrame([], _FOLDED)
        return _finished(empty)
    trees = _up(held.df, "subtrees")
    subroots = trees[-1].select(
        F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"
    )
    sources = numbered(subroots, ["name"], "sources").df
    tops = _up(sources, "source-trees")
    none = F.lit(b"")
    outer = tops[-1].select(
        "grp", "at", "digest", none.alias("siblings"), none.alias("shape"),
        F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"),
    )
    for level in reversed(tops[:-1]):
        outer = _down(level, outer)
    outer = materialize(outer, "source-paths")
    outer = lookup_join(outer.drop("subroot", "grp"), sources.select("at", "name"), "at", "inner")
    outer = outer.select(
        F.col("name").alias("grp"), F.lit(0).cast("long").alias("at"), "digest", "siblings", "shape",
        F.col("digest").alias("subroot"), "root",
    )
    for level in reversed(trees[1:-1]):
        outer = materialize(_down(level, outer), "outer-paths")
    return _finished(_fold_blocks(held.df, outer))


def _finished(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
