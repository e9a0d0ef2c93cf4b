"""I-Match fingerprints with randomised lexicon subsets.

A text is known by its distinct terms within a band of document frequency: the
lexicon. Sorted and hashed, they give one signature for the whole lexicon. As a
single changed term alters that, each of several random subsets of the lexicon
gives a signature of its own. Subsets keep one term in 2^level; the level
follows the number of terms, so that each subset has one or two terms of the
text, and unchanged subsets keep their signature when part of a text changes.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alambique.llm.order import with_neighbours
from alambique.llm.text import whole
from alambique.operators.joins import lookup_join
from alambique.storage import materialize, materialize_measured


@dataclass(frozen=True)
class Band:
    """Terms are in the lexicon if they occur in ``low`` to ``high`` of all
    distinct texts. The lexicon has at most the mean number of distinct terms a
    document divided by ``low`` entries, whatever the size of the corpus."""

    low: float = 0.002
    high: float = 0.05
    subsets: int = 16


def terms(text: Column) -> Column:
    """Hashes of the distinct terms: lower-case runs of letters and digits."""
    found = F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    return F.array_distinct(F.transform(found, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """``term`` and ``docs`` of the terms within the band, over all distinct texts.

    Only texts with copies are shuffled, one of each from a task.
    """
    texts = docs.select(whole().alias("text"), F.xxhash64(whole()).alias("__text"))
    rows = materialize(texts.groupBy("__text").agg(F.count(F.lit(1)).alias("n")), "texts")
    copied = materialize_measured(rows.filter("n > 1").select("__text"), "copied-texts")
    lone = lookup_join(texts, copied, "__text", "left_anti").select("text")
    one = lookup_join(texts, copied, "__text", "left_semi").groupBy("__text")
    distinct = lone.union(one.agg(F.max("text").alias("text")).select("text"))
    every = distinct.select(F.explode(terms(F.col("text"))).alias("term"))
    counted = every.groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    total = rows.count()
    return counted.filter(F.col("docs").between(max(1, total * band.low), total * band.high))


def _membership(words: DataFrame) -> np.ndarray:
    """A Bloom filter of the lexicon: BITS a term, PROBES of them set.

    The lexicon's bound, see Band, bounds what reaches the driver and the
    filter's size. One term in four hundred that is not in the lexicon passes,
    the same one in every text.
    """
    found = words.select("term").toArrow()["term"].to_numpy().astype(np.int64)
    bits = 64 * max(1, -(-len(found) * BITS // 64))
    held = np.zeros(bits, bool)
    for k in range(PROBES):
        held[_probe(found, k) % bits] = True
    packed = np.packbits(held, bitorder="little").view(np.int64)
    return packed if len(found) else np.zeros(1, np.int64)


def _probe(hashed: np.ndarray, k: int) -> np.ndarray:
    """The k-th 31 bits of a term's hash."""
    return (hashed.view(np.uint64) >> np.uint64(11 * k)) & np.uint64(0x7FFFFFFF)


BITS, PROBES = 16, 4


def within(found: str, member: np.ndarray) -> Column:
    """The terms of a column that are in the lexicon."""
    table = F.lit(member)
    bits = 64 * len(member)

    def known(t: Column) -> Column:
        tests = []
        for k in range(PROBES):
            at = F.shiftrightunsigned(t, 11 * k).bitwiseAND(F.lit(0x7FFFFFFF)) % bits
            word = F.get(table, F.shiftright(at, 6).cast("int"))
            shifted = F.call_function(
                "shiftrightunsigned", word, at.bitwiseAND(F.lit(63)).cast("int")
            )
            tests.append(shifted.bitwiseAND(F.lit(1)) == 1)
        return reduce(lambda x, y: x & y, tests)

    return F.filter(found, known)


def _known_or_all(found: str, member: np.ndarray) -> Column:
    """The terms of a column in the lexicon, or all if none is."""
    known = within(found, member)
    return F.when(F.size(known) > 0, known).otherwise(F.col(found))


def level_of(kept: Column) -> Column:
    """The level at which a subset keeps one or two of the terms on average."""
    return F.greatest(F.lit(0), F.ceil(F.log2(F.size(kept) / 2.0))).cast("int")


def subsets(kept: str, level: str, band: Band = Band()) -> Column:
    """The terms of a column that each random subset keeps at a level: those
    whose hash by the subset's number ends in as many zero bits."""
    return F.expr(
        f"transform(sequence(0, {band.subsets - 1}), k -> filter({kept}, "
        f"t -> (xxhash64(t, k) & (shiftleft(1L, {level}) - 1)) = 0))"
    )


def fingerprint(kept: str, subset: str, level: str, lone: str) -> Column:
    """Fingerprint of a column of sorted term hashes from the lexicon.

    ``level:`` with the signatures of the subsets at that level and the next,
    then the signature of the whole lexicon. A text without a term has ``lone``
    alone.
    """
    sign = (
        "CASE WHEN size({a}) = 0 THEN '-' "
        "ELSE lpad(hex(xxhash64({a}) & 65535L), 4, '0') END"
    )
    deeper = f"filter(a, t -> (xxhash64(t, k) & (shiftleft(1L, {level} + 1) - 1)) = 0)"
    parts = F.concat(
        F.expr(f"transform({subset}, a -> {sign.format(a='a')})"),
        F.expr(
            f"transform(transform({subset}, (a, k) -> {deeper}), b -> {sign.format(a='b')})"
        ),
    )
    known = F.concat_ws(
        ":", F.col(level).cast("string"), F.array_join(parts, ","), _hex(F.xxhash64(kept))
    )
    return F.when(F.size(kept) == 0, F.concat_ws(":", F.lit("x"), _hex(lone))).otherwise(known)


def _hex(hashed: Column | str) -> Column:
    return F.lpad(F.hex(hashed), 16, "0")


def likeness(a: Column, b: Column, band: Band = Band()) -> Column:
    """Share of equal signatures among the subsets that have a term in either.

    1 for equal fingerprints. Levels that differ by one meet at the higher; any
    further apart give 0.
    """
    k = band.subsets
    parts = [F.split(F.split(x, ":")[1], ",") for x in (a, b)]
    levels = [F.split(x, ":")[0].try_cast("int") for x in (a, b)]
    apart = levels[1] - levels[0]
    mine = F.slice(parts[0], F.when(apart == 1, k + 1).otherwise(1), F.lit(k))
    other = F.slice(parts[1], F.when(apart == -1, k + 1).otherwise(1), F.lit(k))
    same = F.size(F.filter(F.zip_with(mine, other, lambda x, y: (x == y) & (x != "-")), lambda z: z))
    some = F.size(F.filter(F.zip_with(mine, other, lambda x, y: (x != "-") | (y != "-")), lambda z: z))
    return (
        F.when(a == b, 1.0)
        .when((F.abs(apart) <= 1) & (some > 0), same / some)
        .otherwise(0.0)
    )


def _key(docs: DataFrame) -> DataFrame:
    """``__k`` and ``__h`` name a row by its id and text; repeats share them."""
    return docs.select(
        "doc_id",
        whole().alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("__k"),
        F.xxhash64(F.col("doc_id").isNull(), whole()).alias("__h"),
    )


def fingerprint_edits(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness.

    The edited text has its last quarter replaced by the beginning of the next
    document in order of id, after the last of the first. ``docs`` needs
    ``doc_id`` and ``text``; other columns are ignored. Returns ``doc_id,
    n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. NULL texts are empty; NULL ids come first. Rows with one id
    follow by a hash of their texts, and rows that repeat as a whole are one
    document whose results each of them gets. A lone document is its own next.
    An empty table gives no rows.
    """
    keyed = _key(docs)
    known = keyed.groupBy("__k", "__h").agg(
        F.count(F.lit(1)).alias("__copies"),
        F.max(F.length("text")).cast("long").alias("__n"),
        F.max("doc_id").alias("doc_id"),
    )
    ordered = with_neighbours(
        known, ["__k", "__h"], ["__k", "__h", "__n"], "fingerprint-order", circular=True
    )
    places = materialize(
        ordered.select("__k", "__h", "__n", "__copies", "doc_id", "prev", "next"),
        "fingerprint-places",
    )
    member = _membership(lexicon(docs, band))
    # Not row_number: its limit would sort the texts once more before the shuffle.
    alike = Window.partitionBy("__k", "__h").orderBy("__k")
    once = keyed.drop("doc_id").withColumn("__twin", F.lag(F.lit(1)).over(alike)).filter("__twin IS NULL")
    placed = once.join(places, ["__k", "__h"])
    quarter = F.floor(F.col("__n") / 4).cast("int")
    heads = placed.select(
        F.col("prev.__k").alias("__k"),
        F.col("prev.__h").alias("__h"),
        F.substring("text", F.lit(1), F.floor(F.col("prev.__n") / 4).cast("int")).alias("__head"),
    )
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("__n").cast("int") - quarter), F.col("__head")
    )
    kept = (
        placed.join(heads, ["__k", "__h"])
        .withColumn("__edited", edited)
        .select(
            "__k",
            "__h",
            "__n",
            "__copies",
            "doc_id",
            "next",
            F.sha2("__edited", 256).alias("__sha"),
            F.array_sort(terms(F.col("text"))).alias("__t0"),
            F.array_sort(terms(F.col("__edited"))).alias("__t1"),
        )
        .withColumn("__x0", F.xxhash64("__t0"))
        .withColumn("__x1", F.xxhash64("__t1"))
        .withColumn("__kept0", _known_or_all("__t0", member))
        .withColumn("__kept1", _known_or_all("__t1", member))
        .drop("__t0", "__t1")
    )
    for side in ("0", "1"):
        kept = kept.withColumn(f"__level{side}", level_of(F.col(f"__kept{side}")))
        kept = kept.withColumn(f"__sub{side}", subsets(f"__kept{side}", f"__level{side}", band))
    prints = kept.withColumns(
        {
            f"__f{side}": fingerprint(
                f"__kept{side}", f"__sub{side}", f"__level{side}", f"__x{side}"
            )
            for side in ("0", "1")
        }
    )
    narrow = materialize(
        prints.drop(*[f"__{c}{s}" for c in ("kept", "sub", "x", "level") for s in "01"]),
        "fingerprints",
    )
    following = narrow.select(
        F.col("__k").alias("__ak"), F.col("__h").alias("__ah"), F.col("__f0").alias("__fn")
    )
    linked = narrow.withColumn("__ak", F.col("next.__k")).withColumn("__ah", F.col("next.__h"))
    return (
        linked.join(following, ["__ak", "__ah"])
        .withColumn("__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int"))))
        .select(
            "doc_id",
            F.col("__n").alias("n_chars"),
            F.col("__sha").alias("edited_sha256"),
            F.col("__f0").alias("fingerprint"),
            F.col("__f1").alias("edited_fingerprint"),
            likeness(F.col("__f0"), F.col("__f1"), band).alias("near_edited"),
            likeness(F.col("__f0"), F.col("__fn"), band).alias("near_next"),
        )
    )

