"""A Bloom filter of one table's keys, tested where another table is read.

Spark adds filters of this kind by itself to some joins, with a small and selective
side; a load's staged rows are neither. This one is a table: words of 64 bits, each
combined from the keys that fall into it before the shuffle, and dealt to rows of
WORDS words. Rows of the other table meet their word by a broadcast join, so those
without a match, but for a few, never reach a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.operators.joins import BROADCAST_BYTES
from alambique.storage import Measured, materialize_measured

#: Bits for each key, bits that a key sets in its word, and words in a row.
KEY_BITS, SET_BITS, WORDS = 16, 5, 512

#: Share of the rows without a match that pass, at most.
FALSE_POSITIVES = 0.02

_PLACE = "filtro"


@dataclass(frozen=True)
class KeyFilter:
    """Words of a filter over ``keys``, which are compared as ``types``."""

    keys: tuple[str, ...]
    types: tuple[T.DataType, ...]
    rows: DataFrame
    words: int

    def _values(self) -> list[Column]:
        return [F.col(k).cast(t) for k, t in zip(self.keys, self.types)]

    def word(self) -> Column:
        return F.pmod(F.xxhash64(*self._values(), F.lit(_PLACE)), F.lit(self.words))

    def bits(self) -> Column:
        """The bits of a row's key; its six-bit slices are their places."""
        hashed = F.xxhash64(*self._values())
        mask = F.lit(0).cast("long")
        for i in range(SET_BITS):
            place = F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63).cast("long"))
            one = F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))
            mask = mask.bitwiseOR(one)
        return mask

    def might_match(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key may be in the filter; all that are, and at most
        FALSE_POSITIVES of the others. Rows without a complete key are not."""
        own = ["__bucket", "__place", "__bits"]
        placed = df.dropna(subset=list(self.keys)).select(
            "*",
            (self.word() / WORDS).cast("long").alias(own[0]),
            (self.word() % WORDS).cast("int").alias(own[1]),
            self.bits().alias(own[2]),
        )
        joined = placed.join(F.broadcast(self.rows), "__bucket")
        held = F.get("__words", F.col("__place")).bitwiseAND(F.col("__bits"))
        return joined.filter(held == F.col("__bits")).select(*df.columns)


def key_filter(staged: Measured, other: DataFrame, keys: Sequence[str]) -> KeyFilter | None:
    """The filter of the keys of ``staged``, to be tested on ``other``; None if it
    is too large to broadcast, at some 64 million keys."""
    words = max(1, -(-staged.rows * KEY_BITS // 64))
    words = -(-words // WORDS) * WORDS
    if words * 8 > BROADCAST_BYTES:
        return None
    types = tuple(other.schema[k].dataType for k in keys)
    plan = KeyFilter(tuple(keys), types, staged.df, words)
    spark = staged.df.sparkSession
    set_ = staged.df.dropna(subset=list(keys)).select(
        plan.word().alias("word"), plan.bits().alias("bits")
    )
    # A row for every word, so that each list is whole.
    empty = spark.range(words).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    combined = set_.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    listed = combined.groupBy((F.col("word") / WORDS).cast("long").alias("__bucket")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("word") % WORDS).alias("at"), "bits"))).alias("all")
    )
    rows = materialize_measured(listed.select("__bucket", F.col("all.bits").alias("__words")), "key-filter")
    return replace(plan, rows=rows.df)


def prune(target: DataFrame, staged: Measured, keys: Sequence[str]) -> DataFrame:
    """Target rows that may match a staged key; all of them beyond the filter's size."""
    found = key_filter(staged, target, keys)
    return target if found is None else found.might_match(target)
