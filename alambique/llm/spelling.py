"""Groups of spelling variants, found with a bit-sliced position index.

Words that differ by one letter agree in two of their three thirds, so they meet
in a block of words that share those. Within a block the index has, for each
position and letter, a set of words in bits of 64-bit numbers. A word runs over
its letters once: one recurrence keeps the words equal so far, three more those
with one replaced, one extra or one missing letter, which read the index at the
same, the next and the previous position. All words of a number move at once, and
many words run together.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alambique.llm.text import whole
from alambique.operators.joins import lookup_join
from alambique.storage import materialize, materialize_measured

#: Letters of a word; in lower case there are 26 + 64 of them.
RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
LETTERS = 26 + 64

#: Every so many-th run of a document loses a letter.
LOSS = 31

#: Fewest letters and uses of a word, and how much more often its form is used.
LEAST_LETTERS, LEAST_USES, TIMES = 7, 2, 10

#: Distinct words held before they are handed on, and words indexed together.
HELD, INDEXED = 1 << 16, 1 << 13

#: Bits of one number, and pairs of a word and a number that run together.
BITS, TOGETHER = 64, 1 << 18


def edited(doc_id: int | None, run: str) -> str:
    """The run, without one letter if the document's hash says so."""
    named = f"{'' if doc_id is None else doc_id}:{run}".encode()
    crc = zlib.crc32(named)
    if crc % LOSS:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """``word`` and ``n``, its uses; words of too few letters or uses go."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1)):
                doc_id = id_.as_py()
                raw = text.as_py().encode("utf-8", "surrogatepass").translate(_LOWER)
                runs = Counter(RUNS.findall(raw.decode("utf-8", "surrogatepass")))
                for one, n in runs.items():
                    if len(one) >= LEAST_LETTERS:
                        word = edited(doc_id, one)
                        if len(word) >= LEAST_LETTERS:
                            counts[word] += n
                if len(counts) >= held:
                    yield _counted(counts)
                    counts.clear()
        if counts:
            yield _counted(counts)

    rows = docs.select(F.col("doc_id").cast("long"), whole(F.col("text").cast("string")))
    counted = rows.mapInArrow(run, "word string, n long")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    return total.filter(F.col("n") >= LEAST_USES)


def _counted(counts: Counter) -> pa.RecordBatch:
    columns = [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def _keyed(words: DataFrame) -> DataFrame:
    """Each word in its blocks: ``short``, the letters of the block's shorter words,
    ``kind``, the thirds that are equal, and ``key``, their letters.

    A block's words have ``short`` letters or one more. Two words of one length
    meet where that is ``short``.
    """
    blocks = """
        array(
          struct(0 AS kind, left(word, a + b) AS key),
          struct(1 AS kind, concat(left(word, a), ' ', right(word, c)) AS key),
          struct(2 AS kind, right(word, b + c) AS key))
    """
    short = F.explode(F.expr("array(length(word) - 1, length(word))")).alias("short")
    thirds = words.select("word", "n", short).withColumns(
        {"a": F.expr("short div 3"), "b": F.expr("short div 3")}
    )
    return (
        thirds.withColumn("c", F.expr("short - a - b"))
        .withColumn("block", F.explode(F.expr(blocks)))
        .select("short", "block.kind", "block.key", "word", "n")
    )


def _dealt(keyed: DataFrame, indexed: int) -> DataFrame:
    """Rows with ``part``, the part of their block's index, and ``own``, whether
    they are in it. Blocks of more than ``indexed`` words have several parts, each
    of which all the block's words are looked up in."""
    keys = ["short", "kind", "key"]
    large = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > indexed)
    parts = materialize_measured(
        large.select(*keys, F.ceil(F.col("rows") / indexed).cast("int").alias("parts")), "hot-blocks"
    )
    if not parts.rows:
        return keyed.withColumns({"part": F.lit(0), "own": F.lit(True)})
    joined = lookup_join(keyed, parts, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    home = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    return joined.select(*keys, "word", "n", spread, home.alias("home")).select(
        *keys, "word", "n", "part", (F.col("home") == F.col("part")).alias("own")
    )


def _letters(words: list[str], width: int) -> np.ndarray:
    """A row a word and a letter a column, LETTERS beyond a word's end."""
    raw = np.array([w.encode("latin-1") for w in words], f"S{width}")
    raw = raw.view(np.uint8).reshape(len(words), width)
    low = np.where(raw >= 0xC0, raw - np.uint8(0xC0 - 26), raw - np.uint8(97))
    return np.where(raw == 0, np.uint8(LETTERS), low)


class PositionIndex:
    """Sets of words by slot of 64 words, position and letter."""

    def __init__(self, letters: np.ndarray, short: int, slot: np.ndarray, bit: np.ndarray) -> None:
        self.width = letters.shape[1] + 1
        word, at = np.nonzero(letters < LETTERS)
        key = self._key(slot[word], at, letters[word, at])
        order = np.argsort(key, kind="stable")
        key, bits = key[order], bit[word[order]]
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        self.keys, self.sets = key[starts], np.bitwise_or.reduceat(bits, starts)
        slots = int(slot[-1]) + 1
        self.all, self.short = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        np.bitwise_or.at(self.all, slot, bit)
        few = letters[:, -1] == LETTERS  # as wide as the longer words
        np.bitwise_or.at(self.short, slot[few], bit[few])

    def _key(self, slot: np.ndarray, at: np.ndarray | int, letter: np.ndarray) -> np.ndarray:
        return (slot * self.width + at) * LETTERS + letter

    def at(self, slot: np.ndarray, at: int, letter: np.ndarray) -> np.ndarray:
        """The words with this letter at this position, for each slot."""
        if at < 0 or at >= self.width:
            return np.zeros(len(slot), np.uint64)
        key = self._key(slot, at, letter)
        place = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
        return np.where(self.keys[place] == key, self.sets[place], np.uint64(0))


def near_sets(
    index: PositionIndex, short: int, slot: np.ndarray, letters: np.ndarray, length: int, kind: np.ndarray
) -> np.ndarray:
    """For each word and slot, the words of the slot that are one edit away.

    Blocks of kind 1 leave out the words whose first two thirds are equal, and
    those of kind 2 also the ones whose first and last are: kinds 0 and 1 have them.
    """
    third = short // 3
    same = index.all[slot]
    replaced, extra, missing = (np.zeros(len(slot), np.uint64) for _ in range(3))
    known = np.zeros(len(slot), np.uint64)
    for i in range(length):
        if i == third:
            known = np.where(kind == 2, same, known)
        if i == 2 * third:
            known = np.where(kind == 1, same, known)
        letter = letters[:, i]
        equal, later, before = (index.at(slot, i + k, letter) for k in (0, 1, -1))
        replaced = (replaced & equal) | (same & ~equal)
        extra = (extra | same) & later
        missing = (missing & before) | same
        same = same & equal
    extra |= same
    shorter, longer = index.short[slot], index.all[slot] & ~index.short[slot]
    if length == short:
        found = (replaced & shorter) | (extra & longer)
    else:
        found = missing & shorter
    return found & ~known


def _slots(block: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot and bit of each indexed row, and the first slot of each block and what
    comes after the last; rows are in the order of their blocks."""
    sizes = np.bincount(block[own], minlength=int(block[-1]) + 1)
    slots = -(-sizes // BITS)
    first = np.append(0, np.cumsum(slots))
    inside = block[own]
    nth = np.arange(len(inside)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return first[inside] + nth // BITS, np.uint64(1) << (nth % BITS).astype(np.uint64), first


def compare(
    short: int, kind: np.ndarray, block: np.ndarray, words: list[str], own: np.ndarray, asks: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows that have near words in their blocks: the row, how many, and the row of
    the best one. ``own`` rows are indexed, those that ask are looked up. Rows are
    in the order of their blocks; a block's indexed rows are in the order of
    descending uses and then of words."""
    letters = _letters(words, short + 1)
    lengths = (letters < LETTERS).sum(axis=1)
    slot, bit, first = _slots(block, own)
    indexed = np.flatnonzero(own)
    if not len(indexed):
        return
    holder = np.full(int(first[-1]) * BITS, -1)
    holder[slot * BITS + _bit_number(bit)] = indexed
    index = PositionIndex(letters[indexed], short, slot, bit)
    slots = np.diff(first)
    for length in (short, short + 1):
        rows = np.flatnonzero((lengths == length) & asks)
        ends = np.cumsum(slots[block[rows]])
        at = 0
        while at < len(rows):
            done = ends[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(ends, done + TOGETHER, "right")))
            times = slots[block[rows[at:end]]]
            row = np.repeat(rows[at:end], times)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            there = first[block[row]] + nth
            at = end
            found = near_sets(index, short, there, letters[row], length, kind[row])
            hit = np.flatnonzero(found)
            if not len(hit):
                continue
            row, there, found = row[hit], there[hit], found[hit]
            best = holder[there * BITS + _bit_number(found & (~found + np.uint64(1)))]
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            total = np.add.reduceat(np.bitwise_count(found).astype(np.int64), starts)
            # A block's slots are in the order of their words, so the first has the best.
            yield row[starts], total, best[starts]


def _bit_number(one: np.ndarray) -> np.ndarray:
    """The place of the only bit that is set."""
    return np.bitwise_count(one - np.uint64(1)).astype(np.int64)


#: Rows, and letters in them, that are read before blocks are compared.
ROWS, READ = 1 << 15, 1 << 22


def near_words(dealt: DataFrame) -> DataFrame:
    """``word``, ``near``, the number of near words in a part of a block, and the
    best of them with its uses, ``form`` and ``uses``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, seen = None, 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                now = pa.Table.from_batches([batch.slice(at, ROWS)])
                rest = now if rest is None else pa.concat_tables([rest, now])
                if rest.num_rows >= ROWS or rest.nbytes >= READ:
                    ready, kept, looked_up = _whole_blocks(rest)
                    yield from _results(ready, seen)
                    rest, seen = kept, looked_up if ready.num_rows else seen
        if rest is not None:
            yield from _results(rest, seen)

    keys = ["short", "kind", "key", "part"]
    spread = dealt.repartition(*keys).sortWithinPartitions(*keys, F.desc("own"), F.desc("n"), "word")
    return spread.select(*keys, "own", "word", "n").mapInArrow(
        run, "word string, near long, form string, uses long"
    )


def _block_starts(rows: pa.Table) -> np.ndarray:
    """Whether each row is the first one of its part of a block."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for name in ("short", "kind", "part"):
        column = rows.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    key = np.array(rows.column("key").to_pylist(), object)
    new[1:] |= key[1:] != key[:-1]
    return new


def _whole_blocks(rows: pa.Table) -> tuple[pa.Table, pa.Table, int]:
    """The rows to compare now, those to keep, and how many of these have been
    looked up. The last block may go on: it waits, or if all its index is there,
    only that is kept, for the rows still to come."""
    last = int(np.flatnonzero(_block_starts(rows))[-1])
    own = rows.column("own").to_numpy(zero_copy_only=False)[last:]
    if own.all():
        return rows.slice(0, last), rows.slice(last), 0
    return rows, rows.slice(last, int(own.sum())), int(own.sum())


def _results(rows: pa.Table, seen: int) -> Iterator[pa.RecordBatch]:
    """Results of whole blocks, the first ``seen`` rows only as their index."""
    if not rows.num_rows:
        return
    short = rows.column("short").to_numpy()
    edges = np.flatnonzero(np.append(True, short[1:] != short[:-1]))
    for start, end in zip(edges.tolist(), [*edges[1:].tolist(), rows.num_rows]):
        some = rows.slice(start, end - start)
        block = np.cumsum(_block_starts(some)) - 1
        words, n = some.column("word").to_pylist(), some.column("n").to_numpy()
        own = some.column("own").to_numpy(zero_copy_only=False)
        asks = np.arange(start, end) >= seen
        names, kind = np.array(words, object), some.column("kind").to_numpy()
        for row, near, best in compare(int(short[start]), kind, block, words, own, asks):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[row], pa.string()),
                    pa.array(near, pa.int64()),
                    pa.array(names[best], pa.string()),
                    pa.array(n[best], pa.int64()),
                ],
                ["word", "near", "form", "uses"],
            )


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of its chain of ``form``s.

    Each round doubles the steps taken. Forms are used TIMES as often as their
    words, so chains are short and have no circle.
    """
    at = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        known = materialize(lookup_join(at, further, "root", "left"), "roots")
        if known.filter(F.col("next").isNotNull()).isEmpty():
            return at
        at = known.select("word", F.coalesce("next", "root").alias("root"))


def variants(docs: DataFrame, indexed: int = INDEXED) -> DataFrame:
    """Words, the forms they are taken for, and the roots these lead to.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored, whatever
    their names. Returns ``word, form, root, n, n_near, form_n``. NULL texts are
    empty; a NULL id is written as nothing where it is hashed; rows that repeat
    count again. Of near words with equal uses the first in code-point order is
    the form. An empty table, or one without such words, gives no rows.
    """
    words = materialize(word_counts(docs), "words")
    dealt = _dealt(materialize(_keyed(words), "word-blocks"), indexed)
    best = F.min(F.struct((-F.col("uses")).alias("less"), "form")).alias("best")
    near = near_words(dealt).groupBy("word").agg(F.sum("near").alias("n_near"), best)
    uses = -F.col("best.less")
    taken = uses >= TIMES * F.col("n")
    judged = lookup_join(words, near, "word", "left").select(
        "word",
        F.when(taken, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, uses).alias("form_n"),
    )
    judged = materialize(judged, "variants")
    roots = _roots(judged.filter(F.col("form").isNotNull()))
    out = lookup_join(judged, roots, "word", "left")
    root = F.coalesce("root", "word").alias("root")
    return out.select("word", "form", root, "n", "n_near", "form_n")
