"""Language identification with bit-sliced Bloom filters of n-grams.

Each slot of one table has a bit for every language, set where one of the
language's common n-grams hashes to the slot. The bits that all slots of an
n-gram share name at once all languages that contain it. A text's n-grams are
counted by language, and the counts are corrected for the false positives that
the filter of each language gives by how full it is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from alambique.llm.batches import ROWS

UNKNOWN = "und"
#: Code points that are looked at together.
CHUNK = 1 << 20

#: Odd factors that spread code points and n-grams over 64 bits.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_SLOT = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


@dataclass(frozen=True)
class Settings:
    """``rows`` is about the number of training texts of a language, and
    ``min_share`` the part of them that an n-gram must occur in. The table has
    ``2 ** slot_bits`` slots, whatever is learned."""

    n: int = 4
    rows: int = 3000
    min_share: float = 0.01
    slot_bits: int = 20
    hashes: int = 3


@dataclass(frozen=True)
class Filters:
    """``slots`` has words of 64 languages for each slot; ``false_rate`` is the
    chance that an n-gram foreign to a language seems to be in it. ``langs`` has
    the commonest language first."""

    langs: tuple[str, ...]
    slots: np.ndarray | None
    false_rate: np.ndarray
    settings: Settings


def remainder() -> Column:
    """crc32 of ``doc_id`` as text, modulo 5; rows with 0 are held out."""
    known = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return F.coalesce(known, F.lit(-1))


def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _pieces(texts: Sequence[str], n: int) -> Iterator[list[tuple[int, str]]]:
    """Texts with a blank around them, cut so that each n-gram is in one piece."""
    group, size = [], 0
    for owner, text in enumerate(texts):
        padded = f" {text.lower()}  "
        for start in range(0, len(padded), CHUNK):
            piece = padded[start : start + CHUNK + n - 1]
            group.append((owner, piece))
            size += len(piece)
            if size >= CHUNK:
                yield group
                group, size = [], 0
    if group:
        yield group


def grams(
    texts: Sequence[str], n: int, letters: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the n-grams of words and the number of the text each is from.

    Anything but letters is one kind of blank. A gram's second sign is a letter,
    so every text with a letter has one.
    """
    for group in _pieces(texts, n):
        joined = "".join(p for _, p in group).encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(joined, np.uint32)
        lengths = np.array([len(p) for _, p in group])
        owner = np.repeat(np.array([o for o, _ in group]), lengths)
        piece = np.repeat(np.arange(len(group)), lengths)
        is_letter = letters[codes]
        value = np.where(is_letter, codes, 32).astype(np.uint64)
        size = len(codes) - n + 1
        if size <= 0:
            continue
        hashed = np.zeros(size, np.uint64)
        for k in range(n):
            hashed ^= value[k : k + size]
            hashed *= _SPREAD
            hashed ^= hashed >> np.uint64(29)
        whole = (piece[:size] == piece[n - 1 :]) & is_letter[1 : size + 1]
        yield hashed[whole], owner[:size][whole]


def slot_numbers(hashed: np.ndarray, settings: Settings) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - settings.slot_bits)
    for k in range(settings.hashes):
        yield ((hashed * np.uint64(_SLOT[k])) >> shift).astype(np.int64)


def fit(docs: DataFrame, settings: Settings = Settings()) -> Filters:
    """Filters of all languages, from rows that are not held out.

    The training texts are a sample by a hash of the id, about ``rows`` of each
    language, so their number does not grow with the corpus. Only the finished
    table reaches the driver, at most a row for each slot and 64 languages, and
    one row a language before.
    """
    known = docs.filter((remainder() != 0) & F.col("lang").isNotNull())
    counted = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r["lang"]: r["n"] for r in counted}
    langs = tuple(sorted(counts, key=lambda x: (-counts[x], x)))
    words = -(-len(langs) // 64) or 1
    slots = np.zeros((1 << settings.slot_bits, words), np.uint64)
    if not langs:
        return Filters((), slots, np.zeros(0), settings)
    share = {x: settings.rows / counts[x] for x in langs}
    number = F.create_map(*[F.lit(v) for i, x in enumerate(langs) for v in (x, i)])
    chance = F.create_map(*[F.lit(v) for x in langs for v in (x, share[x])])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) / float(1 << 20)
    sample = known.filter(F.col("text").isNotNull() & (draw < chance[F.col("lang")])).select(
        number[F.col("lang")].alias("lang"), "text"
    )

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts that hold each n-gram, and at -1 all texts, summed by task."""
        letters, held = _letters(), defaultdict(list)
        size = 0
        for batch in batches:
            for lang, text in zip(*batch.to_pydict().values()):
                found = [np.zeros(0, np.uint64)]  # a text may have no n-grams
                found += [g for g, _ in grams([text], settings.n, letters)]
                own = np.unique(np.concatenate(found)).view(np.int64)
                held[lang].append(own)
                size += len(own)
                if size > 1 << 22:
                    yield _summed(held)
                    held, size = defaultdict(list), 0
        if held:
            yield _summed(held)

    partial = sample.mapInArrow(count, "lang int, gram long, n long, is_total boolean")
    summed = partial.groupBy("lang", "gram", "is_total").agg(F.sum("n").alias("n"))
    totals = summed.filter("is_total").select("lang", F.col("n").alias("texts"))
    common = (
        summed.filter("NOT is_total")
        .join(F.broadcast(totals), "lang")  # one row a language
        .filter(F.col("n") >= F.greatest(F.lit(2), F.col("texts") * settings.min_share))
        .select("lang", "gram")
    )

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column(0).to_numpy().astype(np.int64)
            hashed = batch.column(1).to_numpy().view(np.uint64)
            for slot in slot_numbers(hashed, settings):
                bit = np.left_shift(np.uint64(1), (lang % 64).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array((lang // 64).astype(np.int32)), pa.array(bit.view(np.int64))],
                    ["slot", "word", "bits"],
                )

    placed = common.mapInArrow(place, "slot long, word int, bits long")
    table = placed.groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    slots[table["slot"].to_numpy(), table["word"].to_numpy()] = (
        table["bits"].to_numpy().astype(np.int64).view(np.uint64)
    )
    full = [(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(langs))]
    return Filters(langs, slots, np.array(full) ** settings.hashes, settings)


def _summed(held: dict[int, list[np.ndarray]]) -> pa.RecordBatch:
    langs, keys, counts, total = [], [], [], []
    for lang, found in held.items():
        gram, n = np.unique(np.concatenate(found), return_counts=True)
        keys += [gram, np.array([-1])]
        counts += [n, np.array([len(found)])]
        langs.append(np.full(len(gram) + 1, lang, np.int32))
        total.append(np.arange(len(gram) + 1) == len(gram))
    columns = [np.concatenate(x) for x in (langs, keys, counts, total)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["lang", "gram", "n", "is_total"]
    )


def predict_texts(
    texts: Sequence[str], model: Filters, letters: np.ndarray
) -> tuple[list[str], list[float]]:
    """Language and score of each text; UNKNOWN and 0 without a letter."""
    total = np.zeros(len(texts))
    hits = np.zeros((len(model.langs), len(texts)))
    for hashed, owner in grams(texts, model.settings.n, letters):
        shared = None
        for slot in slot_numbers(hashed, model.settings):
            found = model.slots[slot]
            shared = found if shared is None else shared & found
        total += np.bincount(owner, minlength=len(texts))
        for i in range(len(model.langs)):
            one = shared[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)
            hits[i] += np.bincount(owner, weights=one, minlength=len(texts))
    if not model.langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    rate = model.false_rate[:, None]
    share = (hits / np.maximum(total, 1) - rate) / (1 - np.minimum(rate, 0.999))
    share = np.clip(share, 0, 1)
    best = share.argmax(axis=0)
    names = [model.langs[b] if t else UNKNOWN for b, t in zip(best, total)]
    return names, [float(s) for s in share[best, np.arange(len(texts))]]


def with_language(docs: DataFrame, model: Filters) -> DataFrame:
    """``docs`` with ``__lang`` and ``__score``, from ``text`` alone.

    The model is a table of fixed size that Spark broadcasts once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.slots)
    small = replace(model, slots=None)
    added = T.StructType.fromDDL("__lang string, __score double")
    schema = T.StructType([*docs.schema, *added])
    text = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, filters = _letters(), replace(small, slots=shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column(text).to_pylist()]
                names, scores = predict_texts(texts, filters, letters)
                found = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *found], schema.names)

    return docs.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Filters) -> DataFrame:
    """Predicted language of each row: ``doc_id, held_out, lang_pred, score``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A row for
    each row, repeats and NULL ids too. A NULL text or one without a letter is
    UNKNOWN with score 0; the score of others is the corrected share of their
    n-grams that the language knows. Ties go to the commoner language. Without
    training texts all are UNKNOWN.
    """
    return with_language(docs.select("doc_id", "text"), model).select(
        "doc_id",
        (remainder() == 0).alias("held_out"),
        F.col("__lang").alias("lang_pred"),
        F.col("__score").alias("score"),
    )


def identified_documents(docs: DataFrame, model: Filters, least: float = 0.3) -> DataFrame:
    """The documents in a known language, with the columns of ``docs``.

    Those of UNKNOWN language go, and those of which the language knows less
    than ``least`` of the n-grams.
    """
    known = (F.col("__lang") != UNKNOWN) & (F.col("__score") >= least)
    return with_language(docs, model).filter(known).select(*docs.columns)
