"""BPE encoding of whole texts, long ones in parallel by tree concatenation.

A text longer than PIECE code points is cut into pieces wherever that falls, also
within a word. The pieces are encoded in tasks of their own and joined again two
by two: around each join a window is encoded anew and grows until both sides agree
with it exactly. The result is that of the library on the whole text.

Why a window is enough: words are found from left to right, so a word start that
one side and the window share is one of the whole text. Within one word, a row of
tokens is the word's encoding if each two neighbours are the encoding of their
texts; the tokens that a window shares with a side carry that over its ends.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from alambique.llm.batches import map_rows
from alambique.llm.text import whole

#: Code points of a piece.
PIECE = 8192

#: Code points that decide where a word ends, also the strings of added tokens.
MARGIN = 20

#: Words and stretches kept with their ids, and the longest of them.
KEPT, SHORT = 1 << 19, 64

#: No normalisation or word goes beyond these characters.
_SPACE = re.compile("[\t-\r ]+")

#: The words of the tokenizer's pattern, for lower-case Latin-1 text.
_LETTER, _NUMBER, _BLANK = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_BLANK}{_LETTER}{_NUMBER}]+"
)


def _byte_names() -> list[str]:
    """The character for each byte: printable ones stand for themselves, the others
    for the next ones from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


#: Characters of the vocabulary for the UTF-8 bytes of each Latin-1 character.
_BYTE_LEVEL = {c: "".join(_byte_names()[b] for b in chr(c).encode()) for c in range(256)}


@dataclass
class Chunk:
    """A text without white space, its ids, and where its words start: places in
    ``ids`` and in ``text``."""

    text: str = ""
    ids: list[int] = field(default_factory=list)
    words: list[tuple[int, int]] = field(default_factory=list)


@dataclass
class Part:
    """A stretch of text: the chunks at its ends, and the ids between them. A
    stretch without white space is only a ``head``."""

    head: Chunk
    middle: list[np.ndarray] = field(default_factory=list)
    tail: Chunk | None = None

    def ids(self) -> np.ndarray:
        ends = [np.array(c.ids, np.uint32) for c in (self.head, self.tail or Chunk())]
        return np.concatenate([ends[0], *self.middle, ends[1]])


class Known(dict):
    """Ids by text; long texts are encoded anew each time."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self._encode = encode

    def __missing__(self, text: str) -> bytes:
        ids = self._encode(text)
        if len(text) <= SHORT:
            self[text] = ids
        return ids


class Encoder:
    """Encodes stretches as the library does, and joins them."""

    def __init__(self, path: str, window: int = 32) -> None:
        self.library = self._load(path)
        self.ending = self.library.model
        # The same merges for stretches within a word.
        self.inner = self._load(path).model
        self.suffix = self.inner.end_of_word_suffix
        if not self.suffix:
            raise ValueError("needs a vocabulary that marks the ends of words")
        self.inner.end_of_word_suffix = None
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.names = {i: name for name, i in vocabulary.items()}
        added = self.library.get_added_tokens_decoder()
        self.added = [added[i].content for i in added]
        self.last = {i for i, name in self.names.items() if name.endswith(self.suffix) or i in added}
        #: Whether ids fit into two bytes where they travel.
        self.narrow = max(self.names) < 1 << 16
        self.window = window
        self.words, self.stretches = Known(self._word), Known(self._stretch)

    @staticmethod
    def _load(path: str) -> Tokenizer:
        library = Tokenizer.from_file(path)
        library.no_truncation()
        library.no_padding()
        return library

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text of any kind, each word or stretch looked up once."""
        return np.frombuffer(self._ids(text), "<u4")

    def _ids(self, text: str) -> bytes:
        latin = text.isascii() or max(text) <= "\xff"
        if latin and not any(name in text for name in self.added):
            # Such text is as it is when composed, and its words are known here.
            parts, known = _WORDS.findall(text.lower()), self.words
        else:
            parts, known = _SPACE.split(text), self.stretches
        found = b"".join(map(known.__getitem__, parts))
        if len(known) > KEPT:
            known.clear()
        return found

    def _word(self, word: str) -> bytes:
        named = word if word.isalnum() and word.isascii() else word.translate(_BYTE_LEVEL)
        return array("I", [t.id for t in self.ending.tokenize(named)]).tobytes()

    def _stretch(self, text: str) -> bytes:
        return array("I", self._encode(text).ids).tobytes()

    def _encode(self, text: str):
        return self.library.encode(text, add_special_tokens=False)

    def chunk(self, text: str) -> Chunk:
        if not text:
            return Chunk()
        encoded, words = self._encode(text), []
        for k, (id_, (start, _)) in enumerate(zip(encoded.ids, encoded.offsets)):
            if k == 0 or encoded.ids[k - 1] in self.last:
                words.append((k, start))
        return Chunk(text, encoded.ids, words)

    def part(self, head: str, middle: np.ndarray, tail: str | None) -> Part:
        return Part(self.chunk(head), [middle], None if tail is None else self.chunk(tail))

    def concatenate(self, parts: list[Part]) -> Part:
        """All parts as one, joined two by two."""
        while len(parts) > 1:
            joined = [self.join(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = joined + parts[2 * len(joined) :]
        return parts[0] if parts else Part(Chunk())

    def join(self, a: Part, b: Part) -> Part:
        if a.tail is None and b.tail is None:
            return Part(self.join_chunks(a.head, b.head))
        if a.tail is None:
            return Part(self.join_chunks(a.head, b.head), b.middle, b.tail)
        between = self.join_chunks(a.tail, b.head)
        if b.tail is None:
            return Part(a.head, a.middle, between)
        ids = np.array(between.ids, np.uint32)
        return Part(a.head, [*a.middle, ids, *b.middle], b.tail)

    def join_chunks(self, a: Chunk, b: Chunk) -> Chunk:
        """The chunk of both texts, from their own encodings."""
        if not a.text or not b.text:
            return b if not a.text else a
        if len(a.text) + len(b.text) <= 2 * (self.window + MARGIN):
            return self.chunk(a.text + b.text)
        return self._within_word(a, b) or self._between_words(a, b)

    def _between_words(self, a: Chunk, b: Chunk) -> Chunk:
        text, middle = a.text + b.text, len(a.text)
        starts = {}
        for k, at in b.words:
            starts.setdefault(middle + at, k)
        wide = self.window
        while True:
            safe = middle - wide - MARGIN
            left = [(k, at) for k, at in a.words if at <= safe and _begins(text, at)]
            k, at = left[-1] if left else (0, 0)
            end = min(len(text), middle + wide + MARGIN)
            inside = self.chunk(text[at:end])
            before = [w for w in a.words if w[0] < k]
            moved = [(k + i, at + place) for i, place in inside.words]
            if end == len(text):
                return Chunk(text, a.ids[:k] + inside.ids, before + moved)
            for i, place in moved:
                j = starts.get(place)
                if j is not None and place <= end - MARGIN and _begins(text, place):
                    ids = a.ids[:k] + inside.ids[: i - k] + b.ids[j:]
                    after = [(i + n - j, middle + p) for n, p in b.words if n >= j]
                    return Chunk(text, ids, before + [w for w in moved if w[0] < i] + after)
            wide *= 2

    def _within_word(self, a: Chunk, b: Chunk) -> Chunk | None:
        """Joins the halves of one run of letters; None if it is no such run."""
        if not a.words or not b.words:
            return None
        first, at = a.words[-1]
        after, until = b.words[1] if len(b.words) > 1 else (len(b.ids), len(b.text))
        left, right = a.text[at:], b.text[:until]
        near = a.text[-MARGIN:] + b.text[:MARGIN]
        if any(name in near for name in self.added):
            return None
        letters = all(x.isalpha() and x.lower().isalpha() for x in (left, right))
        if not (letters and len(left) > 1 and b.words[0] == (0, 0) and _begins(b.text, 0)):
            return None
        one, other = a.ids[first:], b.ids[:after]
        size = 4
        while True:
            x, y = one[-size:], other[:size]
            ends = len(y) == len(other)
            held = "".join(self.names[i] for i in x).removesuffix(self.suffix)
            held += "".join(self.names[i] for i in y).removesuffix(self.suffix if ends else "")
            model = self.ending if ends else self.inner
            ids = [t.id for t in model.tokenize(held)]
            agree = len(x) == len(one) or ids[0] == x[0]
            if agree and (ends or ids[-1] == y[-1]):
                break
            size *= 2
        merged = one[: len(one) - len(x)] + ids + other[len(y) :]
        ids = a.ids[:first] + merged + b.ids[after:]
        moved = len(a.ids[:first]) + len(merged) - after
        words = a.words + [(moved + k, len(a.text) + p) for k, p in b.words[1:]]
        return Chunk(a.text + b.text, ids, words)

    def decode(self, ids: np.ndarray) -> str:
        return self.library.decode(ids.tolist(), skip_special_tokens=False)


def _begins(text: str, at: int) -> bool:
    """Whether the character is one of its own, whatever comes before: it is not
    composed with that, and its lower case is one character."""
    if at >= len(text):
        return True
    c = text[at]
    mark = unicodedata.category(c)[0] == "M" or "\u1160" <= c <= "\u11ff"
    return not mark and len(c.lower()) == 1


def digests(encoder: Encoder, ids: np.ndarray) -> tuple[int, str, str]:
    """Number and hash of the ids, and hash of the text they decode to."""
    decoded = encoder.decode(ids).encode("utf-8", "surrogatepass")
    raw = ids.astype("<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded).hexdigest()


_ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _short(path: str) -> Callable:
    def make():
        encoder = Encoder(path)

        def row(doc_id, text):
            yield doc_id, *digests(encoder, encoder.plain(text))

        return row

    return make


def pieces(long: DataFrame, size: int) -> DataFrame:
    """``row``, ``doc_id``, ``piece`` and ``text`` of the pieces of long texts."""
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    # The number comes before the pieces: it names the text, not the piece.
    named = long.withColumn("row", F.monotonically_increasing_id())
    return named.select("row", "doc_id", F.posexplode(cut).alias("piece", "text"))


_PARTS = "row long, doc_id string, piece int, head string, middle binary, tail string"


def _parts(path: str) -> Callable:
    def make():
        encoder = Encoder(path)

        def row(row, doc_id, piece, text):
            stretches = _SPACE.split(text)
            tail = stretches[-1] if len(stretches) > 1 else None
            middle = encoder.plain(" ".join(stretches[1:-1]))
            if encoder.narrow:
                middle = middle.astype("<u2")
            yield row, doc_id, piece, stretches[0], middle.tobytes(), tail

        return row

    return make


def _joined(parts: DataFrame, path: str) -> DataFrame:
    """One row for each text, from its parts."""
    encoders: dict[str, Encoder] = {}

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        if path not in encoders:
            encoders[path] = Encoder(path)
        encoder, rows = encoders[path], rows.sort_values("piece")
        kind = "<u2" if encoder.narrow else "<u4"
        whole_ = encoder.concatenate(
            [
                encoder.part(head, np.frombuffer(middle, kind), tail)
                for head, middle, tail in zip(rows["head"], rows["middle"], rows["tail"])
            ]
        )
        out = (rows["doc_id"].iloc[0], *digests(encoder, whole_.ids()))
        return pd.DataFrame([out], columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    # Text, as pandas holds integers that may be NULL as inexact numbers.
    return parts.groupBy("row").applyInPandas(join, _ENCODED.replace("doc_id long", "doc_id string"))


def encode(docs: DataFrame, path: str, piece: int = PIECE) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each whole text.

    The ids are those of the ``tokenizers`` file ``path`` without special tokens
    added; the strings of its added tokens are still one id each. ``docs`` needs
    ``doc_id`` and ``text``; other columns are ignored, whatever their names. A
    row for each row, also where ids are NULL or repeat; a NULL text is empty, and
    empty texts and those of white space have no ids. An empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), whole(F.col("text").cast("string")).alias("text"))
    size = F.length("text")
    short = map_rows(rows.filter(size <= piece), _ENCODED, _short(path))
    cut = pieces(rows.filter(size > piece), piece)
    dealt = cut.withColumn("doc_id", F.col("doc_id").cast("string")).repartition("row", "piece")
    parts = map_rows(dealt, _PARTS, _parts(path))
    long = _joined(parts, path).withColumn("doc_id", F.col("doc_id").cast("long"))
    return short.union(long.select(*short.columns))
