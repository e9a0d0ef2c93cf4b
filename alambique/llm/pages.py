"""Main text of web pages: page structure, then differencing of nearest URLs.

Each page is read once into blocks of text with the zone they stand in. Every page
is paired with its nearest neighbour by URL path within its host, and the lines of
both are aligned by longest common subsequence. Lines that both share are deleted:
all of them where the page marks no article, and within a marked article those that
also recur over the host. Equal pages of a host are paired as one.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from os.path import commonprefix

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from alambique.llm.batches import map_rows
from alambique.llm.order import with_neighbours
from alambique.operators.joins import lookup_join
from alambique.storage import materialize, materialize_measured, scratch_path

#: Elements whose content is no text of the page.
RAW = "script style noscript template title textarea select option button svg math iframe object canvas audio video datalist".split()
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend "
    "li main menu nav ol optgroup p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = frozenset("head nav footer aside form menu dialog fieldset".split())
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split()
)
#: Words in class or id of parts that are not the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus footer gdpr login menu modal nav navbar navigation newsletter "
    "notice notices pager pagination popup promo promoted promotion related respond search share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription teaser toolbar widget".split()
)
#: Words that are noise only outside the article.
OUTER_WORDS = frozenset(["header", "masthead"])
CONTENT_WORDS = frozenset("article content entry post story".split())

#: How surely a zone is the main text.
OPEN, NAMED, MAIN, ARTICLE = range(4)

#: Bits of the rows that an alignment keeps; longer ones are halved first.
KEPT_BITS = 1 << 28

#: A line recurs over a host if it is in so many of its distinct pages, and in this
#: share of them.
RECURS_PAGES, RECURS_SHARE = 5, 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z][^>]*+>|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(
    r"""([a-zA-Z][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?"""
)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass(frozen=True)
class Zone:
    """An open element: what holds for all that stands in it."""

    name: str
    sure: int
    noise: bool


def _zone(name: str, attrs: str, outer: Zone) -> Zone:
    sure, noise = outer.sure, outer.noise
    found = {}
    if attrs and not attrs.isspace():
        for key, *values in _ATTRIBUTE.findall(attrs):
            found[key.lower()] = "".join(values)
    role = found.get("role", "").lower()
    named = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in _NAME_WORDS.findall(named)}
    if name == "article" or role == "article" or found.get("itemprop", "").lower() == "articlebody":
        sure = ARTICLE
    elif name == "main" or role == "main":
        sure = max(sure, MAIN)
    elif words & CONTENT_WORDS and name in ("div", "section"):
        sure = max(sure, NAMED)
    if name in ("html", "body", "main"):
        return Zone(name, sure, noise)
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
    unseen = "display:none" in found.get("style", "").replace(" ", "").lower()
    inside = outer.sure >= MAIN
    noise = (
        noise
        or hidden
        or unseen
        or name in NOISE_TAGS
        or role in NOISE_ROLES
        or (name == "header" and not inside)
        or bool(words & NOISE_WORDS)
        or bool(words & OUTER_WORDS and not inside)
    )
    return Zone(name, sure, noise)


def blocks(page: str) -> Iterator[tuple[str, int, bool]]:
    """Text, certainty and noise of each block, in page order.

    A block ends where an element of block kind starts or ends. Its references
    are decoded and its white space is single blanks. Elements that are not
    closed end with the element around them; a page that breaks off ends all.
    """
    stack = [Zone("", OPEN, False)]
    held: list[str] = []
    at = 0

    def flush() -> Iterator[tuple[str, int, bool]]:
        text = " ".join(html.unescape("".join(held)).split())
        held.clear()
        if text:
            yield text, stack[-1].sure, stack[-1].noise

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in BLOCKS:
            yield from flush()
        if m["end"]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if depth:
                if name not in BLOCKS and any(z.name in BLOCKS for z in stack[depth + 1 :]):
                    continue  # the block that the element stands around goes on
                del stack[depth:]
            continue
        if name in BLOCKS and stack[-1].name != "" and name != "hr":
            # A block that starts ends an open paragraph and what is open in it.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name == "p":
                    del stack[i:]
                    break
                if stack[i].name in BLOCKS:
                    break
        if name == "body":
            del stack[1:]
        if name not in VOID and not (m["attrs"] or "").rstrip().endswith("/"):
            stack.append(_zone(name, m["attrs"], stack[-1]))
    held.append(page[at:])
    yield from flush()


def _rows(a: Sequence[int], b: Sequence[int]) -> Iterator[int]:
    """For each beginning of ``a`` a number whose cleared bits are the places of
    ``b`` at which the longest common subsequence grows."""
    full = (1 << len(b)) - 1
    holds: dict[int, int] = {}
    for j, x in enumerate(b):
        holds[x] = holds.get(x, 0) | 1 << j
    row = full
    for x in a:
        same = row & holds.get(x, 0)
        row = ((row + same) | (row - same)) & full
        yield row


def _lengths(a: Sequence[int], b: Sequence[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    row = 0
    for row in _rows(a, b):
        pass
    raw = np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8)
    grows = 1 - np.unpackbits(raw, bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(grows.astype(np.int64))) if len(a) else np.zeros(len(b) + 1, np.int64)


def _common(a: Sequence[int], b: Sequence[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence, by rows of bits; in memory
    that grows with the lines, as long pages are halved where both halves align best."""
    if len(a) > 1 and len(a) * len(b) > KEPT_BITS:
        half = len(a) // 2
        best = _lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]
        cut = int(best.argmax())
        return _common(a[:half], b[:cut]) + [half + i for i in _common(a[half:], b[cut:])]
    rows = list(_rows(a, b))
    found, i, j = [], len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if i == 0 or rows[i - 1] >> (j - 1) & 1:
            found.append(i)
            j -= 1
    return found[::-1]


def shared_lines(own: Sequence[int], other: Sequence[int]) -> list[int]:
    """Places in ``own`` of the lines that align with lines of ``other``.

    Equal beginnings and ends are set apart first.
    """
    least = min(len(own), len(other))
    head = next((i for i in range(least) if own[i] != other[i]), least)
    rest = least - head
    tail = next((i for i in range(rest) if own[-1 - i] != other[-1 - i]), rest)
    between = _common(own[head : len(own) - tail], other[head : len(other) - tail])
    return [*range(head), *[head + i for i in between], *range(len(own) - tail, len(own))]


def _reader():
    def read(page: str | None) -> tuple[int, list[str], list[int], list[int]]:
        found = list(blocks(page or ""))
        lines = [_signed(xxh3_64_intdigest(t)) for t, _, _ in found]
        usable = [(i, t, sure) for i, (t, sure, noise) in enumerate(found) if not noise]
        best = max((sure for _, _, sure in usable), default=OPEN)
        main = [(i, t) for i, t, sure in usable if sure == best]
        return best, [t for _, t in main], [i for i, _ in main], lines

    return lambda page_id, url, page: [(page_id, url, *read(page))]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _pairer():
    def shared(host, page, path, lines, recurring, before, after):
        near = [
            (len(commonprefix([path, x["path"]])), x["lines"])
            for x in (before, after)
            if x is not None and x["host"] == host
        ]
        if not near:
            return []
        at = shared_lines(lines, max(near, key=lambda x: x[0])[1])
        often = set(recurring or ())
        return [(host, page, at, [i for i in at if lines[i] in often])]

    return shared


def _host() -> Column:
    found = F.regexp_extract("url", r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def _path() -> Column:
    return F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^?#]*)", 1), F.lit(""))


def _recurring(pages: DataFrame) -> DataFrame:
    """``host, page, recurring``: the lines of each distinct page that recur over its
    host, for pages that have any."""
    lines = pages.select("host", "page", F.explode(F.array_distinct("lines")).alias("line"))
    counts = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    many = counts.filter(F.col("n") >= RECURS_PAGES)
    sizes = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = lookup_join(many, sizes, "host", "inner")
    often = often.filter(F.col("n") >= F.col("pages") * RECURS_SHARE).select("host", "line")
    held = lookup_join(lines, often, ["host", "line"], "left_semi")
    return held.groupBy("host", "page").agg(F.collect_set("line").alias("recurring"))


def shared_with_nearest(pages: DataFrame) -> DataFrame:
    """``host, page, shared, often``: places of the lines that a distinct page shares
    with its nearest one, and of those that also recur over the host.

    ``pages`` has ``host``, ``path``, ``page`` (a hash of the lines) and ``lines``, a
    row for each page; equal pages of a host are one, with the first of their paths.
    """
    distinct = materialize(
        pages.groupBy("host", "page").agg(F.min("path").alias("path"), F.first("lines").alias("lines")),
        "distinct-pages",
    )
    recurring = lookup_join(distinct, _recurring(distinct), ["host", "page"], "left")
    near = with_neighbours(
        recurring, ["host", "path", "page"], ["host", "path", "lines"], "page-order"
    )
    return map_rows(
        near.select("host", "page", "path", "lines", "recurring", "prev", "next"),
        "host string, page long, shared array<int>, often array<int>",
        _pairer,
    )


def extract(pages: DataFrame) -> DataFrame:
    """Main text of each page: ``page_id, url, text, n_chars, certainty, n_deleted``.

    ``pages`` needs ``page_id``, ``url`` and ``html``; other columns are ignored.
    A row for each row, repeats and NULL ids too. A NULL or empty page has the
    text "". A NULL URL has the empty host. ``certainty`` tells what marked the
    main text: 3 an article element, 2 a main element, 1 a class or id, 0 nothing.
    Below 2 all lines shared with the nearest page are deleted, from 2 on those that
    recur over the host too; ``n_deleted`` of the main text's. A page whose host has
    no other page loses none, and equal pages have equal texts.
    """
    source = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    read = map_rows(
        source,
        "page_id long, url string, sure int, main array<string>, at array<int>, lines array<long>",
        _reader,
    )
    # Read once: texts are kept for the result, hashes of lines for the pairs.
    named = read.withColumns(
        {"host": _host(), "path": _path(), "page": F.xxhash64("lines")}
    )
    path = scratch_path(pages.sparkSession, "pages")
    named.write.option("compression", "zstd").parquet(path)
    stored = pages.sparkSession.read.schema(named.schema).parquet(path)
    shared = materialize(
        shared_with_nearest(stored.select("host", "path", "page", "lines")), "shared-lines"
    )
    # Texts that lose nothing are not shuffled: marked ones without recurring lines.
    losing = materialize_measured(
        shared.filter(F.size("often") > 0).select("host", "page"), "losing-pages"
    )
    texts, keys = stored.drop("lines", "path"), ["host", "page"]
    marked, open_ = texts.filter(F.col("sure") >= MAIN), texts.filter(F.col("sure") < MAIN)
    some = open_.union(lookup_join(marked, losing, keys, "left_semi"))
    none = F.lit(None).cast("array<int>")
    whole = lookup_join(marked, losing, keys, "left_anti").withColumns({"shared": none, "often": none})
    paired = whole.unionByName(lookup_join(some, shared, keys, "left"))
    gone = F.coalesce(
        F.when(F.col("sure") < MAIN, F.col("shared")).otherwise(F.col("often")), F.array().cast("array<int>")
    )
    own = F.filter(
        F.arrays_zip("main", "at"), lambda x: ~F.array_contains(F.col("__gone"), x["at"])
    )
    left = paired.withColumn("__gone", gone).withColumn("__own", F.transform(own, lambda x: x["main"]))
    return left.withColumn("text", F.array_join("__own", "\n")).select(
        "page_id",
        "url",
        "text",
        F.length("text").cast("long").alias("n_chars"),
        F.col("sure").alias("certainty"),
        (F.size("main") - F.size("__own")).alias("n_deleted"),
    )
