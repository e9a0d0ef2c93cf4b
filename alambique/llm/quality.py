"""Quality rules, with lines that many documents of a source share.

Lines are normalised and hashed, and the distinct documents of each source that
hold a line are counted: distinct whole texts, so copies count once. Lines above
the limit are removed, and documents that lose most of their words are rejected.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.llm.text import SPACES, ascii_lower, whole, words
from alambique.operators.joins import lookup_join
from alambique.storage import Measured, materialize, materialize_measured


@dataclass(frozen=True)
class Limits:
    """A line is frequent in a source if it is in ``min_docs`` distinct documents
    and in more than ``doc_share`` of the source's distinct documents, or in more
    than ``many_docs`` of them. A document is depleted if less than
    ``left_share`` of its words are left."""

    min_words: int = 50
    max_repeat_percent: int = 50
    min_docs: int = 10
    doc_share: float = 0.05
    many_docs: int = 5000
    left_share: float = 0.3


#: Up to so many frequent lines of all sources are looked up as lists.
LISTED = 20_000

#: Lists that these are dealt to by their hash, so that a line is looked for in one.
BINS = 1024


def normalised(line: Column) -> Column:
    """Words between single blanks, A-Z lower-cased, each number as 0."""
    plain = F.array_join(words(line), " ")
    return F.regexp_replace(ascii_lower(plain), "[0-9]+", "0")


def _described(line: Column) -> Column:
    return F.struct(
        F.xxhash64(normalised(line)).alias("line"),
        F.size(words(line)).alias("words"),
    )


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base figures of each text, its described lines and its hash."""
    text = whole()
    with_words = docs.withColumn("__w", words(text)).withColumn(
        "__lines",
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
    )
    # Windows of three words; those found twice are neighbours once sorted.
    windows = with_words.withColumn(
        "__h",
        F.expr(
            "CASE WHEN size(__w) >= 3 THEN transform(sequence(0, size(__w) - 3), i -> "
            "xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2))) "
            "ELSE CAST(array() AS array<bigint>) END"
        ),
    ).withColumn(
        "__s",
        F.expr(
            "CASE WHEN size(array_distinct(__h)) < size(__h) "
            "THEN array_sort(transform(__h, (h, i) -> struct(h AS h, i AS i))) "
            "ELSE CAST(array() AS array<struct<h:bigint,i:int>>) END"
        ),
    )
    found = windows.withColumn(
        "__at",
        F.expr(
            "CASE WHEN size(__s) = 0 THEN CAST(array() AS array<int>) ELSE array_sort("
            "transform(filter(sequence(0, size(__s) - 1), k -> "
            "get(__s, k).h = get(__s, k - 1).h OR get(__s, k).h = get(__s, k + 1).h), "
            "k -> get(__s, k).i)) END"
        ),
    )
    # Each window covers three words, less those the next one covers.
    covered = F.expr(
        "CASE WHEN size(__at) = 0 THEN 0L ELSE 3L + aggregate(zip_with("
        "slice(__at, 2, size(__at) - 1), slice(__at, 1, size(__at) - 1), "
        "(b, a) -> least(3, b - a)), 0L, (s, x) -> s + x) END"
    )
    letters = F.length(F.translate(text, SPACES, ""))
    marks = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.col("__lines")
    return found.withColumns(
        {
            "__n_words": F.size("__w").cast("long"),
            "__word_chars": letters.cast("long"),
            "__n_symbols": marks.cast("long"),
            "__n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "__n_repeat_words": covered,
            "__described": F.transform(lines, _described),
            "__text": F.xxhash64(text),
        }
    ).drop("__w", "__lines", "__h", "__s", "__at")


def _source() -> Column:
    return F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source"))


def frequent_lines(rows: DataFrame, limits: Limits) -> Measured:
    """``__source`` and ``__line``, a hash, of the frequent lines, from
    ``__source``, ``__described`` and ``__text``."""
    keys = ["__source", "__line"]
    line = F.explode(F.array_distinct("__described.line")).alias("__line")
    held = rows.select("__source", "__text", line)
    # What is in few rows is in few documents; of other lines the texts are counted.
    some = held.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    some = some.filter(F.col("__n") >= limits.min_docs).select(*keys)
    texts = lookup_join(held, some, keys, "left_semi").distinct()
    counts = texts.groupBy(*keys).agg(F.count(F.lit(1)).alias("__docs"))
    totals = (
        rows.select("__source", "__text").distinct()
        .groupBy("__source").agg(F.count(F.lit(1)).alias("__total"))
    )
    limit = F.least(F.col("__total") * limits.doc_share, F.lit(float(limits.many_docs)))
    many = counts.filter(F.col("__docs") >= limits.min_docs)
    frequent = lookup_join(many, totals, "__source", "inner").filter(F.col("__docs") > limit)
    return materialize_measured(frequent.select(*keys), "frequent-lines")


def _bin(line: Column) -> Column:
    return F.pmod(line, F.lit(BINS)).cast("int")


def _binned(lines: DataFrame, key: str) -> DataFrame:
    """``__frequent``: the lines ``__line`` of each key, in the list of their bin."""
    lists = lines.groupBy(key, _bin(F.col("__line")).alias("__bin")).agg(
        F.collect_set("__line").alias("__lines")
    )
    entries = F.map_from_entries(F.collect_list(F.struct("__bin", "__lines")))
    every = F.sequence(F.lit(0), F.lit(BINS - 1))
    named = lists.groupBy(key).agg(entries.alias("__map"))
    return named.select(
        key, F.transform(every, lambda i: F.try_element_at("__map", i)).alias("__frequent")
    )


def _is_frequent(line: Column) -> Column:
    one = F.get("__frequent", _bin(line))
    return F.coalesce(F.array_contains(one, line), F.lit(False))


def _with_lost(rows: DataFrame, frequent: Measured) -> DataFrame:
    """``rows`` with the frequent lines they hold in ``__frequent``, perhaps with
    others of their source, and the words in them."""
    if frequent.rows <= LISTED:
        # Fewer rows and bytes than what was measured.
        lists = replace(frequent, df=_binned(frequent.df, "__source"))
        joined = lookup_join(rows, lists, "__source", "left")
    else:
        # Rows of a source with the same lines hold the same frequent lines.
        named = rows.withColumn("__same", F.xxhash64("__source", "__described"))
        lines = named.select("__same", "__source", F.explode("__described.line").alias("__line"))
        held = lookup_join(lines, frequent, ["__source", "__line"], "left_semi")
        joined = lookup_join(named, _binned(held, "__same"), "__same", "left").drop("__same")
    lost = F.filter("__described", lambda x: _is_frequent(x["line"]))
    lost_words = F.aggregate(lost, F.lit(0).cast("long"), lambda s, x: s + x["words"])
    return joined.withColumn("__lost", lost_words)


def _failed(limits: Limits) -> Column:
    n, repeats = F.col("__n_words"), F.col("__n_repeat_words")
    return (n < limits.min_words) | (repeats * 100 > n * limits.max_repeat_percent)


def _left(limits: Limits) -> Column:
    return (F.col("__n_words") - F.col("__lost")) >= F.col("__n_words") * limits.left_share


def judge(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Base figures and verdict of each document.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are
    ignored. Returns a row for each row: ``doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, words_lost``. A
    NULL or empty text has no words and fails. NULL is a source of its own. Rows
    that repeat count as copies. An empty table gives no rows.
    """
    rows = measured(docs.select("doc_id", "text", _source().alias("__source")))
    stored = materialize(rows.drop("text"), "quality-rows")  # the only pass over texts
    judged = _with_lost(stored, frequent_lines(stored, limits))
    return judged.select(
        "doc_id",
        F.col("__n_words").alias("n_words"),
        F.col("__word_chars").alias("word_chars"),
        F.col("__n_symbols").alias("n_symbols"),
        F.col("__n_dup_lines").alias("n_dup_lines"),
        F.col("__n_repeat_words").alias("n_repeat_words"),
        _failed(limits).alias("base_failed"),
        (~_failed(limits) & _left(limits)).alias("kept"),
        F.col("__lost").alias("words_lost"),
    )


def cleaned_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents kept, with the columns of ``docs`` and without frequent lines.

    ``n_chars``, if there is such a column, counts the text that is left. NULL and
    empty texts fail, as in ``judge``; of rows that repeat all stay or none. Other
    columns stay as they are, whatever their names. An empty table gives no rows.
    The figures are taken once and stored with the texts that pass them.
    """
    rows = measured(docs.withColumn("__source", _source())).withColumn("__failed", _failed(limits))
    text = F.when(~F.col("__failed"), F.col("text")).alias("text")
    own = [text if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    figures = ["__source", "__n_words", "__failed", "__described", "__text"]
    stored = materialize(rows.select(*own, *figures), "quality-texts")
    passed = stored.filter(~F.col("__failed"))
    kept = _with_lost(passed, frequent_lines(stored, limits)).filter(_left(limits))
    lines = F.filter(F.split("text", "\n"), lambda x: ~_is_frequent(F.xxhash64(normalised(x))))
    lossy = F.col("__lost") > 0
    shorter = F.when(lossy, F.array_join(lines, "\n")).otherwise(F.col("text"))
    out = kept.withColumn("__shorter", shorter)
    if "n_chars" in docs.columns:
        counted = F.length("__shorter").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(lossy, counted).otherwise(F.col("n_chars")))
    return out.withColumn("text", F.col("__shorter")).select(*[F.col(f"`{c}`") for c in docs.columns])
