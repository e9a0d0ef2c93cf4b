"""Mix sources to target weights by weighted sampling without replacement.

Each source gets a target of words in proportion to its weight, at most a given
number of times its own size. It is repeated in complete epochs first; what
remains is drawn by Efraimidis-Spirakis sampling: every document has an
exponential key scaled by its quality, and the documents with the smallest keys
are taken until the budget is full. The document on the border gives its first
words.

No task sorts a source: prefix sums over sections of the keys find the section
in which the budget ends, and only that section's documents are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alambique.llm.text import uniform, whole, word_count, words
from alambique.operators.joins import lookup_join
from alambique.storage import Measured, materialize, materialize_measured

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"

#: Sections of a source by key.
SECTIONS = 4096


def quality(text: Column) -> Column:
    """1 for plain text, less the more signs of markup stand among its letters."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.lit(1.0) / (F.lit(1.0) + marks * 20.0 / (F.length(text) + 1.0))


def targets(
    sizes: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    budget: int | None = None,
) -> DataFrame:
    """Add ``target`` to a table of ``source`` and ``source_size``.

    Sources in code point order, NULL last, take the weights in turn and share
    ``budget``, by default all sizes. A target above ``max_repeats`` times its
    source's size stops there, and the excess is shared among the others by
    weight until none is above. The table has one row a source and is ordered in
    one task.
    """
    everywhere = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights) + 1
    weight = F.element_at(F.array(*map(F.lit, weights)), turn).cast("long")
    total = F.sum("source_size").over(everywhere) if budget is None else F.lit(budget)
    weighed = sizes.select(
        "source",
        "source_size",
        weight.alias("weight"),
        (F.col("source_size") * max_repeats).alias("cap"),
        total.alias("total"),
        F.row_number().over(order).alias("nth"),
    )
    # Sources stop in this order. If all before one have stopped, it and those
    # after it share what is left at one level; the first that does not stop at
    # its level sets it for good.
    stops = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    stopped = F.sum("cap").over(stops) - F.col("cap")
    rest = F.sum("weight").over(everywhere) - F.sum("weight").over(stops)
    level = (F.col("total") - stopped) / (rest + F.col("weight"))
    levels = weighed.withColumn("level", level).withColumn(
        "stop", F.row_number().over(stops)
    )
    below = F.col("cap") >= F.col("level") * F.col("weight")
    first = F.min(F.when(below, F.struct("stop", "level"))).over(everywhere)
    share = first["level"] * F.col("weight")
    cap = F.col("cap").cast("double")
    return levels.withColumn("target", F.least(cap, F.coalesce(share, cap))).select(
        "source", "source_size", "target"
    )


def _draws(docs: DataFrame, seed: str) -> DataFrame:
    """``docs`` with ``__size``, sampling ``__key``, ``__id`` and ``__source``."""
    text = whole()
    parts = (F.col("doc_id"), F.col("source"), F.length(text))
    draw = uniform(seed, *(p.cast("string") for p in parts))
    return docs.withColumns(
        {
            "__size": word_count(text),
            "__key": -F.log(draw) / quality(text),
            "__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))),
            "__source": _named(),
        }
    )


def _plan(
    rows: DataFrame, weights: Sequence[int], max_repeats: int, budget: int | None
) -> Measured:
    """Per source its target, epochs, and the document where the budget ends.

    ``rows`` has ``source`` and the narrow columns of ``_draws``.
    """
    sizes = rows.groupBy("source").agg(F.sum("__size").alias("source_size"))
    goals = targets(sizes, weights, max_repeats, budget)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
    epochs = F.floor(F.coalesce(epochs, F.lit(0.0)))
    rest = F.floor("target") - F.col("__epochs") * F.col("source_size")
    goals = goals.withColumn("__source", _named()).drop("source")
    goals = goals.withColumn("__epochs", epochs).withColumn("__rest", rest)
    goals = materialize_measured(goals, "mix-targets")
    section = F.floor((F.lit(1.0) - F.exp(-F.col("__key"))) * SECTIONS)
    sections = (
        rows.groupBy("__source", section.alias("__section"))
        .agg(F.sum("__size").alias("__n"))
        .withColumn(
            "__start",
            F.sum("__n").over(Window.partitionBy("__source").orderBy("__section"))
            - F.col("__n"),
        )
    )
    inside = F.col("__rest") - F.col("__start")
    border_sections = (
        lookup_join(sections, goals, "__source", "inner")
        .filter((inside >= 0) & (inside < F.col("__n")))
        .select("__source", "__section", inside.alias("__inside"))
    )
    found = lookup_join(
        rows.withColumn("__section", section), border_sections, ["__source", "__section"], "inner"
    )
    # Rows that repeat as a whole share what is left among them.
    order = Window.partitionBy("__source").orderBy("__key", "__id", "__size")
    groups = found.groupBy("__source", "__inside", "__key", "__id", "__size").agg(
        F.count(F.lit(1)).alias("__rows")
    )
    words_in = F.col("__size") * F.col("__rows")
    left = F.col("__inside") - (F.sum(words_in).over(order) - words_in)
    border = (
        groups.withColumn("__left", left)
        .filter((F.col("__left") >= 0) & (F.col("__left") < words_in))
        .select(
            "__source",
            F.col("__key").alias("__border_key"),
            F.col("__id").alias("__border_id"),
            F.col("__size").alias("__border_size"),
            F.floor(F.col("__left") / F.col("__rows")).alias("__part"),
        )
    )
    return materialize_measured(goals.df.join(border, "__source", "left"), "mix-plan")


def _named() -> Column:
    """The source as a key that NULL has too."""
    return F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("s"), "source"))


def _repeats() -> tuple[Column, Column]:
    """Whole times a row is taken, and words of it after those."""
    own = F.struct("__key", "__id", "__size")
    border = F.struct(
        F.col("__border_key").alias("__key"),
        F.col("__border_id").alias("__id"),
        F.col("__border_size").alias("__size"),
    )
    before = F.col("__border_key").isNotNull() & (own < border)
    whole_times = F.col("__epochs") + before.cast("long")
    part = F.when(own == border, F.col("__part")).otherwise(0)
    return whole_times, part


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    budget: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """Words the mix takes of each document, repeats counted.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns are
    ignored. Returns ``doc_id, size, source, source_size, target, taken`` and
    the sampling ``key``, a row for each row of ``docs``. A NULL or empty text
    has size 0 and nothing is taken of it. Draws depend on seed, id, source and
    text length only, so reruns agree; equal draws follow by id and size, and
    rows that repeat as a whole get equal parts. NULL is a source of its own. A
    source without words has target 0. An empty table gives no rows.
    """
    narrow = _draws(docs.select("doc_id", "source", "text"), seed).drop("text")
    rows = materialize(narrow, "mix-rows")  # the only pass over the texts
    joined = lookup_join(rows, _plan(rows, weights, max_repeats, budget), "__source", "inner")
    times, part = _repeats()
    return joined.select(
        "doc_id",
        F.col("__size").alias("size"),
        "source",
        "source_size",
        "target",
        (times * F.col("__size") + part).cast("long").alias("taken"),
        F.col("__key").alias("key"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    budget: int | None = None,
    seed: str = SEED,
) -> DataFrame:
    """The documents of the mix, with the columns of ``docs``.

    A document comes once for each whole time it is taken. The one on a source's
    border comes once more with its first words, between single blanks;
    ``n_chars``, if there is such a column, then counts those. The rest is as in
    ``mix``. The texts are not shuffled: keys are computed again.
    """
    narrow = _draws(docs.select("doc_id", "source", "text"), seed).drop("text")
    rows = materialize(narrow, "mix-rows")
    plan = _plan(rows, weights, max_repeats, budget)
    side = Measured(plan.df.drop("source_size", "target"), plan.rows, plan.size)
    joined = lookup_join(_draws(docs, seed), side, "__source", "inner")
    times, part = _repeats()
    head = F.array_join(F.slice(words(whole()), 1, part.cast("int")), " ")
    copies = F.array_repeat(F.struct(F.col("text"), F.lit(False).alias("cut")), times.cast("int"))
    cut = F.when(part > 0, F.array(F.struct(head.alias("text"), F.lit(True).alias("cut"))))
    every = F.concat(copies, F.coalesce(cut, F.array().cast(_COPIES)))
    taken = joined.withColumn("__copy", F.explode(every))
    changed = {"text": F.col("__copy.text")}
    if "n_chars" in docs.columns:
        own = F.col("n_chars")
        counted = F.length("__copy.text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("__copy.cut"), counted).otherwise(own)
    return taken.withColumns(changed).select(*docs.columns)


_COPIES = "array<struct<text:string,cut:boolean>>"
