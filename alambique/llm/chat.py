"""Chat formatting from a log of events.

Logs are folded by conversation in order of sequence: deltas append to their
message, an edit replaces what the message said, and a regeneration voids what
the log said before of its message and of all later ones. The final messages are
rendered with a template that marks turns, and a loss mask covers the text of
each trained role.

A conversation may hold much of the log, so it is folded in blocks of messages;
only finished segments of it, with running offsets, meet in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alambique.llm.order import numbered
from alambique.storage import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
CONTROL = "<|"
BLOCK = 64

#: Kinds of events; every other kind appends like a delta.
EDIT, REGENERATE, DELTA = "edit", "regenerate", "delta"


def escape(text: Column) -> Column:
    """No control string is left; a backslash starts each escape."""
    marked = F.replace(text, F.lit("\\"), F.lit("\\0"))
    return F.replace(marked, F.lit(CONTROL), F.lit("<\\1|"))


def unescape(text: Column) -> Column:
    marked = F.replace(text, F.lit("\\1"), F.lit(""))
    marked = F.replace(marked, F.lit("\\2"), F.lit("\n"))
    return F.replace(marked, F.lit("\\0"), F.lit("\\"))


def fold(events: DataFrame) -> DataFrame:
    """Final messages of an event log: ``conv_id, __block, message, role, text``.

    ``events`` needs ``conv_id, seq, message`` (whole numbers), ``kind``,
    ``role`` and ``text``; other columns are ignored. An event that comes twice
    counts once. NULL texts are empty, NULL kinds deltas, and NULL numbers come
    before all others. The role is the first one known among a message's valid
    events, else empty. Events with one sequence number follow by kind and text.
    A message whose events are all void is gone.
    """
    block = F.floor(F.coalesce("message", F.lit(-1)) / BLOCK)
    regenerates = F.coalesce(F.col("kind") == REGENERATE, F.lit(False))
    seq = F.coalesce(F.col("seq").cast("long"), F.lit(-(2**63)))
    rows = events.select(
        "conv_id",
        block.alias("__block"),
        F.col("message").cast("long").alias("message"),
        seq.alias("seq"),
        F.when(regenerates, seq).alias("__cut"),
        F.struct(
            seq.alias("seq"),
            F.coalesce("kind", F.lit(DELTA)).alias("kind"),
            F.coalesce("text", F.lit("")).alias("text"),
            F.col("role").alias("role"),
        ).alias("__event"),
    )
    # A regeneration reaches the blocks after its own; the log's texts are not
    # needed for that.
    earlier = (
        Window.partitionBy("conv_id")
        .orderBy("__block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.groupBy("conv_id", "__block")
        .agg(F.max("__cut").alias("__cut"))
        .withColumn("__carried", F.max("__cut").over(earlier))
        .filter(F.col("__carried").isNotNull())
        .select(F.col("conv_id").alias("__conv"), F.col("__block").alias("__b"), "__carried")
    )
    messages = (
        rows.repartition("conv_id", "__block")
        .groupBy("conv_id", "__block", "message")
        .agg(
            F.array_sort(F.array_distinct(F.collect_list("__event"))).alias("__events"),
            F.max("__cut").alias("__cut"),
        )
    )
    upto = (
        Window.partitionBy("conv_id", "__block")
        .orderBy("message")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__block") == F.col("__b"))
    valid = F.filter(
        "__events", lambda e: F.col("__void").isNull() | (e["seq"] >= F.col("__void"))
    )
    cut = (
        messages.withColumn("__own", F.max("__cut").over(upto))
        .join(carried, same, "left")
        .withColumn("__void", F.greatest("__own", "__carried"))
        .withColumn("__valid", valid)
        .filter(F.size("__valid") > 0)
    )
    # What the last edit or regeneration replaced is cut away; the rest appends.
    place = F.expr(
        "array_max(transform(__valid, (e, i) -> "
        f"IF(e.kind IN ('{EDIT}', '{REGENERATE}'), i, 0)))"
    )
    last = F.slice("__valid", F.col("__place") + 1, F.size("__valid"))
    role = F.get(F.filter("__valid", lambda e: e["role"].isNotNull()), F.lit(0))["role"]
    return cut.withColumn("__place", place).select(
        "conv_id",
        "__block",
        "message",
        F.coalesce(role, F.lit("")).alias("role"),
        F.array_join(F.transform(last, lambda e: e["text"]), "").alias("text"),
    )


def replayed(rows: DataFrame) -> DataFrame:
    """An event log that ends in the given turns: ``conv_id, turn, role, text``.

    Each row is a message of its own, in the order of turns and then of roles and
    texts, NULLs first; rows that repeat are repeated messages. A message first says
    something else, which an edit replaces, or for the assistant a regeneration
    voids; what it says in the end comes in two deltas.
    """
    group = F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("grp")
    # Rows that repeat are alike in all but the draw, so they share out evenly.
    drawn = rows.select(group, "conv_id", "turn", "role", "text", F.rand(1).alias("draw"))
    placed = numbered(materialize(drawn, "turns"), ["turn", "role", "text", "draw"], "turn-places")
    half = F.floor(F.length("text") / 2).cast("int")
    replaces = F.when(F.col("role") == "assistant", REGENERATE).otherwise(EDIT)
    said = [
        (F.lit(DELTA), F.lit("one moment")),
        (replaces, F.substring("text", F.lit(1), half)),
        (F.lit(DELTA), F.substring("text", half + 1, F.length("text"))),
    ]
    events = F.array(
        *[
            F.struct(F.lit(i).alias("nth"), kind.alias("kind"), text.alias("text"))
            for i, (kind, text) in enumerate(said)
        ]
    )
    each = placed.df.select("conv_id", "at", "role", F.explode(events).alias("event"))
    seq = F.col("at") * len(said) + F.col("event.nth")
    return each.select(
        "conv_id", seq.alias("seq"), F.col("at").alias("message"), "event.kind", "role", "event.text"
    )


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, formatted, loss_spans``.

    ``messages`` comes from ``fold``. A span has the turn it is in, where that
    turn starts, and the start and length of the trained text, in code points of
    the formatted text and with its escapes.
    """
    header = F.concat(
        F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\2")), F.lit("\n")
    )
    turns = messages.select(
        "conv_id",
        "__block",
        "message",
        (F.col("role") == trained).alias("__trained"),
        header.alias("__head"),
        escape(F.col("text")).alias("__body"),
    ).withColumn("__turn", F.concat("__head", "__body", F.lit(END)))
    own = Window.partitionBy("conv_id", "__block").orderBy("message")
    length = F.length("__turn").cast("long")
    placed = turns.withColumn("__at", F.sum(length).over(own) - length)
    segments = (
        placed.groupBy("conv_id", "__block")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "message",
                        "__at",
                        "__turn",
                        F.length("__head").alias("head"),
                        F.length("__body").alias("body"),
                        F.col("__trained").alias("trained"),
                    )
                )
            ).alias("__turns")
        )
        .select(
            "conv_id",
            "__block",
            F.size("__turns").cast("long").alias("__n"),
            F.array_join(F.col("__turns.__turn"), "").alias("__text"),
            F.expr(
                "filter(transform(__turns, (t, i) -> struct(t.trained, i AS turn, "
                "t.__at AS turn_start, t.__at + t.head AS start, CAST(t.body AS bigint) "
                "AS length)), t -> t.trained)"
            ).alias("__spans"),
        )
        .withColumn("__length", F.length("__text").cast("long"))
    )
    before = (
        Window.partitionBy("conv_id")
        .orderBy("__block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0).cast("long")
    shifted = segments.withColumn(
        "__base", F.coalesce(F.sum("__length").over(before), zero)
    ).withColumn("__first", F.coalesce(F.sum("__n").over(before), zero))
    spans = F.expr(
        "transform(__spans, s -> struct(s.turn + __first AS turn, s.turn_start + __base AS "
        "turn_start, s.start + __base AS start, s.length AS length))"
    )
    gathered = F.array_sort(
        F.collect_list(F.struct("__block", F.col("__text").alias("text"), spans.alias("spans")))
    )
    return (
        shifted.groupBy("conv_id")
        .agg(F.sum("__n").alias("n_turns"), gathered.alias("__parts"))
        .select(
            "conv_id",
            "n_turns",
            F.array_join(F.col("__parts.text"), "").alias("formatted"),
            F.flatten(F.col("__parts.spans")).alias("loss_spans"),
        )
    )


def format_chats(events: DataFrame, trained: str = "assistant") -> DataFrame:
    """Fold an event log and render it; see ``fold`` and ``render``."""
    return render(fold(events), trained)


def read_back(formatted: DataFrame) -> DataFrame:
    """Add ``turns`` (role, text) and ``loss_texts`` to formatted conversations."""
    marker = END.replace("|", r"\|")
    parts = F.split("formatted", marker)
    pieces = formatted.withColumn("__pieces", F.slice(parts, 1, F.size(parts) - 1))
    turns = F.transform("__pieces", _turn)
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(
            F.substring(
                F.get(F.col("__pieces"), s["turn"].cast("int")),
                (s["start"] - s["turn_start"] + 1).cast("int"),
                s["length"].cast("int"),
            )
        ),
    )
    return pieces.withColumns({"turns": turns, "loss_texts": masked}).drop("__pieces")


def _turn(piece: Column) -> Column:
    inner = F.substring(piece, F.lit(len(START) + 1), F.length(piece))
    role = F.substring_index(inner, "\n", 1)
    text = F.substring(inner, F.length(role) + 2, F.length(inner))
    return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
