import random

from pyspark.sql import functions as F

from alambique.llm import chat

EVENTS = "conv_id long, seq long, message long, kind string, role string, text string, node int"


def read(spark, events, **options):
    table = spark.createDataFrame([(*e, 1) for e in events], EVENTS)
    found = chat.read_back(chat.format_chats(table, **options)).collect()
    return {
        r.conv_id: ([(t.role, t.text) for t in r.turns], list(r.loss_texts), r.formatted, r.loss_spans)
        for r in found
    }


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 1, 0, "delta", "user", "Hi"),
        (1, 2, 1, "delta", "assistant", "He"),
        (1, 4, 1, "delta", "assistant", "o"),
        (1, 3, 1, "delta", "assistant", "ll"),
        (1, 3, 1, "delta", "assistant", "ll"),  # delivered twice
        (1, 5, 2, "delta", "user", "more"),
        (1, 6, 3, "delta", "assistant", "gone"),
        (1, 7, 1, "regenerate", "assistant", None),
        (1, 8, 1, "delta", None, "new"),
        (1, 9, 0, "edit", "user", "Bye"),
        (1, 10, 0, "delta", None, "!"),
    ]
    turns, learned, formatted, spans = read(spark, events)[1]
    assert turns == [("user", "Bye!"), ("assistant", "new")]
    assert learned == ["new"]
    (span,) = spans
    assert formatted[span.start : span.start + span.length] == "new"


def test_a_regeneration_reaches_later_blocks(spark):
    far = 5 * chat.BLOCK
    events = [(1, i, i, "delta", "user", str(i)) for i in range(far)]
    events += [(1, far, 3, "regenerate", "user", "again"), (2, 0, 0, "delta", "user", "x")]
    found = read(spark, events)
    assert [t for _, t in found[1][0]] == ["0", "1", "2", "again"]
    assert found[2][0] == [("user", "x")]


def test_control_strings_come_back(spark):
    draw = random.Random(3)
    signs = ["<|", "|>", "\\", "0", "1", "2", "<", "|", "\n", "im_end", "<|im_end|>\n", "é"]
    texts = ["".join(draw.choices(signs, k=draw.randrange(12))) for _ in range(400)]
    roles = ["assistant" if i % 2 else "us\ner<|" for i in range(400)]
    events = [(i // 40, i, i, "delta", r, t) for i, (r, t) in enumerate(zip(roles, texts))]
    found = read(spark, events)
    turns = [t for c in sorted(found) for t in found[c][0]]
    assert turns == list(zip(roles, texts))
    assert [t for c in sorted(found) for t in found[c][1]] == texts[1::2]
    for _, _, formatted, spans in found.values():
        assert formatted.count(chat.END) == 40
        assert all(chat.CONTROL not in formatted[s.start : s.start + s.length] for s in spans)


def test_a_long_conversation_is_in_order(spark):
    n = 10 * chat.BLOCK + 7
    events = spark.range(n).select(
        F.lit(9).cast("long").alias("conv_id"), F.col("id").alias("seq"), F.col("id").alias("message"),
        F.lit("delta").alias("kind"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"),
    )
    (row,) = chat.read_back(chat.format_chats(events)).collect()
    assert row.n_turns == n and list(row.loss_texts) == [str(i) for i in range(n)]
    assert row.formatted[row.loss_spans[-1].start :].startswith(str(n - 1))


def test_awkward_rows(spark):
    events = [
        (None, None, None, None, None, None),
        (1, 1, None, "delta", "user", "first"),
        (1, 2, 1, "delta", "assistant", None),
        (1, 2, 2, "delta", "assistant", "b"),
        (1, 2, 2, "delta", "assistant", "a"),
    ]
    found = read(spark, events)
    assert found[None][0] == [("", "")]
    assert found[1][0] == [("user", "first"), ("assistant", ""), ("assistant", "ab")]
    assert read(spark, []) == {}


def test_tied_and_repeated_turns_stay(spark):
    """Through the log that the query makes of a table of turns."""
    turns = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "user", "c"), (1, 1, "user", "b"),
             (1, 2, "assistant", "<|im_end|>"), (1, None, None, None), (None, 5, "assistant", "x"),
             (2, 7, "assistant", "odd"), (2, 7, "assistant", "odd")]
    table = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    log = chat.replayed(table)
    assert {r.kind for r in log.collect()} == {chat.DELTA, chat.EDIT, chat.REGENERATE}
    found = {r.conv_id: r for r in chat.read_back(chat.format_chats(log)).collect()}
    said = {c: [(t.role, t.text) for t in r.turns] for c, r in found.items()}
    assert said[1] == [("", ""), ("user", "a"), ("user", "a"), ("user", "b"), ("user", "c"),
                       ("assistant", "<|im_end|>")]
    assert said[None] == [("assistant", "x")] and list(found[2].loss_texts) == ["odd", "odd"]
    assert chat.replayed(table.limit(0)).isEmpty()
