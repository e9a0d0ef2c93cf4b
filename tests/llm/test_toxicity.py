import random

import pytest
from frames import awkward, docs, prose, rows

from alambique.llm import toxicity
from alambique.llm.langid import remainder


def grammar(**words):
    return toxicity.Grammar(words or {"idiot": 0.9}, {}, (4, 5), toxicity.CONTEXTS)


@pytest.mark.parametrize(
    ("text", "contexts"),
    [
        ("what an idiot", ["insult"]),
        ("you are an idiot", ["insult target"]),
        ("idiot that you are", ["insult target"]),
        ("he is not an idiot", ["insult negated"]),
        ("not a word of it was said by that idiot", ["insult reported"]),
        ("she said he was an idiot. idiot", ["insult reported", "insult"]),
        ("I will kill you", ["threat target"]),
        ("they kill time", ["threat"]),
        ("nothing here", []),
    ],
)
def test_contexts(text, contexts):
    found = toxicity.Scorer(grammar()).clauses(text)
    assert [c for clause in found for _, c in clause] == contexts


@pytest.mark.parametrize(
    ("text", "contexts"),
    [
        ("you piece of garbage", ["insult target"]),
        ("a piece of cake", []),
        ("du bist zu nichts zu gebrauchen", ["insult target"]),
        ("er ist kein stück dreck", ["insult negated"]),
        ("tu es bon à rien", ["insult target"]),
        ("te voy a partir la cara, hijo de puta", ["threat", "insult"]),
        ("je vais te casser la gueule toi", ["threat target"]),
        ("partir la ropa", []),
        ("hunt down the vermin", ["threat", "insult"]),
    ],
)
def test_phrases_in_four_languages(text, contexts):
    known = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 0.9), {}, (4, 5), toxicity.CONTEXTS)
    found = toxicity.Scorer(known).clauses(text)
    assert [c for clause in found for _, c in clause] == contexts


def test_arcs_multiply_to_the_weight_of_the_longest_phrase():
    draw = random.Random(4)
    for _ in range(200):
        letters = "abc"
        weights = {
            " ".join(draw.choices(letters, k=draw.randrange(1, 5))): draw.choice([0.2, 0.5, 0.9])
            for _ in range(draw.randrange(1, 9))
        }
        phrases = toxicity.Phrases(weights)
        assert all(0 < w <= 1 for _, w in phrases.arcs.values())
        words = draw.choices(letters, k=7)
        for at in range(7):
            found = [(n, weights[" ".join(words[at : at + n])]) for n in range(1, 8 - at)
                     if " ".join(words[at : at + n]) in weights]
            length, weight = phrases.match(words, at)
            assert (length, pytest.approx(weight)) == max(found, default=(0, 0.0))


def test_the_composition_against_its_parts():
    """Each transducer run by itself over random clauses marks the same matches."""
    draw, automaton = random.Random(5), toxicity.Automaton()
    for _ in range(2000):
        symbols = draw.choices(toxicity.SYMBOLS, k=draw.randrange(12))
        expected = []
        for i, x in enumerate(symbols):
            if x not in ("insult", "threat"):
                continue
            negated = "negation" in symbols[max(0, i - 3) : i]
            reported = "report" in symbols[:i]
            mark = "negated" if negated else "reported" if reported else "target" if "target" in symbols else ""
            expected.append((i, f"{x} {mark}".strip()))
        assert list(automaton.run(symbols)) == expected


def test_pairs_of_words_are_learned(spark):
    """Two words that are harmless by themselves and toxic side by side."""
    draw, texts, labels = random.Random(6), [], []
    for i in range(900):
        toxic = int(draw.random() < 1 / 6)
        words = prose(i, 40).split()
        at = draw.randrange(38)
        words[at:at] = ["go", "home"] if toxic else draw.choice([["go"], ["home"], ["home", "go"]])
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    table = docs(spark, rows(texts))
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, truth)
    assert "go home" in model.words and "home" not in model.words
    found = toxicity.score(table, model).collect()
    assert all(r.predicted == labels[r.doc_id][2] for r in found)


def test_texts_without_a_match_need_no_step_for_each_word():
    known = toxicity.Grammar(dict.fromkeys(toxicity.INSULTS, 0.9), {"grob": 0.8}, (4, 5), toxicity.CONTEXTS)
    scorer = toxicity.Scorer(known)
    steps, of_stem = [], scorer._stem
    scorer._stem = lambda w: steps.append(w) or of_stem(w)
    words = [f"w{'abcdefghij'[i % 10]}{chr(0x4E00 + i)}" for i in range(2000)]
    # Words that only begin phrases, all in one clause, and such that end one.
    text = " ".join([*words, "piece", "in", "zu", "good"]) + ". " + " ".join(words) + " of stücke"
    assert list(scorer.clauses(text)) == [] and not steps
    assert scorer.score(text + ". in stücke reißen. grober") > 0.5
    assert set(steps) == {"in", "stücke", "reißen", "grober"}


def test_clauses_left_out_have_no_match():
    """Texts of words that phrases consist of, read with and without leaving any out."""
    draw = random.Random(8)
    known = toxicity.Grammar(
        {**dict.fromkeys(toxicity.INSULTS, 0.9), "a b": 0.7, "a": 0.2, "b c a": 0.6}, {"ab": 0.8, "cab": 0.9}, (2, 3), toxicity.CONTEXTS
    )
    parts = sorted({w for p in (*toxicity.INSULTS, *toxicity.THREATS) for w in p.split()})
    parts += ["a", "b", "c", "abc", "cabin", "ca", "you", "not", "said", "x1y", "it's"] * 4
    quick, slow = toxicity.Scorer(known), toxicity.Scorer(known)
    slow.may_match = lambda words: True
    matched = 0
    for _ in range(3000):
        text = "".join(draw.choice(parts) + draw.choice([" ", " ", " ", ". ", "\n", "-"]) for _ in range(draw.randrange(9)))
        found = list(quick.clauses(text))
        assert found == list(slow.clauses(text))
        matched += bool(found)
    assert 300 < matched < 2900


def test_clauses_and_not_words_are_scored():
    score = toxicity.Scorer(grammar()).score
    assert score("you idiot") > score("an idiot") > 0.5 > score("he is not an idiot")
    assert score("he said idiot") < 0.5 and score("") == 0.02


def test_the_composition_reaches_all_its_states():
    automaton = toxicity.Automaton()
    assert len({s for s, _ in automaton.next}) == 5 * 2 * 2


def learned(spark, n=900):
    """One text in six has a made-up insult in one of many forms."""
    draw = random.Random(2)
    texts, labels = [], []
    for i in range(n):
        toxic = int(draw.random() < 1 / 6)
        words = prose(i, 40).split()
        if toxic:
            words.insert(draw.randrange(40), "grobl" + draw.choice("abcdefgh") + draw.choice("xyz"))
        texts.append(" ".join(words))
        labels.append((i, 1, toxic))
    return docs(spark, rows(texts)), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_stems_are_learned(spark):
    table, labels = learned(spark)
    model = toxicity.fit(table, labels)
    assert any(s.startswith("grob") for s in model.stems)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in toxicity.score(table, model).collect() if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in held)


def test_held_out_labels_are_not_learned(spark):
    table, labels = learned(spark)
    hidden = labels.filter(remainder() == 0)
    assert not toxicity.fit(table, hidden).stems


def test_held_out_english_on_given_rows(spark):
    base = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    english = table.filter("lang = 'en'")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = toxicity.score(english, toxicity.fit(table, labels)).collect()
    judged = [(truth[r.doc_id], r.predicted) for r in found if r.doc_id in truth]
    assert sum(t == p for t, p in judged) >= 0.97 * len(judged)


def test_awkward_rows(spark):
    table = awkward(spark)
    _, labels = learned(spark, 50)
    odd = labels.union(spark.createDataFrame([(None, None, None), (5, 1, None), (5, 0, 1)], labels.schema))
    model = toxicity.fit(table, odd)
    found = toxicity.score(table, model).collect()
    assert len(found) == table.count() and not any(r.predicted for r in found)
    assert toxicity.score(table.limit(0), model).isEmpty()
    assert toxicity.fit(table.limit(0), labels.limit(0)).words
