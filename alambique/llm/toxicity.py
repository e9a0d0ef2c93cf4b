"""Toxicity by a weighted finite-state grammar over clauses.

Two lexical transducers read insults and threats, phrases of any number of words
in four languages, with a weight on each arc; the other words of a clause become
targets, negations, reporting verbs or others. Small transducers that follow one
of these each are composed into one automaton, which is run over every clause with
an insult or threat and tells how it was said. A clause scores by its phrase and
its context; clauses combine as independent causes. Phrases, beginnings of words
and the weights of contexts are learned from labelled rows, starting from a few
common phrases.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alambique.llm.batches import map_rows
from alambique.llm.langid import remainder

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

#: Insults and threats the grammar knows before it learns, by language.
INSULTS = (
    # English
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "scum", "trash", "loser", "losers",
    "pathetic", "worthless", "disgusting", "clown", "bastard", "jerk", "imbecile", "fool", "filth",
    "vermin", "piece of garbage", "piece of dirt", "waste of space", "sick in the head", "good for nothing",
    # German
    "idioten", "trottel", "dummkopf", "abschaum", "versager", "widerlich", "erbärmlich", "wertlos",
    "blödmann", "arschloch", "stück dreck", "dumm wie brot", "zu nichts zu gebrauchen",
    # French
    "imbécile", "crétin", "débile", "abruti", "connard", "salaud", "ordure", "minable", "pauvre type",
    "sale con", "tas de merde", "bon à rien",
    # Spanish
    "idiota", "imbécil", "estúpido", "estúpida", "basura", "escoria", "patético", "asqueroso",
    "pedazo de mierda", "hijo de puta", "inútil de mierda", "no vales nada",
)
THREATS = (
    "kill", "killing", "hurt", "destroy", "shoot", "strangle", "stab", "beat up", "hunt down", "burn alive",
    "umbringen", "töten", "verprügeln", "fertig machen", "kalt machen", "in stücke reißen",
    "tuer", "buter", "égorger", "casser la gueule", "faire la peau", "mettre en pièces",
    "matar", "degollar", "partir la cara", "romper la cara", "hacer pedazos", "acabar contigo",
)
TARGETS = "you your yourself u du dich dir ihr euch tu toi vous usted ustedes vosotros".split()
NEGATIONS = "not never no nobody isn't aren't don't nicht kein keine pas jamais nunca".split()
REPORTS = "said says saying called claimed claims wrote quoted sagte schrieb dit dijo".split()

#: Weight of a pattern known before learning, and of each context.
KNOWN = 0.9
CONTEXTS = {
    "insult": 0.95,
    "insult target": 0.98,
    "insult negated": 0.4,
    "insult reported": 0.4,
    "threat target": 0.7,
    "threat": 0.1,
}
DOUBTFUL = 0.2

_CLAUSE = re.compile(r"[.!?;:,\n]+")
_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


@dataclass(frozen=True)
class Settings:
    """``rows`` bounds the training texts of each label. ``stems`` are the lengths
    of the word beginnings that may be patterns, besides words and pairs of words."""

    rows: int = 10_000
    stems: tuple[int, ...] = (4, 5)
    least_docs: int = 4
    false_patterns: float = 2.0
    least_rate: float = 0.6


@dataclass(frozen=True)
class Transducer:
    """Reads symbols and marks insults and threats. ``final`` marks the clause."""

    start: int
    step: Callable[[int, str], int]
    mark: Callable[[int], str]
    final: bool = False


NEGATION = Transducer(  # covers the three words after it
    0, lambda s, x: 4 if x == "negation" else max(s - 1, 0), lambda s: "negated" if s else ""
)
REPORT = Transducer(  # covers the rest of the clause
    0, lambda s, x: 1 if x == "report" else s, lambda s: "reported" if s else ""
)
TARGET = Transducer(  # anywhere in the clause
    0, lambda s, x: 1 if x == "target" else s, lambda s: "target" if s else "", final=True
)
SYMBOLS = ("other", "insult", "threat", "target", "negation", "report")


class Automaton:
    """The composition of transducers over all states that can be reached."""

    def __init__(self, parts: Sequence[Transducer] = (NEGATION, REPORT, TARGET)):
        self.parts = parts
        self.start = tuple(p.start for p in parts)
        self.next: dict[tuple, tuple] = {}
        todo = [self.start]
        while todo:
            state = todo.pop()
            for x in SYMBOLS:
                if (state, x) not in self.next:
                    after = tuple(p.step(s, x) for p, s in zip(parts, state))
                    self.next[state, x] = after
                    todo.append(after)

    def run(self, symbols: Sequence[str]) -> Iterator[tuple[int, str]]:
        """Place and context of each insult and threat of a clause."""
        state, found = self.start, []
        for i, x in enumerate(symbols):
            state = self.next[state, x]
            if x in ("insult", "threat"):
                marks = [p.mark(s) for p, s in zip(self.parts, state) if not p.final]
                found.append((i, x, marks))
        whole = [p.mark(s) for p, s in zip(self.parts, state) if p.final]
        for i, kind, marks in found:
            # Distance from the speaker outweighs the target.
            said = [m for m in marks if m] or [m for m in whole if m]
            yield i, " ".join([kind, *said[:1]])


class Phrases:
    """A transducer from words to one symbol, with a weight on each arc.

    An arc's weight is the best that phrases over it can still have, divided by what
    the arcs before it have taken; so the weights along a phrase multiply to its own,
    and a path is never worse than its last arc.
    """

    def __init__(self, weights: Mapping[str, float]) -> None:
        #: State 0 is the start; (state, word) leads to (state, weight of the arc).
        self.arcs: dict[tuple[int, str], tuple[int, float]] = {}
        self.final: set[int] = set()
        best: dict[tuple[str, ...], float] = {}
        named = {tuple(p.split()): w for p, w in weights.items() if p.split() and w > 0}
        for phrase, weight in named.items():
            for n in range(len(phrase) + 1):
                best[phrase[:n]] = max(best.get(phrase[:n], 0.0), weight)
        best[()] = 1.0
        states = {prefix: i for i, prefix in enumerate(sorted(best, key=lambda x: (len(x), x)))}
        for prefix, state in states.items():
            if prefix:
                before = prefix[:-1]
                self.arcs[states[before], prefix[-1]] = state, best[prefix] / best[before]
        #: What is left of a phrase's weight where it ends before longer ones.
        self.rest: dict[int, float] = {}
        for phrase, weight in named.items():
            self.final.add(states[phrase])
            self.rest[states[phrase]] = weight / best[phrase]

    def match(self, words: Sequence[str], at: int) -> tuple[int, float]:
        """Length and weight of the longest phrase that starts here; 0 without one."""
        state, weight, found = 0, 1.0, (0, 0.0)
        for n, word in enumerate(words[at:], 1):
            arc = self.arcs.get((state, word))
            if arc is None:
                break
            state, weight = arc[0], weight * arc[1]
            if state in self.final:
                found = n, weight * self.rest[state]
        return found


@dataclass(frozen=True)
class Grammar:
    """``words`` has the weight of each insult, of one word or several, and ``stems``
    that of each beginning of a word, ``contexts`` that of each context; ``quiet`` is
    the score of a text without a match."""

    words: Mapping[str, float]
    stems: Mapping[str, float]
    stem_lengths: tuple[int, ...]
    contexts: Mapping[str, float]
    quiet: float = 0.02


class Scorer:
    def __init__(self, grammar: Grammar):
        self._grammar = grammar
        self._automaton = Automaton()
        self._insults = Phrases(grammar.words)
        self._threats = Phrases(dict.fromkeys(THREATS, 1.0))
        self._starts = {w for part in (self._insults, self._threats) for s, w in part.arcs if s == 0}
        #: Words that may follow the first of a phrase, with it, and those that are one.
        self._seconds: dict[str, set[str]] = {}
        self._alone: set[str] = set()
        for part in (self._insults, self._threats):
            firsts = {s: w for (before, w), (s, _) in part.arcs.items() if before == 0}
            self._alone |= {w for s, w in firsts.items() if s in part.final}
            for (before, w), _ in part.arcs.items():
                if before in firsts:
                    self._seconds.setdefault(firsts[before], set()).add(w)
        self._needed = self._alone.union(self._seconds, *self._seconds.values())
        self._kinds = {w: "target" for w in TARGETS}
        self._kinds |= {w: "negation" for w in NEGATIONS}
        self._kinds |= {w: "report" for w in REPORTS}
        self._stem = lru_cache(1 << 16)(self._of_stem)

    def _of_stem(self, word: str) -> float:
        """Weight of a word by its beginnings; -1 where phrases may start."""
        if word in self._starts:
            return -1.0
        g = self._grammar
        stems = (g.stems.get(word[:n], 0.0) for n in g.stem_lengths if len(word) >= n)
        return max(stems, default=0.0)

    def may_match(self, words: Sequence[str]) -> bool:
        """Whether there may be an insult or threat among words: one of them is a phrase,
        or the first two words of one are there, or one begins with a stem.

        Sets are compared whole, so most texts need no step for each of their words.
        """
        held = self._needed.intersection(words)
        if held and (not self._alone.isdisjoint(held) or any(
            not self._seconds[w].isdisjoint(held) for w in held if w in self._seconds
        )):
            return True
        stems, lengths = self._grammar.stems, self._grammar.stem_lengths
        return bool(stems) and any(not stems.keys().isdisjoint({w[:n] for w in words}) for n in lengths)

    def symbols(self, words: Sequence[str], weights: Sequence[float]) -> list[tuple[str, float]]:
        """The symbols of a clause, one for each phrase or other word, and weights;
        of an insult and a threat that start together the longer one, else the insult."""
        found, at = [], 0
        while at < len(words):
            word, weight = words[at], weights[at]
            length, kind = 0, "insult"
            if weight < 0:
                length, weight = self._insults.match(words, at)
                threat, certain = self._threats.match(words, at)
                if threat > length:
                    length, weight, kind = threat, certain, "threat"
            elif weight > 0:
                length = 1
            if not length and weight <= 0:
                kind = self._kinds.get(word, "other")
            found.append((kind, weight))
            at += max(length, 1)
        return found

    def clauses(self, text: str) -> Iterator[list[tuple[float, str]]]:
        """Weight and context of the matches in each clause that has any."""
        text = text.lower()
        # No word reaches over the end of a clause, so a text has those of its clauses.
        if not self.may_match(_WORD.findall(text)):
            return
        for clause in _CLAUSE.split(text):
            words = _WORD.findall(clause)
            if not self.may_match(words):
                continue
            weights = [self._stem(w) for w in words]
            read = self.symbols(words, weights)
            found = [(read[i][1], c) for i, c in self._automaton.run([x for x, _ in read])]
            if found:
                yield found

    def score(self, text: str) -> float:
        doubt = 1.0
        for clause in self.clauses(text):
            doubt *= 1.0 - max(w * self._grammar.contexts.get(c, DOUBTFUL) for w, c in clause)
        return min(1.0, max(self._grammar.quiet, 1.0 - doubt))


def _sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> tuple[DataFrame, dict]:
    """Texts of at most about ``rows`` labelled rows of each label, not held out,
    with the number of rows that each stands for."""
    known = (
        labels.filter(F.col("toxic").isNotNull() & (remainder() > 0))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    weight = {k: max(1.0, counts.get(k, 0) / settings.rows) for k in (0, 1)}
    draw = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1 << 20)) / float(1 << 20)
    each = F.when(F.col("toxic") == 1, 1 / weight[1]).otherwise(1 / weight[0])
    # At most about two times ``rows`` ids and labels, so they may be broadcast.
    chosen = known.filter(draw < each)
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", F.lower("text").alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id").select("toxic", "text"), weight


def _patterns(text: Column, settings: Settings) -> Column:
    """Distinct words, pairs of words, and beginnings of words with a star."""
    words = F.regexp_extract_all(text, F.lit(r"(\p{L}+(?:'\p{L}+)?)"), F.lit(1))
    pairs = F.zip_with(
        words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b)
    )
    pairs = F.filter(pairs, lambda p: F.contains(p, F.lit(" ")))
    distinct = F.array_distinct(words)
    stems = [
        F.transform(
            F.filter(distinct, lambda w, n=n: F.length(w) >= n),
            lambda w, n=n: F.concat(F.substring(w, 1, n), F.lit("*")),
        )
        for n in settings.stems
    ]
    return F.array_distinct(F.concat(distinct, pairs, *stems))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Grammar:
    """Learn patterns and contexts from rows that are not held out.

    A pattern is learned where the share of toxic texts among those that have it
    is at least ``least_rate``, and where chance would raise the share that far
    in at most ``false_patterns`` of all patterns tried (Chernoff's bound). What
    reaches the driver are the patterns that pass, of at most about two times
    ``settings.rows`` training texts; a pair of words that holds a learned word says
    no more than that and is left out.
    """
    sample, weight = _sample(docs, labels, settings)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(1, 0) * weight[1], sizes.get(0, 0) * weight[0]
    seeds = {w: KNOWN for w in INSULTS}
    if not toxic or not clean:
        return Grammar(seeds, {}, settings.stems, CONTEXTS)
    base = toxic / (toxic + clean)
    mass = F.when(F.col("toxic") == 1, weight[1]).otherwise(weight[0])
    counted = (
        sample.select("toxic", F.explode(_patterns(F.col("text"), settings)).alias("pattern"))
        .groupBy("pattern")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(mass).alias("all"),
            F.sum(F.when(F.col("toxic") == 1, mass)).alias("hits"),
        )
        .filter(F.col("n") >= settings.least_docs)
    )
    tried = F.lit(float(max(1, counted.count())))
    rate = (F.col("hits") + 0.0) / F.col("all")
    p, q = F.least(rate, F.lit(1 - 1e-9)), F.lit(base)
    gain = p * F.log(p / q) + (F.lit(1.0) - p) * F.log((F.lit(1.0) - p) / (F.lit(1.0) - q))
    seeded = F.col("pattern").isin(*INSULTS)
    chance = F.col("n") * gain > F.log(tried / settings.false_patterns)
    learned = (
        counted.filter(F.col("hits") > 0)
        .filter(((rate >= settings.least_rate) & chance) | seeded)
        .select("pattern", "hits", "all")
        .collect()
    )
    words, stems, pairs = dict(seeds), {}, {}
    for r in learned:
        name, star, _ = r["pattern"].partition("*")
        to = stems if star else pairs if " " in name and name not in seeds else words
        to[name] = (r["hits"] + 2 * KNOWN) / (r["all"] + 2)
    words |= {p: w for p, w in pairs.items() if not set(p.split()) & set(words)}
    first = Grammar(words, stems, settings.stems, dict(CONTEXTS))
    return _with_contexts(sample, first, weight)


def _with_contexts(sample: DataFrame, grammar: Grammar, weight: Mapping[int, float]) -> Grammar:
    """Rate of toxic texts by context, among texts with one context only."""

    def make():
        scorer = Scorer(grammar)

        def contexts(toxic, text):
            found = {c for clause in scorer.clauses(text) for _, c in clause}
            return [(toxic, found.pop() if found else "")] if len(found) < 2 else []

        return contexts

    rows = map_rows(sample, "toxic int, context string", make)
    counts: dict[str, list[float]] = {}
    for r in rows.groupBy("context", "toxic").agg(F.count("*").alias("n")).collect():
        pair = counts.setdefault(r["context"], [0.0, 0.0])
        pair[r["toxic"]] += r["n"] * weight[r["toxic"]]
    learned = dict(grammar.contexts)
    for context, (clean, toxic) in counts.items():
        if context:
            prior = learned.get(context, DOUBTFUL)
            learned[context] = (toxic + 2 * prior) / (toxic + clean + 2)
    clean, toxic = counts.get("", (0.0, 0.0))
    quiet = min(0.45, (toxic + 0.5) / (toxic + clean + 1))
    return Grammar(grammar.words, grammar.stems, grammar.stem_lengths, learned, quiet)


def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """Toxicity of each row's whole text, from the text alone.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id, held_out, score, predicted``, a row for each row, repeats and NULL
    ids too. A NULL or empty text and one without a match have the score that
    texts without a match had in training. ``predicted`` is 1 from 0.5 on.
    """

    def make():
        scorer = Scorer(grammar)

        def row(doc_id, held, text):
            s = scorer.score(text or "")
            return [(doc_id, held, s, int(s >= 0.5))]

        return row

    rows = docs.select(
        F.col("doc_id").cast("long"), (remainder() == 0).alias("held_out"), F.col("text").cast("string")
    )
    return map_rows(rows, SCHEMA, make)
