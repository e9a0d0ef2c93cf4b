"""License scan: notice phrases and identifier tags, with license expressions.

An Aho-Corasick automaton finds notice phrases and identifier tags in the words
of a text in one pass. The line after a tag is read as a license expression,
brought to postfix order by a shunting yard and evaluated.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alambique.llm.batches import map_rows

#: Phrases every scan looks for, by their label.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
#: Further notice phrases.
NOTICE_PHRASES = {
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "public domain": "public-domain",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "apache license": "apache",
    "mit license": "mit",
    "bsd license": "bsd",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "proprietary and confidential": "proprietary",
}
#: Words of the tags that a license expression follows. After the first one, which
#: no prose has, names of unknown licenses are taken too if a colon comes between.
TAGS = ("spdx license identifier", "license identifier", "license expression")

#: How far a license opens a text for reuse; unknown names count as closed.
OPENNESS = {
    "public-domain": 1.0, "cc0": 1.0, "unlicense": 1.0,
    "mit": 0.9, "bsd": 0.9, "isc": 0.9, "apache": 0.9, "cc-by": 0.8,
    "mpl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3,
    "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0, "proprietary": 0.0,
}

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, expression string, "
    "openness double"
)

_NON_WORD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
    else b + 32 if 0x41 <= b <= 0x5A
    else 32
    for b in range(256)
)
_LINE = re.compile(rb"[^\n]*")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*")
_PRIORITY = {"or": 1, "and": 2, "with": 3}


def license_family(name: str) -> str:
    """Family of an identifier: its version and suffixes are cut away."""
    name = name.lower().rstrip("+")
    known = [f for f in OPENNESS if name == f or name.startswith((f"{f}-", f"{f}."))]
    return max(known, key=len, default=name)


def to_postfix(expression: str) -> list[str]:
    """Shunting yard; empty where the expression is not well formed."""
    out, stack, operand_next = [], [], True
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if token == "(" and operand_next:
            stack.append(token)
        elif token == ")" and not operand_next:
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return []
            stack.pop()
        elif low in _PRIORITY and not operand_next:
            while stack and _PRIORITY.get(stack[-1], 0) >= _PRIORITY[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
        elif token not in "()" and low not in _PRIORITY and operand_next:
            out.append(token)
            operand_next = False
        else:
            break  # prose after the expression
    if operand_next or "(" in stack:
        return []
    return out + stack[::-1]


#: What tells the name of an unknown license from a word.
_NAME = re.compile("[A-Z0-9.-]")


def is_expression(postfix: list[str], tagged: bool) -> bool:
    """Whether all licenses of an expression are known, or, ``tagged``, look like
    names; what comes after a mention of a tag in prose does not."""
    if not postfix:
        return False
    unknown = evaluate(postfix).names - set(OPENNESS)
    written = {license_family(t): t for t in postfix}
    return not unknown or (tagged and all(_NAME.search(written[n]) for n in unknown))


@dataclass(frozen=True)
class Term:
    openness: float
    names: frozenset[str]


def evaluate(postfix: list[str]) -> Term:
    """OR lets the reader choose the more open side, AND binds to both; an
    exception after WITH opens its license a little."""
    stack: list[Term] = []
    for token in postfix:
        if token not in _PRIORITY:
            family = license_family(token)
            stack.append(Term(OPENNESS.get(family, 0.0), frozenset([family])))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append(Term(min(1.0, left.openness + 0.1), left.names))
        else:
            choose = max if token == "or" else min
            open_ = choose(left.openness, right.openness)
            stack.append(Term(open_, left.names | right.names))
    return stack[-1]


class Scanner:
    """The automaton and what a hit of each of its patterns means."""

    def __init__(self, phrases: Mapping[str, str] = NOTICE_PHRASES):
        self._automaton = ahocorasick.Automaton()
        patterns = {p: ("base", label) for p, label in BASE_PHRASES.items()}
        patterns |= {p: ("notice", label) for p, label in phrases.items()}
        patterns |= {p: ("tag", p) for p in TAGS}
        for phrase, (kind, label) in patterns.items():
            self._automaton.add_word(f" {phrase} ", (phrase, kind, label))
        self._automaton.make_automaton()

    def scan(self, text: str) -> tuple:
        """The fields of SCHEMA after doc_id."""
        raw = text.encode("utf-8", "surrogatepass")
        flat = raw.translate(_NON_WORD)
        found = flat.split()
        joined = (b" %b " % b" ".join(found)).decode("utf-8", "surrogatepass")
        hits = sorted(
            (end - len(phrase), kind, label, phrase.count(" "))
            for end, (phrase, kind, label) in self._automaton.iter(joined)
        )
        if not hits:
            return len(found), 0, None, None, "", "", 0.0, None, None
        base, labels, tag_ends = [], set(), {}
        word, upto = -1, 0
        for at, kind, label, last in hits:
            word += joined.count(" ", upto, at)
            upto = at
            if kind == "tag":
                full = label == TAGS[0]
                tag_ends[word + last] = full or tag_ends.get(word + last, False)
                continue
            labels.add(label)
            if kind == "base":
                base.append((word, label))
        terms = []
        if tag_ends:
            letters = np.frombuffer(flat, np.uint8) != 32
            ends = np.flatnonzero(letters & ~np.append(letters[1:], False)) + 1
            for w, full in sorted(tag_ends.items()):
                colon, rest = _after_tag(raw, ends[w])
                terms.append((to_postfix(rest), full and colon))
        postfix = [p for p, tagged in terms if is_expression(p, tagged)]
        values = [evaluate(p) for p in postfix]
        labels |= {n for v in values for n in v.names}
        openness = [OPENNESS[x] for x in labels if x in OPENNESS]
        whole = min([v.openness for v in values] or openness, default=None)
        # Each kind of evidence halves the doubt; a tag leaves a tenth of it.
        doubt = 0.1 ** len(values[:1]) * 0.5 ** len(labels)
        at = [w for w, _ in base]
        return (
            len(found),
            len(base),
            min(at, default=None),
            max(at, default=None),
            ",".join(sorted({label for _, label in base})),
            ",".join(sorted(labels)),
            1.0 - doubt,
            "; ".join(" ".join(p) for p in postfix) or None,
            whole,
        )


def _after_tag(raw: bytes, at: int) -> tuple[bool, str]:
    """Whether a colon follows a tag's last word, and the rest of its line."""
    line = _LINE.match(raw, at).group().decode("utf-8", "replace")
    rest = line.lstrip(" \t:=\"'")
    return ":" in line[: len(line) - len(rest)], rest


def scan_licenses(
    docs: DataFrame, phrases: Mapping[str, str] = NOTICE_PHRASES
) -> DataFrame:
    """Words, places and labels of the license notices in each text.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. Every row
    gives one row, repeated and NULL ids too. A NULL or empty text has no words
    and no labels. A phrase counts at every place where its words stand next to
    each other. Positions count words from 0 and are NULL without a base phrase.
    ``score`` is the certainty that the text carries a license notice;
    ``expression`` has the well-formed expressions in postfix order, and
    ``openness`` what they, or else the labels, allow at least.
    """
    own = dict(phrases)

    def make():
        scanner = Scanner(own)
        return lambda doc_id, text: [(doc_id, *scanner.scan(text or ""))]

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(rows, SCHEMA, make)
