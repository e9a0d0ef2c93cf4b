"""Expressions on texts that several operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space between words, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def whole(text: str | Column = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Array of the words between white space."""
    return F.array_remove(F.split(text, SPACE), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def uniform(seed: str, *parts: Column) -> Column:
    """A draw in (0, 1) that depends on the seed and the parts only."""
    named = F.md5(F.concat_ws("\x1f", F.lit(seed), *parts))
    bits = F.conv(F.substring(named, 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)
