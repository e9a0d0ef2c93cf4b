"""Label normalisation as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical month names, their English forms, canonical regions.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)
MONTHS_EN = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
REGIONS = (
    "Norte", "Sur", "Este", "Oeste", "Centro",
    "Noreste", "Noroeste", "Sureste", "Suroeste",
)


def _month_labels() -> dict[str, str]:
    """Full name, three letters, three letters with a dot, and English name."""
    labels = {}
    for name, english in zip(MONTHS, MONTHS_EN, strict=True):
        short = name[:3].lower()
        labels.update(dict.fromkeys((name.lower(), short, short + ".", english), name))
    return labels


MONTH_LABELS = _month_labels()
REGION_LABELS = {name.lower(): name for name in REGIONS}


def fold_vowels(text: Column) -> Column:
    """Replace accented lower-case vowels by plain ones."""
    return F.translate(text, "áàäâéèëêíìïîóòöôúùüû", "aaaaeeeeiiiioooouuuu")


def fold_accents(text: Column) -> Column:
    """Remove the Spanish acute accents and the tilde of ñ, keeping case."""
    return F.translate(text, "áéíóúÁÉÍÓÚñÑ", "aeiouAEIOUnN")


def canonical_label(
    text: Column, labels: Mapping[str, str], fold: bool = False
) -> Column:
    """Look a label up by its trimmed lower-case form, else capitalise it."""
    key = F.lower(F.trim(text))
    if fold:
        key = fold_vowels(key)
    lookup = F.map_from_arrays(
        F.array(*[F.lit(k) for k in labels]),
        F.array(*[F.lit(v) for v in labels.values()]),
    )
    return F.coalesce(F.try_element_at(lookup, key), F.initcap(key))


def month_label(text: Column) -> Column:
    return canonical_label(text, MONTH_LABELS)


def region_label(text: Column, labels: Mapping[str, str] = REGION_LABELS) -> Column:
    return canonical_label(text, labels, fold=True)


def month_name(month: Column) -> Column:
    """Spanish name of a month number."""
    return F.try_element_at(F.array(*[F.lit(m) for m in MONTHS]), month)


def abbreviate(text: Column, length: int = 3) -> Column:
    """First letters in upper case, closed by a dot."""
    return F.concat(F.upper(F.substring(text, 1, length)), F.lit("."))
