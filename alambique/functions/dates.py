"""Date keys, tolerant date parsing and calendar attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from alambique.functions.text import month_name
from alambique.schemas import UNKNOWN_DATE

# The key pattern, and the formats tried in this order after the
# expected one fails (day-first wins over month-first).
DATE_KEY = "^[0-9]{8}$"
DIGITS = "^[0-9]+$"
FALLBACK_FORMATS = ("dd/MM/yyyy", "MM/dd/yyyy", "yyyyMMdd", "yyyy/MM/dd", "dd-MM-yyyy")


def trimmed_key(key: Column) -> Column:
    return F.trim(key.cast("string"))


def is_date_key(key: Column) -> Column:
    """True for eight digits; a NULL key is not valid."""
    return F.coalesce(key.rlike(DATE_KEY), F.lit(False))


def parse_date(
    text: Column,
    date_format: str = "yyyy-MM-dd",
    fallbacks: Sequence[str] = FALLBACK_FORMATS,
) -> Column:
    """Date by the first format that fits, NULL when none does."""
    return F.coalesce(*[F.try_to_date(text, f) for f in (date_format, *fallbacks)])


def date_key(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def repaired_date_key(key: Column, date: Column) -> Column:
    """The trimmed key when valid, else one built from the date, else NULL."""
    clean = trimmed_key(key)
    return F.when(is_date_key(clean), clean).otherwise(date_key(date))


def key_or_unknown(key: Column, unknown: str = UNKNOWN_DATE) -> Column:
    """The trimmed key when valid, else the key of the unknown date."""
    clean = trimmed_key(key)
    return F.when(is_date_key(clean), clean).otherwise(F.lit(unknown))


def key_class(key: Column) -> Column:
    """Pattern class of a key."""
    return (
        F.when(key.isNull(), "NULL")
        .when(key.rlike(DATE_KEY), "Numérico_8_digitos")
        .when(key.rlike(DIGITS), "Numérico_otro")
        .otherwise("No_numérico")
    )


def calendar_columns(date: Column) -> dict[str, Column]:
    """Attributes of a day as stored in the date dimension."""
    return {
        "Fecha_ID": date_key(date),
        "Fecha": date,
        "Anio": F.year(date),
        "Mes": F.month(date),
        "Nombre_Mes": month_name(F.month(date)),
        "Numero_Semana": F.weekofyear(date),
        "Trimestre": F.concat(F.year(date), F.lit("Q"), F.quarter(date)),
        "Estacionalidad_Factor": season_of_date(date),
    }


def season_of_date(date: Column) -> Column:
    """Cosine season over the year, highest at day 180."""
    return F.cos((F.dayofyear(date) - 180) * 2 * F.pi() / 365)


def season_of_key(key: Column) -> Column:
    """Cosine season from the month and day digits of a key, 1.0 if unreadable."""
    month_day = F.coalesce(F.substring(key, 5, 4).try_cast("int"), F.lit(0))
    return F.when(month_day == 0, 1.0).otherwise(
        F.cos((month_day - 601) * 2 * F.pi() / 1200)
    )
