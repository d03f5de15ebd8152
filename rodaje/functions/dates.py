"""Dates as the sources write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rodaje.functions.text import strip_accents

#: Month names (fixed values).
MONTHS = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"]


def tolerant_timestamp(text: Column) -> Column:
    """A moment written as dd/MM/yyyy, with or without time, or in ISO form; null for anything else, impossible dates included."""
    t = F.trim(text)
    forms = [F.try_to_timestamp(t, F.lit(p)) for p in ("dd/MM/yyyy", "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm")]
    return F.coalesce(*forms, t.try_cast("timestamp"))


def validity(text: Column) -> Column:
    """struct(desde, hasta): the first and last day of the month ('agosto 2026', 'septiembre de 2025') or quarter ('3er trimestre 2026') that a text names; null without one."""
    t = F.lower(strip_accents(text))
    month = F.nullif(F.regexp_extract(t, rf"\b({'|'.join(MONTHS)})\s+(?:de\s+)?(20\d\d)\b", 1), F.lit(""))
    year = F.regexp_extract(t, rf"\b(?:{'|'.join(MONTHS)})\s+(?:de\s+)?(20\d\d)\b", 1).try_cast("int")
    place = F.array_position(F.array(*map(F.lit, MONTHS)), month).cast("int")
    quarter = r"\b([1-4])\s*(?:°|º|er|ro|do|to)?\s*trimestre\s+(?:de\s+|del\s+)?(20\d\d)\b"
    q, q_year = (F.regexp_extract(t, quarter, g).try_cast("int") for g in (1, 2))
    first = F.coalesce(F.make_date(year, place, F.lit(1)), F.make_date(q_year, q * 3 - 2, F.lit(1)))
    last = F.last_day(F.when(month.isNotNull(), first).otherwise(F.add_months(first, 2)))
    return F.struct(first.alias("desde"), last.alias("hasta"))
