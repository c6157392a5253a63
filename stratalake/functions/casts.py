"""Tolerant conversions from text: anything unreadable becomes NULL (EXP-1..3)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tried in this order after the ISO form.
DATE_FORMATS = ("yyyyMMdd", "M/d/yyyy", "yyyy/M/d")


def to_int(text: Column, kind: str = "int") -> Column:
    """Whole number or NULL; blank text is NULL. ``kind`` may be ``bigint`` for wide ids."""
    return text.try_cast(kind)


_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?"


def _shape(pattern: str) -> str | None:
    """What text of a date format looks like, None where the format has more than plain numbers."""
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z])", pattern)
    if any(letter and letter not in "yMd" for letter, _, _ in parts):
        return None
    found = [re.escape(other) if other else r"\d{1,2}" if not more else rf"\d{{{1 + len(more)}}}" for _, more, other in parts]
    return f"^{''.join(found)}$" if not re.search("MMM", pattern) else None


def to_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A day of the years 1 to 9999, or NULL. The whole text must be a date: an ISO day, also with a
    valid time of day, or one of ``formats``.

    Text is parsed only by the formats whose shape it has, and once: years out of range are pulled to the day
    next to the range, and those two days are NULL.
    """
    tidy = F.trim(text)
    iso = F.when(tidy.rlike(f"^{_DAY}$"), tidy.try_cast("date")).when(
        tidy.rlike(f"^{_DAY}{_TIME}$"), tidy.try_cast("timestamp_ntz").cast("date"))
    others = []
    for pattern in formats:
        parsed, shape = F.try_to_date(tidy, pattern), _shape(pattern)
        others.append(parsed if shape is None else F.when(tidy.rlike(shape), parsed))
    before, after = F.date_sub(F.lit("0001-01-01").cast("date"), 1), F.date_add(F.lit("9999-12-31").cast("date"), 1)
    near = F.greatest(F.least(F.coalesce(iso, *others), after), before)
    return F.nullif(F.nullif(near, before), after)


def to_decimal(text: Column, precision: int, scale: int) -> Column:
    """Half-up decimal or NULL on bad text or overflow. Exponents are not numbers here."""
    exponent = F.lower(text).contains("e")
    return F.when(~exponent, text.try_cast(f"decimal({precision},{scale})"))
