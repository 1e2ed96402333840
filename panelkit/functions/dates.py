"""Date column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelkit.functions.names import strip_blank

# Tried in this order; the first that fits wins, anything else is null.
DATE_FORMATS = (
    "yyyy-M-d",
    "yyyy/M/d",
    "M/d/yyyy",
    "yyyyMMdd",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d MMMM yyyy",
)
# An ISO date with a time of day, and perhaps a zone, stands for the date as written.
_WITH_TIME = (
    r"^(\d{4}-\d{1,2}-\d{1,2})[T ](?:[01]?\d|2[0-3]):[0-5]\d(?::[0-5]\d(?:\.\d+)?)?"
    r"\s?(?:Z|[+-]\d{2}:?\d{2})?$"
)


# Text that the pattern letters used in date formats can stand for.
_LETTERS = {
    "yyyy": r"\d{4}",
    "MMMM": r"\p{L}+",
    "MMM": r"\p{L}{3}",
    "MM": r"\d{2}",
    "M": r"\d{1,2}",
    "dd": r"\d{2}",
    "d": r"\d{1,2}",
}


def _shape(date_format: str) -> str:
    """Regular expression that every text in ``date_format`` matches."""
    parts = re.findall(r"([a-zA-Z])(\1*)|([^a-zA-Z]+)", date_format)
    return "^" + "".join(
        _LETTERS.get(letter + more, ".+") if letter else re.escape(other)
        for letter, more, other in parts
    ) + "$"


def parse_date(c: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date from text in one of ``formats``; null when none fits. Never raises.

    White space around the text, and the time of day after an ISO date, are ignored.

    A text is only handed to the formats whose shape it has: a failed parse costs far more
    than the shape test.
    """
    text = strip_blank((F.col(c) if isinstance(c, str) else c).cast("string"))
    text = F.regexp_replace(text, _WITH_TIME, "$1")
    tries = [
        F.when(text.rlike(_shape(f)), F.try_to_timestamp(text, F.lit(f)).cast("date"))
        for f in formats
    ]
    return F.coalesce(*tries)


def month_of(c: Column | str) -> Column:
    """Calendar month as ``yyyy-MM`` text."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")
