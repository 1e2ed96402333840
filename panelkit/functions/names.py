"""Column-name and label normalisation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """``" Total Deaths "`` -> ``total_deaths``, ``"Country/Region"`` -> ``country_region``."""
    words = re.split(r"[\s\-/_]+", name.lower())
    return "_".join(w for w in (re.sub(r"\W", "", word) for word in words) if w)


def strip_blank(c: Column | str) -> Column:
    """Remove leading and trailing white space of any kind (``trim`` only removes spaces)."""
    text = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(F.regexp_replace(text, r"^\s+", ""), r"\s+$", "")
