from panelkit.functions.dates import DATE_FORMATS, month_of, parse_date
from panelkit.functions.names import snake_case, strip_blank
from panelkit.functions.numbers import (
    as_number,
    number_from_text,
    coverage_pct,
    per_capita,
    ratio,
    ratio_pct,
    round_even,
    round_half_up,
)

__all__ = [
    "DATE_FORMATS",
    "as_number",
    "coverage_pct",
    "month_of",
    "number_from_text",
    "parse_date",
    "per_capita",
    "ratio",
    "ratio_pct",
    "round_even",
    "round_half_up",
    "snake_case",
    "strip_blank",
]
