"""Column functions: Column in, Column out."""

from strata.functions.periods import date_key, day, month_key, month_start
from strata.functions.text import lower_text, title_text, trimmed_text, upper_text
from strata.functions.values import non_negative, within

__all__ = [
    "date_key",
    "day",
    "lower_text",
    "month_key",
    "month_start",
    "non_negative",
    "title_text",
    "trimmed_text",
    "upper_text",
    "within",
]
