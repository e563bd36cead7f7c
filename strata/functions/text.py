"""Text normalisation. Blank text becomes NULL; only spaces are trimmed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A run of letters and digits, or a run of anything else.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def trimmed_text(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def upper_text(x: Column) -> Column:
    return F.nullif(F.upper(F.trim(x)), F.lit(""))


def lower_text(x: Column) -> Column:
    return F.nullif(F.lower(F.trim(x)), F.lit(""))


def title_text(x: Column) -> Column:
    """Title case where every character that is no letter or digit ends a word.

    Spark's `initcap` starts a word only after a space: it would give
    "O'brien" and "Smart-tv" where "O'Brien" and "Smart-Tv" are wanted.
    """
    pieces = F.regexp_extract_all(F.lower(F.trim(x)), F.lit(_WORD_OR_GAP), F.lit(1))
    # A piece is one word or one gap, so per piece the built-in is right.
    titled = F.transform(pieces, F.initcap)
    return F.nullif(F.array_join(titled, ""), F.lit(""))
