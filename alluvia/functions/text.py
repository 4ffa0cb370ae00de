from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A tag, and a run of anything Python calls white space (ASCII, separators, NEL, FS..US).
TAG = r"<[^>]+>"
BLANKS = r"[\s\p{Z}\x0B\x1C-\x1F\x85]+"


def strip_markup(text: Column) -> Column:
    """Plain text of an HTML fragment: tags become blanks, blanks collapse, NULL becomes ''."""
    without_tags = F.regexp_replace(text, TAG, " ")
    return F.coalesce(F.trim(F.regexp_replace(without_tags, BLANKS, " ")), F.lit(""))


def leading_number(text: Column, prefix: str, suffix: str = "") -> Column:
    """The integer between ``prefix`` and ``suffix`` at the very start of the text, else NULL.

    Both are regular expressions. Zero counts as absent, as does a number beyond INT.
    """
    digits = F.regexp_extract(text, f"^{prefix}([0-9]+){suffix}", 1)
    return F.nullif(digits.try_cast("int"), F.lit(0))
