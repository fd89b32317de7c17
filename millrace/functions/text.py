"""Word splitting with built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word is a run of letters and digits of any script.
WORD_PATTERN = r"([\p{L}\p{N}]+)"


def words(text: Column) -> Column:
    """Lower-case words of ``text`` in order, repeats kept."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(1))
