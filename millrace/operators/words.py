"""Word rows from text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import words


def explode_words(df: DataFrame, text: str, name: str = "word") -> DataFrame:
    """One row per word of ``text``; rows without a word vanish."""
    return df.withColumn(name, F.explode(words(F.col(text))))
