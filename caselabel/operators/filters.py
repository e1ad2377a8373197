"""Row filters; every one is a plain predicate that reaches the scan when it can."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselabel import vocab
from caselabel.functions.text import is_number


def filter_category(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows of one category."""
    return df.where(F.col(column) == value)


def filter_word_range(df: DataFrame, words: str, low: int = 35, high: int = 300) -> DataFrame:
    """Rows with ``low < words <= high``."""
    return df.where((F.col(words) > low) & (F.col(words) <= high))


def filter_max_words(df: DataFrame, words: str, high: int = 300) -> DataFrame:
    """Rows with at most ``high`` words."""
    return df.where(F.col(words) <= high)


def filter_known_labels(df: DataFrame, label: str, other: str, missing: str = vocab.NO_INFORMATION) -> DataFrame:
    """Rows with a real label that also occurs in the other label column."""
    known = df.select(F.col(other).alias(label)).where(F.col(label).isNotNull()).distinct()
    return df.where(F.col(label) != missing).join(known, label, "left_semi")


def filter_predicted(df: DataFrame, label: str, offence: str, value: str) -> DataFrame:
    """Rows that were scored and belong to one offence type; unknown labels stay."""
    scored = ~F.col(label).eqNullSafe(vocab.NOT_SCORED)
    return df.where(scored & F.col(offence).eqNullSafe(value))


def contains_filter(df: DataFrame, label: str, part: str) -> DataFrame:
    """Rows whose label contains a substring."""
    return df.where(F.col(label).contains(part))


def fill_empty_text(df: DataFrame, *columns: str) -> DataFrame:
    """NULL narratives become empty text."""
    return df.fillna("", subset=list(columns))


def non_text_rows(df: DataFrame, text: str) -> DataFrame:
    """Rows whose narrative is really a number."""
    return df.where(is_number(F.col(text)))
