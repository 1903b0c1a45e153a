"""Labels and numbers made from ratings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column) -> Column:
    """Number from text; text that is no number gives null, not an error."""
    return value.try_cast("double")


def quantile_label(value: Column, low: Column, high: Column) -> Column:
    """``Low`` up to ``low``, ``Medium`` up to ``high``, otherwise ``High``."""
    return F.when(value <= low, "Low").when(value <= high, "Medium").otherwise("High")


def sentiment_label(overall: Column, positive_from: float = 4.0, null_is_negative: bool = False) -> Column:
    """1.0 for a rating of at least ``positive_from``, else 0.0.

    A missing rating stays null, so that it can be dropped; ``null_is_negative``
    counts it as 0.0.
    """
    positive = F.when(overall >= positive_from, 1.0)
    return positive.otherwise(0.0) if null_is_negative else positive.when(overall.isNotNull(), 0.0)
