"""Projections and filters over nested reviews."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions import dates, ratings


def expand_struct(df: DataFrame, keys: Sequence[str], struct: str) -> DataFrame:
    """Keys plus every field of a struct column as columns of their own."""
    return df.select(*keys, f"{struct}.*")


def rating_columns(df: DataFrame, names: Sequence[str], struct: str = "ratings") -> list[Column]:
    """Each rating as a double named ``<name>_rating``; bad text gives null."""
    return [ratings.to_double(df[struct][name]).alias(f"{name}_rating") for name in names]


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where all the given columns, nested ones included, have a value."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns]))


def with_stay_date(df: DataFrame, column: str = "date_stayed") -> DataFrame:
    """Add ``month`` and ``year``; rows without both are dropped."""
    return not_null(stay_date(df, column), ["month", "year"])


def stay_date(df: DataFrame, column: str = "date_stayed") -> DataFrame:
    """Add ``month`` and ``year``, null where the date does not have them."""
    stay = F.col(column)
    return df.withColumns({"month": dates.stay_month(stay), "year": dates.stay_year(stay)})


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)
