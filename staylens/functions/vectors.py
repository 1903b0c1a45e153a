"""Distances and vector parts as plain expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(columns: Sequence[str], point: Sequence[float]) -> Column:
    """Squared Euclidean distance of numeric columns to a fixed point."""
    # ``pow`` names each column once, so a computed column is not evaluated twice.
    parts = [F.pow(F.col(c) - F.lit(float(p)), 2) for c, p in zip(columns, point, strict=True)]
    return reduce(add, parts)


def squared_distances(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """One squared distance per centre, in centre order."""
    return F.array(*[squared_distance(columns, c) for c in centres])


def vector_distance(vector: str, index: str, centres: Sequence[Sequence[float]]) -> Column:
    """Distance of a vector column to the centre its index column names."""
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    centre = F.element_at(table, F.col(index) + 1)
    gaps = F.zip_with(vector_to_array(vector), centre, lambda a, b: F.pow(a - b, 2))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap))


def vector_columns(vector: str, names: Sequence[str]) -> list[Column]:
    """The entries of a dense vector as named double columns."""
    entries = vector_to_array(vector)
    return [entries[i].alias(name) for i, name in enumerate(names)]
