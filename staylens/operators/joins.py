"""Joins that stay safe when a side is larger, or a key hotter, than expected."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_features(base: DataFrame, features: DataFrame | None, on: str) -> DataFrame:
    """Add feature columns to ``base``; without a match they are null.

    ``None`` leaves the base as it is. An empty frame adds its columns as nulls, so
    the schema does not depend on the data. Strategy and skew are left to AQE.
    """
    return base if features is None else base.join(features, on=on, how="left")


def fold_features(base: DataFrame, frames: Sequence[DataFrame | None], on: str) -> DataFrame:
    """Left-join feature frames from different tables one after another."""
    return reduce(lambda left, right: left_join_features(left, right, on), frames, base)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], other: Sequence[str] | None = None) -> Column:
    """Equality of all keys, null equal to null."""
    return reduce(and_, [left[k].eqNullSafe(right[o]) for k, o in zip(keys, other or keys, strict=True)])


def keyed_join(
    left: DataFrame,
    staged: DataFrame,
    on: Sequence[str],
    frequency: str,
    max_rows: int = 100_000,
    max_bytes: int = 32 << 20,
) -> DataFrame:
    """Inner join to a table with one row per key, whose column ``frequency`` says how
    many rows of ``left`` have that key. ``staged`` must be a written table, so that
    measuring it is cheap. A null key meets a null key.

    Keys holding more than one ``max_rows``-th of all rows are broadcast: there are fewer
    than ``max_rows`` of them, whatever the data, and their size is measured. The rest, if
    any, is shuffled, with no key above that share left in it. Hot keys of more than
    ``max_bytes`` are not broadcast: then all is shuffled, and adaptive execution splits them.
    """
    keys, others = list(on), [f"_on_{i}" for i in range(len(on))]
    facts = staged.withColumnsRenamed(dict(zip(keys, others, strict=True)))
    total = staged.agg(F.sum(frequency).alias("n")).first()["n"] or 0
    is_hot = F.col(frequency) * max_rows > total
    row_bytes = F.octet_length(F.to_json(F.struct(*staged.columns)))
    sizes = staged.agg(
        F.coalesce(F.sum(F.when(is_hot, row_bytes)), F.lit(0)).alias("hot"), F.count_if(~is_hot).alias("cold")
    ).first()

    def joined(rows: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(right, null_safe(rows, right, keys, others), how).drop(*others)

    if not 0 < sizes["hot"] <= max_bytes:
        return joined(left, facts)
    hot = facts.where(is_hot)
    if sizes["cold"] == 0:
        return joined(left, F.broadcast(hot))
    cold = joined(left, F.broadcast(hot.select(*others)), "left_anti")
    return joined(cold, facts.where(~is_hot)).unionByName(joined(left, F.broadcast(hot)))
