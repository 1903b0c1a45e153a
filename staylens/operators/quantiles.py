"""Quantile thresholds and the labels cut at them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.functions.ratings import quantile_label
from staylens.operators.ranking import exact_quantiles

# Thirds as written in the room-experience job.
THIRDS = (0.3333, 0.6666)


def quantile_struct(
    df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int | None = 10_000
) -> DataFrame:
    """One row with a struct ``q`` of fields ``q0``, ``q1``, ...; values occur in the data.

    By default a sketch with a rank error of ``1 / accuracy``, one pass at any scale.
    ``accuracy=None`` is exact: values are counted, and the counts added up over sorted
    ranges, so a column may have any number of distinct values.
    """
    if accuracy is None:
        exact = exact_quantiles(df, column, probabilities)
        picks = [F.max(F.when(F.col("p") == float(p), F.col("value"))) for p in probabilities]
        return exact.agg(F.struct(*[pick.cast("double").alias(f"q{i}") for i, pick in enumerate(picks)]).alias("q"))
    sketch = F.percentile_approx(column, [float(p) for p in probabilities], accuracy)
    picks = [sketch[i] for i in range(len(probabilities))]
    fields = [pick.cast("double").alias(f"q{i}") for i, pick in enumerate(picks)]
    return df.agg(F.struct(*fields).alias("q"))


def with_quantile_label(
    df: DataFrame,
    column: str,
    output: str,
    probabilities: Sequence[float] = THIRDS,
    accuracy: int | None = 10_000,
) -> DataFrame:
    """Add the label ``Low``, ``Medium`` or ``High`` by the thirds of a column."""
    cuts: Column = quantile_struct(df, column, probabilities, accuracy).scalar()
    return df.withColumn(output, quantile_label(F.col(column), cuts["q0"], cuts["q1"]))
