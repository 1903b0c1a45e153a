"""What fitted models must satisfy, computed from the rows by plans of their own.

Iterative fits have no counterpart to compare with row by row. But their results can be
checked: predictions follow from saved coefficients, the gradient of a minimised loss
is small, the root of a tree is the best split of all, and the shares of a mixture are
those of its densities. None of the plans here uses the model classes.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators.ranking import running_totals
from staylens.workspace import stage


def numbers_column(df: DataFrame, values: Sequence[float]) -> Column:
    """A model's numbers as one array for every row: sent once per task, not written into the plan."""
    return df.sparkSession.createDataFrame([([float(v) for v in values],)], "numbers array<double>").scalar()


def sparse_entries(indices: Column, weights: Column) -> Column:
    """Entries (``index``, ``value``) of a sparse row: each occurrence of an index counts its weight."""
    return F.transform(indices, lambda i: F.struct(i.alias("index"), F.get(weights, i).alias("value")))


def linear_margin(entries: Column, coefficients: Column, intercept: float) -> Column:
    """Intercept plus the sum of value times coefficient over a row's entries."""
    return F.aggregate(
        entries, F.lit(float(intercept)), lambda total, e: total + e["value"] * F.get(coefficients, e["index"])
    )


def loss_slope(loss: str, label: Column, margin: Column) -> Column:
    """Derivative by the margin of the logistic or hinge loss of a row with label 0 or 1."""
    if loss == "logistic":
        return 1 / (1 + F.exp(-margin)) - label
    if loss == "hinge":
        sign = 2 * label - 1
        return F.when(sign * margin < 1, -sign).otherwise(0.0)
    raise ValueError(f"unknown loss {loss!r}")


def linear_gradients(df: DataFrame, entries: str, label: str, margins: dict[str, str], loss: str) -> DataFrame:
    """Gradients of the mean loss: a row per ``index``, the intercept's -1, with a column for each margin column that ``margins`` names.

    One pass for all: every row is cut into its entries, and slopes times values are summed per index,
    combined on the map side, so that a task sends at most one row per index it saw.
    """
    slopes = [loss_slope(loss, F.col(label), F.col(margin)).alias(f"slope_{name}") for name, margin in margins.items()]
    constant = F.array(F.struct(F.lit(-1).alias("index"), F.lit(1.0).alias("value")))
    cut = df.select(*slopes, F.inline(F.concat(constant, entries)))
    rows = df.agg(F.count("*")).scalar()
    return cut.groupBy("index").agg(*[(F.sum(F.col(f"slope_{name}") * F.col("value")) / rows).alias(name) for name in margins])


def linear_certificate(
    train: DataFrame, entries: str, label: str, coefficients: Sequence[float], intercept: float, loss: str
) -> DataFrame:
    """One row: ``loss`` and ``gradient`` (largest absolute component) at the coefficients, and ``start_loss`` and ``start_gradient`` at zero."""
    # A subquery may not stand inside a fold, so the numbers become a column first.
    weighted = train.withColumn("_weights", numbers_column(train, coefficients))
    margin = linear_margin(F.col(entries), F.col("_weights"), intercept)
    at = weighted.select(label, entries, margin.alias("margin"), F.lit(0.0).alias("zero"))
    sign = 2 * F.col(label) - 1

    def mean_loss(margin: str) -> Column:
        signed = sign * F.col(margin)
        # ln(1 + exp(-s)) without overflow.
        value = F.greatest(-signed, F.lit(0.0)) + F.log1p(F.exp(-F.abs(signed)))
        return F.avg(value if loss == "logistic" else F.greatest(1 - signed, F.lit(0.0)))

    margins = {"gradient": "margin", "start_gradient": "zero"}
    gradients = linear_gradients(at, entries, label, margins, loss)
    # One row on either side.
    largest = F.broadcast(gradients.agg(*[F.max(F.abs(name)).alias(name) for name in margins]))
    losses = at.agg(mean_loss("margin").alias("loss"), mean_loss("zero").alias("start_loss"))
    return losses.crossJoin(largest)


def split_gains(df: DataFrame, features: Sequence[str], label: str, classes: int) -> DataFrame:
    """Gini gain of every split ``feature <= at_most``, for classes 0, 1, ... ``classes - 1``.

    One aggregate counts rows per feature, value and class; the counts on the left of
    each value are running totals over sorted ranges, so a feature may have any number of values.
    The last value of a feature splits nothing and is left out. Rows with a null feature have no side for it.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("at_most")) for f in features])
    cells = df.select(label, F.inline(pairs)).where(F.col("at_most").isNotNull())
    names = [f"c{k}" for k in range(classes)]
    counts = cells.groupBy("feature", "at_most").agg(*[F.count_if(F.col(label) == k).alias(c) for k, c in enumerate(names)])
    counts = stage(counts, "split-counts")
    totals = counts.groupBy("feature").agg(*[F.sum(c).alias(f"all_{c}") for c in names])
    # One row per feature, and the features are listed by the caller.
    sided = running_totals(counts, "at_most", names, ["feature"]).join(F.broadcast(totals), "feature")

    def sum_of(values: Sequence[Column]) -> Column:
        return reduce(add, values)

    def gini(values: Sequence[Column]) -> Column:
        n = sum_of(values)
        return F.when(n > 0, 1 - sum_of([v * v for v in values]) / (n * n)).otherwise(0.0)

    left = [(F.col(f"before_{c}") + F.col(c)).cast("double") for c in names]
    whole = [F.col(f"all_{c}").cast("double") for c in names]
    right = [w - v for w, v in zip(whole, left, strict=True)]
    n, n_left, n_right = sum_of(whole), sum_of(left), sum_of(right)
    gain = gini(whole) - (n_left * gini(left) + n_right * gini(right)) / n
    return sided.select("feature", "at_most", n_left.cast("long").alias("n_left"), n_right.cast("long").alias("n_right"), gain.alias("gain")).where("n_right > 0")


def mixture_shares(
    df: DataFrame,
    features: str,
    weights: Sequence[float],
    means: Sequence[Sequence[float]],
    covariances: Sequence[Sequence[Sequence[float]]],
    floor: float = 2.0**-52,
) -> DataFrame:
    """Add ``shares``: each component's share of the density at the array ``features``, and its first largest as ``component``.

    Per component the Mahalanobis term comes from the eigenvectors of its covariance, prepared by the driver from
    the model's few matrices; a row is a fold over arrays. Shares are taken after the largest exponent
    is subtracted, so that they do not vanish far from all centres. ``floor`` is added to every
    component's weighted density, as MLlib does; null features give null.
    """
    tables, constants = [], []
    for weight, mean, covariance in zip(weights, means, covariances, strict=True):
        values, vectors = np.linalg.eigh(np.asarray(covariance, float))
        tolerance = np.finfo(float).eps * values.max() * len(values)
        used = values > tolerance
        rotation = (vectors[:, used] / np.sqrt(values[used])).T
        tables.append((rotation, rotation @ np.asarray(mean, float)))
        constants.append(np.log(weight) - 0.5 * (len(values) * np.log(2 * np.pi) + np.log(values[used]).sum()) if weight > 0 else -np.inf)

    def squares(k: int, rotation: np.ndarray) -> Column:
        dim, flat = rotation.shape[1], F.col(f"_table{k}")
        rows = F.sequence(F.lit(0), F.lit(len(rotation) - 1))

        def component(r: Column) -> Column:
            row = F.slice(flat, r * dim + 1, dim)
            dot = F.aggregate(F.zip_with(F.col(features), row, lambda x, w: x * w), F.lit(0.0), lambda t, x: t + x)
            return dot - F.get(flat, F.lit(rotation.size) + r)

        return F.aggregate(F.transform(rows, component), F.lit(0.0), lambda t, x: t + x * x)

    names = [f"_table{k}" for k in range(len(tables))]
    logs = [F.lit(float(c)) - 0.5 * squares(k, t[0]) for k, (c, t) in enumerate(zip(constants, tables, strict=True))]
    least = float(np.log(floor)) if floor else float("-inf")
    tabled = df.withColumns({n: numbers_column(df, [*t[0].ravel(), *t[1]]) for n, t in zip(names, tables, strict=True)})
    placed = tabled.withColumn("_logs", F.when(F.col(features).isNotNull(), F.array(*logs)))
    top = F.greatest(F.array_max("_logs"), F.lit(least))
    raised = F.transform("_logs", lambda v: F.exp(v - top) + F.exp(F.lit(least) - top))
    total = F.aggregate("_raised", F.lit(0.0), lambda t, x: t + x)
    shared = placed.withColumn("_raised", raised).withColumn("shares", F.transform("_raised", lambda v: v / total))
    return shared.withColumn("component", (F.array_position("shares", F.array_max("shares")) - 1).cast("int")).drop("_logs", "_raised", *names)
