"""Model metrics as relational plans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.operators.ranking import running_totals
from staylens.workspace import stage


# Pairs of label and prediction that one record may hold; more are refused.
_MOST_CELLS = 10_000


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per label and prediction; combinations that never occur are absent."""
    pair = [F.col(label).alias("label"), F.col(prediction).alias("prediction")]
    return df.groupBy(*pair).agg(F.count("*").alias("n"))


def f1_scores(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 weighted by class size, and the plain mean F1.

    Computed from the confusion matrix, so the rows are read once. A class that is
    never predicted has precision 0.
    """
    cells = confusion_matrix(df, label, prediction)
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("long")

    def side(c: str, actual, predicted, hit):
        return F.struct(F.col(c).alias("c"), actual.alias("actual"), predicted.alias("predicted"), hit.alias("hit"))

    sides = F.array(side("label", F.col("n"), none, hits), side("prediction", none, F.col("n"), none))
    classes = (
        cells.select(F.inline(sides))
        .groupBy("c")
        .agg(F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("hit").alias("hit"))
    )
    zero = F.lit(0.0)
    rated = classes.select(
        "actual",
        "hit",
        F.when(F.col("predicted") > 0, F.col("hit") / F.col("predicted")).otherwise(zero).alias("p"),
        F.when(F.col("actual") > 0, F.col("hit") / F.col("actual")).otherwise(zero).alias("r"),
    ).withColumn("f", F.when(F.col("hit") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(zero))

    def weighted(c: str):
        return F.sum(F.col(c) * F.col("actual")) / F.sum("actual")

    return rated.agg(
        (F.sum("hit") / F.sum("actual")).alias("accuracy"),
        weighted("p").alias("weighted_precision"),
        weighted("r").alias("weighted_recall"),
        weighted("f").alias("weighted_f1"),
        F.avg("f").alias("macro_f1"),
    )


def auc(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the ROC curve: the share of (positive, negative) pairs in the
    right order, ties counting half, summed over scores in place of pairs."""
    ties = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.sum(F.when(F.col(label) > 0.5, 1).otherwise(0)).alias("pos"),
        F.sum(F.when(F.col(label) > 0.5, 0).otherwise(1)).alias("neg"),
    )
    ordered = running_totals(stage(ties, "score-ties"), "score", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("before_neg") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ordered.agg(F.when(pairs > 0, wins / pairs).alias("auc"))


def silhouette_rows(df: DataFrame, columns: Sequence[str], cluster: str, max_clusters: int = 100) -> DataFrame:
    """Add ``silhouette`` per row, squared Euclidean, from per-cluster sums.

    The mean squared distance of x to a cluster of n rows with sum Y and squared
    norms S is |x|^2 + S/n - 2 x.Y/n, so no pair of rows is formed. The sums, one row
    per cluster, are fetched first; more than ``max_clusters`` of them are refused, and
    so is a single cluster, which has no silhouette.
    """
    norm = reduce(add, [F.col(c) * F.col(c) for c in columns])
    sums = df.groupBy(F.col(cluster).alias("cluster")).agg(
        F.count("*").alias("n"), F.avg(norm).alias("norm"), *[F.avg(c).alias(f"y{i}") for i, c in enumerate(columns)]
    )
    clusters = sums.limit(max_clusters + 1).collect()
    if len(clusters) < 2:
        raise ValueError("silhouette needs at least two clusters")
    if len(clusters) > max_clusters:
        raise ValueError(f"more than {max_clusters} clusters")

    distances = {}
    for k, c in enumerate(clusters):
        dot = reduce(add, [F.col(name) * F.lit(c[f"y{i}"]) for i, name in enumerate(columns)])
        distances[f"_d{k}"] = norm + F.lit(c["norm"]) - 2 * dot
    own, others = F.lit(None).cast("double"), []
    for k, c in enumerate(clusters):
        is_own = F.col(cluster) == F.lit(c["cluster"])
        # A row is not compared with itself; alone in its cluster it has no distance.
        scale = F.lit(c["n"] / (c["n"] - 1) if c["n"] > 1 else None).cast("double")
        own = F.when(is_own, F.col(f"_d{k}") * scale).otherwise(own)
        others.append(F.when(~is_own, F.col(f"_d{k}")))
    compared = df.withColumns(distances).withColumns({"_a": own, "_b": F.least(*others)})
    a, b = F.col("_a"), F.col("_b")
    value = F.when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(0.0)
    return compared.withColumn("silhouette", value).drop(*distances, "_a", "_b")


def silhouette(df: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Mean silhouette of all rows."""
    return silhouette_rows(df, columns, cluster).agg(F.avg("silhouette").alias("silhouette"))


def metrics_record(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row ``details``: rounded scores and the confusion matrix, ready for JSON."""
    scores = f1_scores(df, label, prediction)
    cells = confusion_matrix(df, label, prediction)
    cell = F.struct("label", "prediction", F.col("n").alias("count"))
    listed = cells.limit(_MOST_CELLS + 1).agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    too_many = F.raise_error(F.lit(f"more than {_MOST_CELLS} label and prediction pairs"))
    matrix = listed.select(F.when(F.size("cells") <= _MOST_CELLS, F.col("cells")).otherwise(too_many)).scalar()
    return scores.select(
        F.struct(
            F.round("weighted_f1", 4).alias("f1_score"),
            F.round("macro_f1", 4).alias("macro_f1"),
            F.round("weighted_precision", 4).alias("precision"),
            F.round("weighted_recall", 4).alias("recall"),
            matrix.alias("confusion_matrix"),
        ).alias("details")
    )
