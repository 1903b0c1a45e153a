"""Assignment to given centres, distances and anomaly flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.functions.vectors import squared_distances
from staylens.workspace import stage

Centres = Sequence[Sequence[float]]


def assign_to_centres(df: DataFrame, columns: Sequence[str], centres: Centres) -> DataFrame:
    """Add the nearest centre's ``cluster`` (first one on ties) and the ``distance``."""
    measured = df.withColumn("_d", squared_distances(columns, centres))
    nearest = F.array_min("_d")
    return measured.withColumns(
        {
            "cluster": (F.array_position("_d", nearest) - 1).cast("int"),
            "distance": F.sqrt(nearest),
        }
    ).drop("_d")


def mean_distance(df: DataFrame, distance: str = "distance") -> DataFrame:
    return df.agg(F.avg(distance).alias("avg_distance"))


def flag_anomalies(
    df: DataFrame, clusters: int, cluster: str = "cluster", distance: str = "distance", deviations: float = 3.0
) -> DataFrame:
    """Add ``threshold`` (mean plus ``deviations`` standard deviations of the cluster's
    distances) and ``is_anomaly``.

    ``clusters`` is the number of centres: every row sees that many thresholds at most,
    as one map from a scalar subquery. A window per cluster would sort a whole cluster
    in one task.
    """
    spread = F.coalesce(F.stddev_samp(distance), F.lit(0.0))
    limits = df.groupBy(cluster).agg((F.avg(distance) + deviations * spread).alias("threshold"))
    listed = limits.limit(clusters + 1).agg(F.collect_list(F.struct(cluster, "threshold")).alias("all"))
    too_many = F.raise_error(F.lit(f"more than {clusters} clusters"))
    checked = F.when(F.size("all") <= clusters, F.map_from_entries("all")).otherwise(too_many)
    thresholds = listed.select(checked).scalar()
    with_threshold = df.withColumn("threshold", F.element_at(thresholds, F.col(cluster)))
    return with_threshold.withColumn("is_anomaly", F.col(distance) > F.col("threshold"))


def naive_bayes_parameters(df: DataFrame, label: str, columns: Sequence[str], smoothing: float = 1.0) -> DataFrame:
    """Multinomial naive Bayes in closed form: ``pi`` and ``theta`` per class and feature.

    One aggregate over the rows; everything after it is one row per class.
    """
    per_label = df.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("n"), *[F.sum(c).alias(c) for c in columns]
    )
    sums = stage(per_label, "class-sums")
    overall = sums.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("classes")).alias("t")).scalar()
    pi = F.log((F.col("n") + smoothing) / (overall["n"] + smoothing * overall["classes"]))
    per_class = sum((F.col(c) for c in columns[1:]), F.col(columns[0])) + smoothing * len(columns)
    features = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.log((F.col(c) + smoothing) / per_class).alias("theta")) for c in columns]
    )
    return sums.select("label", pi.alias("pi"), F.inline(features))
