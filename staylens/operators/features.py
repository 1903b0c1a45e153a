"""Scaling and label indexing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace columns by ``(x - mean) / sample stddev``; a constant column becomes 0.

    Mean and deviation come from one aggregate, read as a scalar subquery.
    """
    fields = [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("sd")).alias(c) for c in columns]
    stats = df.agg(F.struct(*fields).alias("stats")).scalar()

    def scaled(c: str):
        mean, sd = stats[c]["mean"], stats[c]["sd"]
        return F.when(sd > 0, (F.col(c) - mean) / sd).when(F.col(c).isNotNull(), 0.0)

    return df.withColumns({c: scaled(c) for c in columns})


def scaled_vector_stages(columns: Sequence[str], output: str = "features") -> list:
    """Pipeline stages: assemble the columns, then centre and scale them."""
    raw = f"raw_{output}"
    return [
        VectorAssembler(inputCols=list(columns), outputCol=raw),
        StandardScaler(inputCol=raw, outputCol=output, withMean=True, withStd=True),
    ]


def fit_label_index(df: DataFrame, label: str, output: str = "label") -> StringIndexerModel:
    """Index labels by falling frequency, ties by name."""
    return StringIndexer(inputCol=label, outputCol=output).fit(df)
