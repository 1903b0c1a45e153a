"""Null handling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def impute_means(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """Replace nulls by the column mean, or by ``default`` when all are null.

    The means arrive as one scalar subquery: a partial aggregate per task and one
    row for the plan. No join and no unpartitioned window is involved. ``df`` is read
    twice; stage it when that is costly.
    """
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in columns]).alias("means")).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), means[c], F.lit(float(default))) for c in columns}
    return df.withColumns(filled)


def mean_fill_stage(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> SQLTransformer:
    """``impute_means`` as a pipeline stage with means computed now, so that a saved model fills nulls by them too."""
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    constants = {c: default if means[c] is None else float(means[c]) for c in columns}
    filled = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), CAST('{v!r}' AS DOUBLE)) AS `{c}`" for c, v in constants.items())
    names = ", ".join(f"`{c}`" for c in columns)
    return SQLTransformer(statement=f"SELECT * EXCEPT ({names}), {filled} FROM __THIS__")


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is null."""
    return df.na.drop(subset=list(columns))


def assemble(df: DataFrame, columns: Sequence[str], output: str, skip_invalid: bool = False) -> DataFrame:
    """One dense vector per row; a null raises, or drops its row with ``skip_invalid``."""
    assembler = VectorAssembler(
        inputCols=list(columns), outputCol=output, handleInvalid="skip" if skip_invalid else "error"
    )
    return assembler.transform(df)
