"""Key lists: text files with one row key per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.functions.text import BLANKS


def read_key_list(spark: SparkSession, path: str, column: str = "row_key") -> DataFrame:
    """Lines without surrounding white space; blank lines are dropped."""
    line = F.trim("value", F.lit(BLANKS))
    return spark.read.text(path).select(line.alias(column)).where(F.col(column) != "")


def write_key_list(df: DataFrame, path: str, column: str = "row_key") -> None:
    """One key per line, replacing what is there.

    An ordered and limited key frame is one partition already, hence one file in
    order; a larger frame stays spread over as many files as it has partitions.
    """
    df.select(F.col(column).cast("string")).write.mode("overwrite").text(path)
