"""Quantile sketches that are stored and merged, so that new days do not re-read old ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH, ROWS = "sketch", "n"
# How many sketches one row of a merging step holds; each is a few kilobytes.
_FAN = 64


def rank_error(k: int) -> float:
    """Normalised rank error of a sketch of size ``k``, at 99 % confidence (a fixed property of the KLL sketch)."""
    return 2.446 / k**0.9433


def quantile_sketches(df: DataFrame, column: str, group: Sequence[str], k: int = 2_000) -> DataFrame:
    """One sketch of a numeric column per group, and the number ``n`` of values in it.

    One aggregate, combined on the map side: a task sends one sketch per group, whatever
    its rows. Null values are left out, a group without values has no row; null is a group.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(*group)
    return values.agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias(SKETCH), F.count(column).alias(ROWS))


def merged(sketches: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """One sketch per group from any number of them, merged in steps of about 64, so that none meets all in one task."""
    most = sketches.groupBy(*group).agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
    salted = sketches.select(*group, SKETCH, ROWS)
    while True:
        parts = -(-most // _FAN)
        salt = F.pmod(F.xxhash64(SKETCH), F.lit(max(parts, 1))).alias("_salt")
        listed = salted.groupBy(*group, salt).agg(F.collect_list(SKETCH).alias("_list"), F.sum(ROWS).alias(ROWS))
        rest = F.slice("_list", 2, F.greatest(F.size("_list") - 1, F.lit(0)))
        salted = listed.select(*group, F.aggregate(rest, F.get("_list", F.lit(0)), F.kll_sketch_merge_double).alias(SKETCH), ROWS)
        if parts <= 1:
            return salted
        most = parts


def sketch_quantiles(sketches: DataFrame, probabilities: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """Rows of ``group``, ``p`` and ``value``: values that occur, whose rank is within ``rank_error`` of each probability."""
    rows = [F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(p))).alias("value")) for p in probabilities]
    return merged(sketches, group).select(*group, F.inline(F.array(*rows)))


class SketchStore:
    """Sketches per day and group in a folder; a day is written once and replaced when it is written again."""

    def __init__(self, spark: SparkSession, path: str, group: T.StructType | None = None, k: int = 2_000):
        self.spark = spark
        self.path = path
        self.group = group or T.StructType()
        self.k = k

    def put(self, day: str, rows: DataFrame, column: str) -> None:
        """Add the values of one day. Writing the same day again, after a failure or with late rows, replaces it."""
        sketches = quantile_sketches(rows, column, self.group.names, self.k)
        sketches.write.mode("overwrite").parquet(f"{self.path.rstrip('/')}/day={day}")

    def sketches(self, first: str | None = None, last: str | None = None) -> DataFrame:
        """Stored sketches of the days from ``first`` to ``last``; the day filter leaves other folders unread."""
        fields = [*self.group.fields, T.StructField(SKETCH, T.BinaryType()), T.StructField(ROWS, T.LongType()), T.StructField("day", T.StringType())]
        try:
            stored = self.spark.read.schema(T.StructType(fields)).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], T.StructType(fields))
        for bound, keep in ((first, F.col("day") >= first), (last, F.col("day") <= last)):
            if bound is not None:
                stored = stored.where(keep)
        return stored

    def quantiles(self, probabilities: Sequence[float], first: str | None = None, last: str | None = None) -> DataFrame:
        return sketch_quantiles(self.sketches(first, last), probabilities, self.group.names)
