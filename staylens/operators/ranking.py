"""Exact order statistics without a window over a whole group.

A window per group, or over everything, sorts that group in one task. Here rows are
dealt into ranges of their order first, a hot group over many of them. Only what a range
inherits from the ranges before it, one row per range, is passed on.
"""

from __future__ import annotations

from collections.abc import Sequence
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from staylens.operators.joins import keyed_join
from staylens.workspace import stage


def running_totals(
    df: DataFrame,
    order_by: str | Sequence[str | Column],
    sums: Sequence[str],
    group: Sequence[str] = (),
    ranges: int | None = None,
    xors: Sequence[str] = (),
) -> DataFrame:
    """Add ``before_<c>``: the sum (for ``xors``: the bitwise exclusive or) of ``c`` over
    earlier rows of the same group. Null groups are a group; null values count as zero.

    ``order_by`` takes columns or sort expressions of any type Spark can order: long
    integers, decimals, timestamps and text are compared as they are. Rows that tie in all
    of them come in any order, so sum ties beforehand, or add a key.

    Rows go into ``ranges`` sorted ranges (default: the number of shuffle partitions, which
    a cluster sizes by its data) over group and order. A group that spans several ranges
    hands the totals of each to the next ones: two rows per range, whatever the data.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c) if isinstance(c, str) else c for c in ([order_by] if isinstance(order_by, (str, Column)) else order_by)]
    dealt = df.repartitionByRange(ranges, *group, *order).withColumn("_range", F.spark_partition_id())
    ranged = stage(dealt.withColumn("_group", F.struct(*group) if group else F.struct(F.lit(0).alias("_all"))), "ranges")

    kinds = {c: (F.sum, add) for c in sums} | {c: (F.bit_xor, Column.bitwiseXOR) for c in xors}
    # One row per range each: its first and last group, and the totals of the last one.
    edges = ranged.groupBy("_range").agg(F.min("_group").alias("_first"), F.max("_group").alias("_last"))
    tails = (
        ranged.join(F.broadcast(edges.select("_range", "_last")), "_range")
        .where(F.col("_group").eqNullSafe(F.col("_last")))
        .groupBy("_range", "_group")
        .agg(*[kind(c).alias(c) for c, (kind, _) in kinds.items()])
    )
    heads = edges.select("_range", F.col("_first").alias("_group"), *[F.lit(None).alias(c) for c in kinds])
    ends = heads.withColumn("_head", F.lit(True)).unionByName(tails.withColumn("_head", F.lit(False)))
    earlier = Window.partitionBy("_group").orderBy("_range", F.desc("_head")).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select("_range", F.col("_group").alias("_first"), "_head", *[kind(c).over(earlier).alias(f"_handed_{c}") for c, (kind, _) in kinds.items()])
    handed = handed.where("_head").drop("_head")

    inside = Window.partitionBy("_range", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero, inherits = F.lit(0), F.col("_group").eqNullSafe(F.col("_first"))
    before = {
        f"before_{c}": combine(
            F.coalesce(F.when(inherits, F.col(f"_handed_{c}")), zero), F.coalesce(kind(c).over(inside), zero)
        )
        for c, (kind, combine) in kinds.items()
    }
    return ranged.join(F.broadcast(handed), "_range").withColumns(before).select(*df.columns, *before)


def ranked(df: DataFrame, group: Sequence[str], score: str, descending: bool = True) -> DataFrame:
    """Add ``rank`` within the group, ties sharing a rank, rows without score left out.

    The score keeps its type, so integers above 2^53, decimals, timestamps and text rank
    exactly. Null is a group of its own.
    """
    scored = df.where(F.col(score).isNotNull())
    ties = stage(scored.groupBy(*group, score).agg(F.count("*").alias("_n")), "ties")
    order = F.col(score).desc() if descending else F.col(score).asc()
    totals = running_totals(ties, [order], ["_n"], group)
    ranks = stage(totals.select(*group, score, "_n", (F.col("before__n") + 1).alias("rank")), "ranks")
    return keyed_join(scored, ranks, [*group, score], "_n").select(*df.columns, "rank")


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Smallest value whose share of rows reaches each probability: rows of ``group``, ``p``, ``value``.

    Exact for any orderable type and any number of rows and distinct values; see
    ``quantiles.py`` for the sketch, which is one pass and enough for class boundaries.
    Values keep their type; without any value there is no row per group, and null overall.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(*group, F.col(column).alias("_value"))
    counts = stage(values.agg(F.count("*").alias("_n")), "value-counts")
    totals = running_totals(counts, "_value", ["_n"], group)
    if group:
        sizes = stage(counts.groupBy(*group).agg(F.sum("_n").alias("_total"), F.count("*").alias("_values")), "group-sizes")
        totals = keyed_join(totals, sizes, group, "_values")
    else:
        totals = totals.withColumn("_total", counts.agg(F.sum("_n")).scalar())
    reached = F.col("before__n") + F.col("_n")
    picks, rows = [], []
    for i, p in enumerate(probabilities):
        picks.append(F.min(F.when(reached >= F.lit(float(p)) * F.col("_total"), F.col("_value"))).alias(f"_q{i}"))
        rows.append(F.struct(F.lit(float(p)).alias("p"), F.col(f"_q{i}").alias("value")))
    return totals.groupBy(*group).agg(*picks).select(*group, F.inline(F.array(*rows)))
