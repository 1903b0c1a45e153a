"""Splits, samples and class balancing.

All but the two ``randomSplit`` / ``sample`` wrappers decide by a hash of the row
key, so a result does not change with partitioning or when a task is run again.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from staylens.functions.keys import hash_bucket
from staylens.operators.joins import keyed_join
from staylens.workspace import stage

Bucket = Callable[..., Column]  # (key, buckets, draw) -> bucket number


def with_split(df: DataFrame, key: str, train_percent: int = 80, bucket: Bucket = hash_bucket) -> DataFrame:
    """Add ``split`` (``train`` or ``test``) by the key; equal keys stay together."""
    is_train = bucket(F.col(key), 100) < train_percent
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def hash_split(
    df: DataFrame, key: str, train_percent: int = 80, bucket: Bucket = hash_bucket
) -> tuple[DataFrame, DataFrame]:
    marked = with_split(df, key, train_percent, bucket)
    return tuple(marked.where(F.col("split") == part).drop("split") for part in ("train", "test"))


def random_split(df: DataFrame, train_share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; which rows go where depends on the partition layout."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def sample_with_replacement(df: DataFrame, ratio: float, seed: int = 42) -> DataFrame:
    """Spark's own Poisson sample; depends on the partition layout."""
    return df.sample(withReplacement=True, fraction=ratio, seed=seed)


def repeat_rows(df: DataFrame, copies: Column) -> DataFrame:
    """Each row ``copies`` times, numbered 1, 2, ... in ``copy``; zero drops the row.

    The filter follows the explosion: before it, it would be pushed down and compute
    ``copies`` a second time.
    """
    counted = df.withColumn("_copies", copies.cast("int"))
    numbers = F.when(F.col("_copies") > 0, F.sequence(F.lit(1), F.col("_copies")))
    return counted.withColumn("copy", F.explode_outer(numbers)).where(F.col("copy").isNotNull()).drop("_copies")


# A Poisson rate above this is drawn as a sum of equal smaller ones.
_LARGEST_RATE = 16


def poisson_table(rate: Column) -> Column:
    """Struct of ``draws`` and the cumulative probabilities ``cdf`` of one draw.

    Entries within 1e-12 of one are left out; draws have a resolution of 1e-6.
    """
    draws = F.greatest(F.lit(1), F.ceil(rate / _LARGEST_RATE)).cast("int")
    share = rate / draws
    first = F.exp(-share)
    start = F.struct(first.alias("p"), F.array(first).alias("cdf"))

    def step(state, k):
        p = state["p"] * share / k
        return F.struct(p.alias("p"), F.array_append(state["cdf"], F.element_at(state["cdf"], -1) + p).alias("cdf"))

    cdf = F.aggregate(F.sequence(F.lit(1), F.lit(5 * _LARGEST_RATE)), start, step, lambda state: state["cdf"])
    return F.struct(draws.alias("draws"), F.filter(cdf, lambda c: c < 1 - 1e-12).alias("cdf"))


def poisson_copies(key: Column, table: Column, bucket: Bucket = hash_bucket, resolution: int = 1_000_000) -> Column:
    """Poisson copies of a row from its key: per draw, the entries of the cumulative
    probabilities that do not exceed the key's hash."""

    def draw(total, j):
        uniform = bucket(key, resolution, j) / F.lit(float(resolution))
        return total + F.size(F.filter(table["cdf"], lambda c: c <= uniform))

    return F.aggregate(F.sequence(F.lit(0), table["draws"] - 1), F.lit(0), draw)


def bootstrap_sample(df: DataFrame, ratio: float, key: str, bucket: Bucket = hash_bucket) -> DataFrame:
    """Sample with replacement: each row gets Poisson(``ratio``) copies."""
    return repeat_rows(df, poisson_copies(F.col(key), poisson_table(F.lit(float(ratio))), bucket))


def _class_plan(df: DataFrame, label: str) -> DataFrame:
    """Per class, null being one: its rows ``_n`` and the rows of the largest class ``_target``."""
    sizes = stage(df.groupBy(label).agg(F.count("*").alias("_n")), "class-sizes")
    return sizes.withColumn("_target", sizes.agg(F.max("_n")).scalar())


def oversample_poisson(df: DataFrame, label: str, key: str, bucket: Bucket = hash_bucket) -> DataFrame:
    """Bootstrap each class at the rate that brings it near the largest class.

    One pass over the rows for all classes, against one scan per class.
    """
    plan = _class_plan(df, label).withColumn("_table", poisson_table(F.col("_target") / F.col("_n")))
    rated = keyed_join(df, stage(plan, "class-rates"), [label], "_n")
    return repeat_rows(rated, poisson_copies(F.col(key), F.col("_table"), bucket)).drop("_n", "_target", "_table")


def oversample_near(df: DataFrame, label: str, key: str, bucket: Bucket = hash_bucket) -> DataFrame:
    """Whole copies for all rows, one more for the hashed share that is missing.

    Near the target size, without any sort or window.
    """
    missing = F.expr("_target % _n") / F.col("_n")
    plan = _class_plan(df, label).select(label, "_n", F.expr("_target div _n").alias("_whole"), missing.alias("_missing"))
    planned = keyed_join(df, stage(plan, "class-copies"), [label], "_n")
    one_more = bucket(F.col(key), 1_000_000) < F.col("_missing") * 1_000_000
    return repeat_rows(planned, F.col("_whole") + one_more.cast("int")).drop("_n", "_whole", "_missing")


# Digits that order the rows of a class: the bucket, then four each of the key, the whole row and the row's place.
_DIGIT_BITS, _DIGITS = 16, 13


def _digits(number: Column) -> list[Column]:
    """A long as four digits of 16 bits, in the order of the numbers."""
    shifted = number.bitwiseXOR(F.lit(-(2**63)))
    return [F.shiftrightunsigned(shifted, at).bitwiseAND(2**_DIGIT_BITS - 1).cast("int") for at in (48, 32, 16, 0)]


def _in_order(df: DataFrame, key: str, bucket: Column) -> DataFrame:
    """Add ``_digits``, by which no two rows are equal: bucket, key, row, and place in the written table."""
    integral = isinstance(df.schema[key].dataType, IntegralType)
    number = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63))) if integral else F.xxhash64(key)
    row = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in df.columns])
    placed = stage(df.withColumn("_place", F.monotonically_increasing_id()), "rows-in-place")
    digits = [bucket, *_digits(number), *_digits(row), *_digits(F.col("_place"))]
    return placed.withColumn("_digits", F.array(*digits)).drop("_place")


def first_rows(df: DataFrame, label: str, key: str, wanted: DataFrame, bucket: Bucket = hash_bucket, buckets: int = 65_536) -> DataFrame:
    """Add ``_first``: whether a row is among the first of its class, as many as ``wanted`` says.

    ``wanted`` is a staged table with one row per class: ``label``, its rows ``_n`` and the number ``_take``, less than
    ``_n``. Order: hash bucket of the key, the key (integers by value, other types by hash), a hash of the row; equal
    rows by their place in a table that is written once. A null label is a class, a null key comes first.

    No row is ranked. Rows are counted per class and digit, at most 65,536 counts per class; the digit in
    which the cut falls is fixed, and only its rows are counted by the next digit, until the cut lies
    between digits. Equal keys, even half a class of them, are told apart by later digits.
    """
    if not 0 < buckets <= 2**_DIGIT_BITS:
        raise ValueError("buckets must be in 1 .. 65536")
    hashed = _in_order(df, key, bucket(F.col(key), buckets).cast("int"))
    narrow = stage(hashed.select(label, "_digits"), "digits")
    none = F.array().cast("array<int>")
    # Before any digit nothing is taken where nothing is wanted.
    cuts = [wanted.where("_take = 0").select(label, F.array(F.lit(-1)).alias("_cut"))]
    undecided = wanted.where("_take > 0").select(label, "_n", "_take", none.alias("_cut"))
    for level in range(_DIGITS):
        undecided = stage(undecided, "undecided")
        inside = keyed_join(narrow, undecided, [label], "_n").where(F.slice("_digits", 1, level) == F.col("_cut"))
        counts = inside.groupBy(label, F.col("_digits")[level].alias("_digit")).agg(
            F.count("*").alias("_rows"), F.first("_n").alias("_n"), F.first("_take").alias("_take"), F.first("_cut").alias("_cut")
        )
        # At most 65,536 rows per class.
        upto = Window.partitionBy(label).orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
        running = counts.withColumn("_upto", F.sum("_rows").over(upto)).where("_upto >= _take AND _upto - _rows < _take")
        fixed = stage(
            running.select(label, "_n", F.array_append("_cut", F.col("_digit")).alias("_cut"), F.expr("_take - _upto + _rows").alias("_take"), "_rows"), "fixed-digits"
        )
        cuts.append(fixed.where("_take = _rows").select(label, "_cut"))
        undecided = fixed.where("_take < _rows").drop("_rows")
        if undecided.isEmpty():
            break
    last = reduce(DataFrame.unionByName, cuts)
    sized = last.join(wanted.select(F.col(label).alias("_label"), "_n"), F.col(label).eqNullSafe(F.col("_label"))).drop("_label")
    marked = keyed_join(hashed, stage(sized, "cuts"), [label], "_n")
    is_first = F.slice("_digits", 1, F.size("_cut")) <= F.col("_cut")
    return marked.withColumn("_first", is_first).drop("_digits", "_cut", "_n")


def oversample(
    df: DataFrame, label: str, key: str, bucket: Bucket = hash_bucket, buckets: int = 65_536
) -> DataFrame:
    """Repeat rows until every class has exactly as many as the largest one.

    All rows get whole copies; the missing remainder goes to the first rows in (bucket, key) order,
    see ``first_rows``. A null label is a class like any other, and no row is lost.
    """
    plan = _class_plan(df, label)
    wanted = stage(plan.select(label, "_n", F.expr("_target % _n").alias("_take"), F.expr("_target div _n").alias("_whole")), "class-targets")
    marked = first_rows(df, label, key, wanted.drop("_whole"), bucket, buckets)
    planned = keyed_join(marked, wanted.select(label, "_n", "_whole"), [label], "_n")
    copies = F.col("_whole") + F.col("_first").cast("int")
    return repeat_rows(planned, copies).drop("_n", "_whole", "_first")
