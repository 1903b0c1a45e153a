from __future__ import annotations

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from staylens.functions.keys import arithmetic_bucket, hash_bucket
from staylens.operators import sampling
from staylens.workspace import stage


@pytest.fixture(scope="module")
def classes(spark):
    """Class c holds a third and more of the rows."""
    size = F.when(F.col("id") < 1000, "c").when(F.col("id") < 1700, "a").when(F.col("id") < 1730, "b").otherwise("d")
    return spark.range(1737).withColumn("label", size)


def counts(df):
    return {r.label: r.n for r in df.groupBy("label").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("bucket", [hash_bucket, arithmetic_bucket])
@pytest.mark.parametrize("buckets", [1, 16, 65_536])
def test_oversample_is_exact(spark, classes, bucket, buckets):
    balanced = sampling.oversample(classes, "label", "id", bucket, buckets).cache()
    assert counts(balanced) == dict.fromkeys("abcd", 1000)
    assert balanced.select("id").distinct().count() == 1737
    copies = balanced.groupBy("label", "id").count().groupBy("label").agg(F.max("count") - F.min("count"))
    assert all(r[1] <= 1 for r in copies.collect())
    assert set(balanced.columns) == {"id", "label", "copy"}


def test_oversample_splits_a_repeated_key(spark):
    """Half a class is one key, a third equal rows; the cut falls inside them and no count per digit is a rank."""
    ids = spark.range(900)
    key = F.when(F.col("id") < 400, F.lit(7)).when(F.col("id") < 500, None).otherwise(F.col("id"))
    df = ids.select(key.alias("k"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"), F.lit("a").alias("label"))
    df = df.unionByName(spark.range(1_650).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"), F.lit(None).cast("string").alias("label")))
    for layout in (df.coalesce(1), df.repartition(6)):
        balanced = sampling.oversample(layout, "label", "k", arithmetic_bucket).cache()
        assert counts(balanced) == {"a": 1_650, None: 1_650}
        assert {r[0] for r in balanced.where("label = 'a'").select("copy").distinct().collect()} == {1, 2}
        assert balanced.where("copy = 1").count() == 2_550
    text = df.withColumn("k", F.concat(F.lit("key"), "k"))
    assert counts(sampling.oversample(text, "label", "k")) == {"a": 1_650, None: 1_650}


@pytest.mark.parametrize("buckets", [1, 65_536])
def test_first_rows_are_the_first_in_key_order(spark, buckets):
    df = spark.range(2_000).select((F.col("id") * 37 % 5_003 - 2_500).alias("k"), (F.col("id") % 3).alias("label")).cache()
    sizes = df.groupBy("label").agg(F.count("*").alias("_n"))
    wanted = stage(sizes.withColumn("_take", F.col("label") * 250 + F.when(F.col("label") > 0, 13).otherwise(0)), "wanted")
    found = sampling.first_rows(df, "label", "k", wanted, arithmetic_bucket, buckets)
    order = Window.partitionBy("label").orderBy(arithmetic_bucket(F.col("k"), buckets), "k")
    expected = df.withColumn("_first", F.row_number().over(order) <= F.col("label") * 250 + F.when(F.col("label") > 0, 13).otherwise(0))
    assert rows(found) == rows(expected)
    assert "Window" not in plan_of(found)


def test_null_labels_are_kept(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, label string")
    assert counts(sampling.oversample(df, "label", "id")) == {"a": 2, None: 2}
    for method in (sampling.oversample_near, sampling.oversample_poisson):
        assert None in counts(method(df.union(df).union(df), "label", "id"))


def test_oversample_does_not_depend_on_layout(spark, classes):
    for method in (sampling.oversample, sampling.oversample_near, sampling.oversample_poisson):
        first = rows(method(classes.coalesce(1), "label", "id"))
        assert rows(method(classes.repartition(7, "label"), "label", "id")) == first


def test_near_and_poisson_targets(spark, classes):
    for method, slack in ((sampling.oversample_near, 60), (sampling.oversample_poisson, 150)):
        found = counts(method(classes, "label", "id"))
        assert set(found) == set("abcd")
        assert all(abs(found[label] - 1000) < slack for label in "abc")


def test_poisson_moments(spark):
    ids = spark.range(20_000)
    for rate in (0.3, 1.0, 5.0, 40.0):
        drawn = ids.select(sampling.poisson_copies(F.col("id"), sampling.poisson_table(F.lit(rate))).alias("n"))
        mean, variance = drawn.agg(F.avg("n"), F.var_samp("n")).first()
        assert mean == pytest.approx(rate, rel=0.05)
        assert variance == pytest.approx(rate, rel=0.08)


def test_hash_split_is_stable_and_complete(spark):
    df = spark.range(5000)
    train, test = sampling.hash_split(df, "id")
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert abs(train.count() - 4000) < 150
    again, _ = sampling.hash_split(df.repartition(5), "id")
    assert rows(again) == rows(train)


def test_random_split_and_sample(spark):
    df = spark.range(5000).repartition(4)
    train, test = sampling.random_split(df)
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    assert abs(sampling.sample_with_replacement(df, 1.5).count() - 7500) < 500
    assert abs(sampling.bootstrap_sample(df, 1.5, "id").count() - 7500) < 500


def test_one_class_and_no_rows(spark):
    one = spark.range(5).withColumn("label", F.lit("x"))
    assert counts(sampling.oversample(one, "label", "id")) == {"x": 5}
    none = one.where("id < 0")
    assert sampling.oversample(none, "label", "id").count() == 0
