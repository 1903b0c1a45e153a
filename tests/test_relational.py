from __future__ import annotations

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from staylens.functions import dates, ratings
from staylens.operators import aggregates, joins, nulls, projection, quantiles, ranking
from staylens.sources.keylists import read_key_list, write_key_list
from staylens.sources.reviews import REVIEW_SCHEMA, read_reviews_json, register_reviews
from staylens.workspace import stage


def test_reviews_from_json(spark, tmp_path):
    path = tmp_path / "reviews.json"
    path.write_text(
        '{"id": 1, "offering_id": 7, "text": "Très bien", "ratings": {"rooms": 4.0, "overall": 5}, "author": {"id": "a"}}\n'
        '{"id": 2, "ratings": null, "author": {"id": null, "num_helpful_votes": 3}, "unknown": 1}\n'
    )
    reviews = read_reviews_json(spark, str(path))
    assert reviews.schema == REVIEW_SCHEMA
    register_reviews(reviews, "json_reviews")
    found = spark.sql("SELECT id, text, ratings.rooms AS rooms, ratings['overall'] AS overall, author.id AS author FROM json_reviews")
    assert rows(found) == [("a", 1, 5.0, 4.0, "Très bien"), (None, 2, None, None, None)]


def test_key_list(spark, tmp_path):
    path = tmp_path / "keys.txt"
    path.write_text("  b \n\n\ta\n   \nc\n")
    assert [r.row_key for r in read_key_list(spark, str(path)).collect()] == ["b", "a", "c"]
    again = str(tmp_path / "again")
    for _ in range(2):
        write_key_list(read_key_list(spark, str(path)), again)
    assert rows(read_key_list(spark, again)) == [("a",), ("b",), ("c",)]


@pytest.mark.parametrize(
    "text, month, year",
    [
        ("December 2012", 12, 2012),
        ("  March 1999 ", 3, 1999),
        ("May", 5, None),
        ("Dec 2012", None, 2012),
        ("2012", None, 2012),
        ("june 2012", None, 2012),
        ("January 123", 1, None),
        ("July 20125", 7, 2012),
        ("", None, None),
        (None, None, None),
    ],
)
def test_stay_date(spark, text, month, year):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(dates.stay_month(F.col("s")), dates.stay_year(F.col("s"))).first() == (month, year)


def test_bad_number_is_null(spark):
    df = spark.createDataFrame([("4.5",), ("good",), (None,)], "s string")
    assert [r[0] for r in df.select(ratings.to_double(F.col("s"))).collect()] == [4.5, None, None]


def test_labels(spark):
    df = spark.createDataFrame([(3.9,), (4.0,), (None,)], "x double")
    assert [r[0] for r in df.select(ratings.sentiment_label(F.col("x"))).collect()] == [0.0, 1.0, None]
    assert [r[0] for r in df.select(ratings.sentiment_label(F.col("x"), null_is_negative=True)).collect()] == [0, 1, 0]
    thirds = ratings.quantile_label(F.col("x"), F.lit(3.9), F.lit(4.0))
    assert [r[0] for r in df.select(thirds).collect()] == ["Low", "Medium", "High"]


def test_degenerate_thirds_have_no_high(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 4, 4, 5, 5, 5, 5)], "x double")
    for accuracy in (None, 10_000):
        labelled = quantiles.with_quantile_label(df, "x", "label", accuracy=accuracy)
        assert {r.label for r in labelled.collect()} == {"Low", "Medium"}


def test_exact_quantiles_equal_spark(spark):
    df = spark.range(1001).select((F.col("id") * 37 % 500).cast("double").alias("x"))
    probabilities = [0.0, 0.1, 0.3333, 0.5, 0.6666, 1.0]
    found = {r.p: r.value for r in ranking.exact_quantiles(df, "x", probabilities).collect()}
    assert [found[p] for p in probabilities] == df.approxQuantile("x", probabilities, 0.0)


def test_entity_stats_null_key_and_null_measure(spark):
    df = spark.createDataFrame([(None, None), (None, 1.0), (1, 2.5), (1, 3.5), (2, None)], "k long, x double")
    assert rows(aggregates.entity_stats(df, "k", ["x"])) == [(3.0, 1, 0.5), (0.0, 2, 0.0)][::-1]


def test_entity_stats_of_nothing(spark):
    empty = spark.createDataFrame([], "k long, x double")
    stats = aggregates.entity_stats(empty, "k", ["x"])
    assert stats.columns == ["k", "avg_x", "stddev_x"] and stats.count() == 0


def test_mean_imputation(spark):
    df = spark.createDataFrame([(1, 1, None), (2, None, None), (3, 4, None)], "id int, a int, b double")
    filled = nulls.impute_means(df, ["a", "b"], default=-1.0)
    assert rows(filled) == [(1.0, -1.0, 1), (2.5, -1.0, 2), (4.0, -1.0, 3)]


def test_assembly(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (4.0, float("nan"))], "a double, b double")
    assert nulls.assemble(df, ["a", "b"], "v", skip_invalid=True).count() == 1
    with pytest.raises(Exception, match="[Nn]ull|NaN"):
        nulls.assemble(df, ["a", "b"], "v").collect()


def test_left_join_keeps_schema_and_null_keys(spark):
    base = spark.createDataFrame([("a", 1), (None, 2)], "k string, x int")
    empty = spark.createDataFrame([], "k string, y int")
    null_key = spark.createDataFrame([(None, 9), ("a", 8)], "k string, y int")
    assert joins.left_join_features(base, None, "k") is base
    assert rows(joins.left_join_features(base, empty, "k")) == [("a", 1, None), (None, 2, None)]
    assert rows(joins.fold_features(base, [None, null_key], "k")) == [("a", 1, 8), (None, 2, None)]


def test_duplicate_review_ids_do_not_fan_out(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (None, "d"), (2, None)], "id long, text string")
    assert rows(aggregates.review_features(df)) == [(1, 1, 1), (1, 3, 2), (None, 1, 1)]


@pytest.mark.parametrize("max_rows", [1, 4, 20, 1_000])
def test_keyed_join_is_the_plain_join(spark, max_rows):
    """One key holds a third of the rows; some rows have no key or no match."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 50)
    left = spark.range(3000).select("id", key.alias("k"))
    counts = left.groupBy("k").agg(F.count("*").alias("n")).where("k IS NOT NULL AND k <> 11")
    staged = stage(counts.withColumn("y", F.col("k") * 10), "keys")
    joined = joins.keyed_join(left, staged, ["k"], "n", max_rows)
    assert rows(joined) == rows(left.join(staged, "k"))


def test_keyed_join_strategies(spark):
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"))
    staged = stage(left.groupBy("k").agg(F.count("*").alias("n")), "keys")
    plain = plan_of(joins.keyed_join(left, staged, ["k"], "n"))
    assert plain.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plain
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = plan_of(joins.keyed_join(left, staged, ["k"], "n", max_rows=500))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert split.count("BroadcastHashJoin") == 2 and split.count("SortMergeJoin") == 1


def test_running_totals_match_window_for_any_number_of_ranges(spark):
    df = spark.range(400).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 401).alias("o"), F.col("id").alias("n"))
    df = stage(df.groupBy("g", "o").agg(F.sum("n").alias("n")), "totals")
    df.createOrReplaceTempView("totals")
    expected = rows(
        spark.sql(
            """SELECT g, o, n, coalesce(sum(n) OVER (PARTITION BY g ORDER BY o
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_n FROM totals"""
        )
    )
    for ranges in (1, 2, 7, 64):
        assert rows(ranking.running_totals(df, "o", ["n"], ["g"], ranges)) == expected


def test_rank_with_ties(spark):
    """A third of the rows share one score."""
    df = spark.range(300).select(
        F.col("id").cast("string").alias("key"),
        (F.col("id") % 2).alias("g"),
        F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") == 7, None).otherwise(F.col("id") % 20).cast("double").alias("s"),
    )
    df.createOrReplaceTempView("scores")
    expected = spark.sql("SELECT *, CAST(rank() OVER (PARTITION BY g ORDER BY s DESC) AS LONG) AS rank FROM scores WHERE s IS NOT NULL")
    assert rows(ranking.ranked(df, ["g"], "s")) == rows(expected)


def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, (2.0, None)), (2, None)], "id int, ratings struct<a double, b double>")
    assert rows(projection.expand_struct(df, ["id"], "ratings")) == [(2.0, None, 1), (None, None, 2)]
    assert rows(aggregates.row_counts(df, ["ratings.a", "ratings.b"])) == [(1, 0, 2)]
    other = spark.createDataFrame([(3,)], "id int")
    assert projection.union_all(df.select("id"), other, other).count() == 4


def test_ranks_keep_the_type_of_the_score(spark):
    """Integers above 2^53, decimals, timestamps and text; null is a group of its own."""
    big = 2**53
    df = spark.createDataFrame([(None, big), (None, big + 1), (None, big + 2), ("a", big), ("a", None)], "g string, s long")
    assert rows(ranking.ranked(df, ["g"], "s")) == sorted(
        [(None, 3, big), (None, 2, big + 1), (None, 1, big + 2), ("a", 1, big)], key=str
    )
    typed = df.where("g IS NULL").selectExpr(
        "s", "CAST(s AS DECIMAL(38, 18)) / 3 AS d", "timestamp_micros(s) AS t", "CAST(s AS STRING) AS v", "named_struct('a', 0, 'b', s) AS w"
    )
    for column in ("d", "t", "v", "w"):
        ranks = ranking.ranked(typed.select("s", column), [], column, descending=False)
        assert {r["s"]: r["rank"] for r in ranks.collect()} == {big: 1, big + 1: 2, big + 2: 3}


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_running_totals_over_hot_groups(spark, ranges):
    """One group holds two thirds of the rows and spans ranges; two columns give the order."""
    df = spark.range(600).select(
        F.when(F.col("id") % 3 > 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") % 7).alias("a"),
        (F.col("id") * 31 % 601).alias("b"),
        F.xxhash64("id").alias("x"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("n"),
    )
    df.createOrReplaceTempView("hot_groups")
    frame = "(PARTITION BY g ORDER BY a DESC, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    expected = spark.sql(f"SELECT *, coalesce(sum(n) OVER {frame}, 0) AS before_n, coalesce(bit_xor(x) OVER {frame}, 0) AS before_x FROM hot_groups")
    found = ranking.running_totals(df, [F.desc("a"), "b"], ["n"], ["g"], ranges, xors=["x"])
    assert rows(found) == rows(expected)


def test_exact_quantiles_per_group_and_type(spark):
    df = spark.range(500).selectExpr("IF(id % 2 = 0, 'even', NULL) AS g", "timestamp_seconds(id * 7 % 501) AS t")
    df.createOrReplaceTempView("timed")
    expected = spark.sql(
        """SELECT g, p, value FROM (SELECT g, percentile_disc(0.25) WITHIN GROUP (ORDER BY unix_seconds(t)) AS q1,
        percentile_disc(0.9) WITHIN GROUP (ORDER BY unix_seconds(t)) AS q2 FROM timed GROUP BY g)
        LATERAL VIEW inline(array(struct(0.25D, timestamp_seconds(q1)), struct(0.9D, timestamp_seconds(q2)))) AS p, value"""
    )
    assert rows(ranking.exact_quantiles(df, "t", [0.25, 0.9], ["g"])) == rows(expected)
    assert [r["value"] for r in ranking.exact_quantiles(df.limit(0), "t", [0.5]).collect()] == [None]


def test_keyed_join_meets_null_keys_and_shuffles_large_rows(spark):
    left = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "b")], "id int, k string")
    staged = stage(spark.createDataFrame([(None, 2, "x"), ("a", 1, "y")], "k string, n long, v string"), "keys")
    expected = [(1, None, 2, "x"), (2, None, 2, "x"), (3, "a", 1, "y")]
    assert sorted((r["id"], r["k"], r["n"], r["v"]) for r in joins.keyed_join(left, staged, ["k"], "n").collect()) == expected
    assert sorted((r["id"], r["k"], r["n"], r["v"]) for r in joins.keyed_join(left, staged, ["k"], "n", max_bytes=5).collect()) == expected
