"""What the optimiser makes of the operators."""

from __future__ import annotations

from conftest import plan_of
from pyspark.sql import functions as F

from staylens.operators import aggregates, nulls, projection, registry_views, sampling
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import read_reviews_parquet, reviews_from_orders
from staylens.sources.tables import read_table


def test_entity_stats_reads_its_columns_and_shuffles_once(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    plan = plan_of(aggregates.entity_stats(lines, "l_suppkey", ["l_quantity", "l_tax"]))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_tax:double>" in plan
    assert "PushedFilters: [IsNotNull(l_suppkey)]" in plan
    assert plan.count("Exchange") == 1
    assert "partial_avg" in plan


def test_nested_pruning_and_pushdown(spark, sf_dir, tmp_path):
    path = str(tmp_path / "reviews")
    reviews_from_orders(spark, sf_dir).write.parquet(path)
    reviews = read_reviews_parquet(spark, path)
    plan = plan_of(projection.not_null(reviews, ["ratings.rooms"]).select("id", "ratings.service"))
    assert "ratings:struct<service:double,rooms:double>" in plan
    assert "text" not in plan.split("ReadSchema")[1]
    assert "IsNotNull(ratings.rooms)" in plan


def test_ratings_alone_need_no_join(spark, sf_dir):
    plan = plan_of(reviews_from_orders(spark, sf_dir, with_text=False).select("id", "ratings.*"))
    assert "Join" not in plan and "Exchange" not in plan
    assert "documents" not in plan


def test_user_features_are_one_aggregate(spark, sf_dir):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    plan = plan_of(aggregates.user_features(reviews))
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_review_features_do_not_shuffle(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    plan = plan_of(aggregates.review_features(documents))
    assert "Exchange" not in plan and "PushedFilters: [IsNotNull(text)]" in plan


def test_imputation_has_no_window_or_join(spark, sf_dir):
    customers = read_table(spark, sf_dir, "customer")
    plan = plan_of(nulls.impute_means(customers, ["c_acctbal"]))
    assert "Window" not in plan and "Join" not in plan


def test_split_is_row_wise(spark, sf_dir):
    train, _ = sampling.hash_split(read_table(spark, sf_dir, "orders"), "o_orderkey")
    assert "Exchange" not in plan_of(train)


def test_registry_get_pushes_the_keys_down(spark, tmp_path):
    registry = RunRegistry(spark, str(tmp_path / "registry"))
    registry.put_frame(spark.range(10).select(F.col("id").cast("string").alias("row_key"), F.col("id").alias("put_seq")))
    assert "In(row_key, [3,5])" in plan_of(registry.get(["3", "5"]))
    assert "Window" not in plan_of(registry_views.latest(registry.puts()))
