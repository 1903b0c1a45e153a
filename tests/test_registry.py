from __future__ import annotations

from datetime import datetime, timezone

from conftest import rows
from pyspark.sql import functions as F

from staylens.operators import registry_views as views
from staylens.sources.registry import PUT_SCHEMA, RunRecord, RunRegistry
from staylens.streaming.scoring import read_stream, score_stream
from staylens.workspace import new_dir, shared_base, stage, stage_for_fit

STAMP = datetime(2025, 6, 11, 10, 46, 6, tzinfo=timezone.utc)


def record(key, score, score_type="AUC", task="t", **more):
    return RunRecord(key, task, key.upper(), STAMP, 1.5, score, score_type, f"m/{key}", **more)


def test_puts_merge_cell_by_cell(spark):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    assert registry.read().count() == 0 and registry.read().schema["row_key"].dataType.typeName() == "string"
    registry.put([record("a", 0.5), record("b", 0.7)])
    registry.put([RunRecord("a", "t", "again", STAMP, evaluation_score=0.9)])
    found = {r.row_key: r for r in registry.read().collect()}
    assert (found["a"].model_name, found["a"].evaluation_score, found["a"].model_path) == ("again", 0.9, "m/a")
    assert found["b"].evaluation_score == 0.7
    assert registry.puts().count() == 3
    smaller = registry.compact(new_dir(spark, "compact"))
    assert smaller.puts().count() == 2
    assert rows(smaller.read().drop("details")) == rows(registry.read().drop("details"))


def test_hot_key(spark):
    """A third of all puts go to one key."""
    puts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("row_key"),
        F.col("id").cast("double").alias("evaluation_score"),
        F.col("id").alias("put_seq"),
    )
    merged = views.latest(puts)
    assert merged.count() == 2001
    assert merged.where("row_key = 'hot'").first().evaluation_score == 2997.0


def test_keys_lookup_get(spark):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    registry.put([record(k, 0.1) for k in ("b", "C", "a", "a")])
    assert [r.row_key for r in registry.keys().collect()] == ["C", "a", "b"]
    assert [r.row_key for r in registry.keys(limit=2).collect()] == ["C", "a"]
    wanted = spark.createDataFrame([("a",), ("zz",), ("a",)], "row_key string")
    assert rows(registry.lookup(wanted).select("row_key", "model_path")) == [("m/a", "a"), (None, "zz")]
    assert registry.get(["a", "none"]).count() == 1


def test_leaderboard_and_best(spark):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    registry.put(
        [
            record("a", 0.5), record("b", 0.9), record("c", 0.9), record("d", None),
            record("e", 3.0, "ClusterDistance", task="u"), record("f", 1.0, "ClusterDistance", task="u"),
        ]
    )
    ranks = {r.row_key: r["rank"] for r in registry.leaderboard().collect()}
    assert ranks == {"a": 3, "b": 1, "c": 1, "e": 2, "f": 1}
    assert registry.best_run("t")["row_key"] == "c"
    assert registry.best_run("u")["row_key"] == "f"


def test_text_cells(spark):
    details = {"f1_score": 0.5, "precision": 0.25, "recall": 1.0, "confusion_matrix": [{"label": 0.0, "prediction": 1.0, "count": 3}]}
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    registry.put([RunRecord("k", "t", "M", STAMP, 1.005, 0.12345, "AUC", "p", details)])
    row = views.as_text_cells(registry.read()).first()
    assert row.run_timestamp == "20250611104606" and row.evaluation_score == "0.1234"
    assert row.details == '{"f1_score":0.5,"precision":0.25,"recall":1.0,"confusion_matrix":[{"label":0.0,"prediction":1.0,"count":3}]}'
    assert PUT_SCHEMA.names[0] == "row_key"


def test_row_key(spark):
    df = spark.createDataFrame([("Task", "KMeans", STAMP)], "t string, m string, ts timestamp")
    assert df.select(views.make_row_key(F.col("t"), F.col("m"), F.col("ts"))).first()[0] == "Task_kmeans_20250611104606"


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(5), "numbers")
    assert rows(staged) == [(i,) for i in range(5)]
    assert shared_base(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(shared_base(spark) in f for f in staged.inputFiles())


def test_small_fit_inputs_are_read_by_few_tasks(spark):
    df = spark.range(0, 1000, 1, 8)
    assert stage_for_fit(df, "small").rdd.getNumPartitions() == 1
    assert stage_for_fit(df, "small", rows_per_task=400).rdd.getNumPartitions() == 3
    assert stage_for_fit(df, "large", rows_per_task=1).rdd.getNumPartitions() > 3
    assert rows(stage_for_fit(df, "small")) == rows(df)


def test_stream_continues_where_it_stopped(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import Tokenizer

    model = PipelineModel([Tokenizer(inputCol="text", outputCol="words")])
    source, output, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in (["one two", "three"], ["four"]):
        spark.createDataFrame([(t,) for t in batch], "text string").coalesce(1).write.mode("append").parquet(source)
        stream = read_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
        score_stream(stream, model, ["text", "words"], output, state).awaitTermination()
    scored = spark.read.parquet(output)
    assert rows(scored.select("text")) == [("four",), ("one two",), ("three",)]


def test_nan_is_no_score(spark):
    from staylens.operators.registry_views import best_runs, leaderboard

    runs = [("a", "t", "AUC", 0.7), ("b", "t", "AUC", float("nan")), ("c", "t", "AUC", 0.6)]
    frame = spark.createDataFrame(runs, "row_key string, task_name string, score_type string, evaluation_score double")
    assert [r["row_key"] for r in best_runs(frame).collect()] == ["a"]
    assert {r["row_key"]: r["rank"] for r in leaderboard(frame).collect()} == {"a": 1, "c": 2}
