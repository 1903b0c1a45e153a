"""Rows with nulls are scored, split and stored as stated, not lost."""

import pytest
from pyspark.ml import PipelineModel

from staylens.functions.keys import arithmetic_bucket
from staylens.operators.text_features import term_vector_stages
from staylens.plans.anomalies import cluster_distances
from staylens.sources.registry import RunRegistry
from staylens.streaming.scoring import read_stream
from staylens.workspace import new_dir


def test_null_text_has_an_empty_vector(spark):
    texts = spark.createDataFrame([(1, None), (2, ""), (3, "clean room")], "id int, text string")
    vectors = PipelineModel(term_vector_stages("text")).transform(texts).orderBy("id").collect()
    assert [r["text"] for r in vectors] == [None, "", "clean room"]
    assert vectors[0]["raw_features"] == vectors[1]["raw_features"]


def test_anomaly_model_fills_nulls_by_its_means(spark, tmp_path):
    rows = spark.createDataFrame([(i, float(i % 5), None if i == 3 else i) for i in range(20)], "id int, a double, b int")
    run = cluster_distances("m", "t", rows, ["a", "b"], k=2, model_dir=str(tmp_path)).runs[0]
    loaded = PipelineModel.load(run.record.model_path)
    new = spark.createDataFrame([(1, None, None), (2, 1.0, 5)], "id int, a double, b int")
    found = loaded.transform(new).orderBy("id").collect()
    assert [r["a"] for r in found] == [2.0, 1.0] and found[0]["b"] == pytest.approx(187 / 19)
    assert all(r["cluster"] is not None for r in found)


def test_a_null_key_has_a_bucket(spark):
    keys = spark.createDataFrame([(None,), (0,)], "k long")
    assert len({r[0] for r in keys.select(arithmetic_bucket(keys["k"], 100)).collect()} - {None}) == 1


def test_puts_need_key_and_version(spark):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    with pytest.raises(ValueError, match="put_seq"):
        registry.put_frame(spark.createDataFrame([("k",)], "row_key string"))
    with pytest.raises(Exception, match="null put_seq"):
        registry.put_frame(spark.createDataFrame([("k", None)], "row_key string, put_seq long"))


@pytest.mark.parametrize("files", ["one file", "a folder"])
def test_stream_reads_a_table_by_its_name(spark, tmp_path, files):
    if files == "a folder":
        spark.range(20).repartition(3).write.parquet(f"{tmp_path}/t.parquet")
    else:
        spark.range(20).toPandas().to_parquet(f"{tmp_path}/t.parquet")
    stream = read_stream(spark, f"{tmp_path}/t.parque[t]", spark.range(1).schema)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", new_dir(spark, "checkpoint"))
    writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 20
