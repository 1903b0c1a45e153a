"""The corpus pipeline: quality, near duplicates, repeated passages, source mix, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import staged, table
from staylens.llm.bpe import digests, encode_decode, multi_ranks
from staylens.llm.jaccard import jaccard_join
from staylens.llm.mixing import mix_sources
from staylens.llm.quality import THRESHOLD, fit, score
from staylens.llm.repeats import removed_spans, whole_characters


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, score_col="_quality").where(F.col("_quality") >= THRESHOLD).drop("_quality")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates. Null ids stay; rows that share an id stay or go together."""
    others = jaccard_join(docs).where("class_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that one with a smaller id has; ``n_chars`` is that of the new text."""
    kept = whole_characters(removed_spans(docs, whole=True))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the source mix takes it."""
    rows = docs.select("doc_id", "text", "source", F.struct("*").alias("row"))
    taken = mix_sources(rows).where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return taken.select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of token ids, and digests of the ids and of the text they decode to."""
    return digests(encode_decode(docs, multi_ranks()))


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("repeated passages", remove_repeats),
    ("source mix", mix),
    ("token ids", encode),
]

# A trained classifier and byte-level BPE are beyond SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
