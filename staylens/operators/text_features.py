"""Terms, hashed terms and TF-IDF."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.ml.feature import HashingTF, SQLTransformer, StopWordsRemover, Tokenizer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from staylens.functions import hashing
from staylens.functions.stopwords import ENGLISH_STOP_WORDS
from staylens.functions.text import current_term_bucket, term_bucket, tokens, without_stop_words
from staylens.operators.joins import keyed_join
from staylens.workspace import stage, stage_for_fit

# Executors need not have this package: the functions go to them with the task.
cloudpickle.register_pickle_by_value(hashing)

# Fixed value: feature buckets of the sentiment job.
TERM_BUCKETS = 20_000

# As many tasks as the gradients of a fit are added from in one stage: treeAggregate, to its default depth, puts another between for more.
ONE_STAGE = 5


def term_counts(df: DataFrame, key: str, words: Column, term: str = "term") -> DataFrame:
    """How often each term occurs per text."""
    return df.select(key, F.explode(words).alias(term)).groupBy(key, term).agg(F.count("*").alias("tf"))


def hashed_term_counts(
    df: DataFrame, key: str, words: Column, buckets: int = TERM_BUCKETS, bucket: Callable[[Column, int], Column] = term_bucket
) -> DataFrame:
    """Term counts per feature bucket, as long rows. ``bucket`` gives a term's index:
    ``term_bucket``, or ``current_term_bucket`` for that of the running Spark's ``HashingTF``.

    A term is hashed once per text it occurs in, after its occurrences are counted.
    """
    counts = with_bucket(term_counts(df, key, words), "term", buckets, bucket).select(key, "bucket", "tf")
    return counts.groupBy(key, "bucket").agg(F.sum("tf").alias("tf"))


def with_bucket(df: DataFrame, term: str, buckets: int, bucket: Callable[[Column, int], Column]) -> DataFrame:
    """``df`` with the index of ``term`` as ``bucket``.

    A function that takes ``let`` gets one that holds its values as columns, named ``_value1`` and so on:
    steps of plain projections run as generated code, lambdas do not.
    """
    held = []

    def column(value: Column, body: Callable[[Column], Column]) -> Column:
        held.append(value)
        return body(F.col(f"_value{len(held)}"))

    takes_let = "let" in inspect.signature(bucket).parameters
    index = bucket(F.col(term), buckets, let=column) if takes_let else bucket(F.col(term), buckets)
    for n, value in enumerate(held, 1):
        df = df.withColumn(f"_value{n}", value)
    return df.withColumn("bucket", index)


def tfidf(counts: DataFrame, texts: DataFrame, key: str, term: str, buckets: int | None = None) -> DataFrame:
    """Weight counts by ``ln((texts + 1) / (texts with the term + 1))``.

    Hashed counts name their number of ``buckets``: that is how many weights there are
    at most, and up to a million of them are broadcast. A vocabulary has no such bound,
    and some terms are in most texts: it is joined by ``keyed_join``. Counts are staged, as both branches
    read them: a plan with lambdas is not recognised as the same, and would run twice.
    """
    total = texts.agg(F.count("*")).scalar()
    hashed = buckets is not None and buckets <= 1_000_000
    counts = stage(counts, "term-counts")
    frequency = counts.groupBy(term).agg(F.count_if(F.col("tf") > 0).alias("df"))
    weights = frequency.select(term, "df", F.log((total + 1) / (F.col("df") + 1)).alias("idf"))
    if hashed:
        weighted = counts.join(F.broadcast(weights), term)
    else:
        weighted = keyed_join(counts, stage(weights, "term-weights"), [term], "df")
    return weighted.select(key, term, "tf", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def term_indices(text: Column, buckets: int = TERM_BUCKETS) -> Column:
    """Feature index of each word of a text, repeats included, as ``term_vector_stages`` of the running Spark has them."""
    return F.transform(without_stop_words(tokens(text)), lambda w: current_term_bucket(w, buckets))


def indexed_terms(df: DataFrame, text: str, output: str = "indices", buckets: int = TERM_BUCKETS) -> DataFrame:
    """The other columns of ``df`` with the indices of ``term_indices``, in no set order; every row counts, equal ones too.

    Words are hashed as rows, which generated code does, and gathered again by a number of the row: in its task first,
    so that what is shuffled is one list a row.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != text]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    terms = numbered.select("_row", *others, F.explode_outer(tokens(F.col(text))).alias("_term"))
    # A stop word becomes null and has no index, as a text without words has none: its row stays.
    kept = terms.withColumn("_term", F.when(~F.lower("_term").isin([w.lower() for w in ENGLISH_STOP_WORDS]), F.col("_term")))
    hashed = with_bucket(kept, "_term", buckets, current_term_bucket)
    return hashed.groupBy("_row", *others).agg(F.collect_list("bucket").alias(output)).drop("_row")


def term_vector_stages(text: str, output: str = "raw_features", buckets: int = TERM_BUCKETS) -> list:
    """Stages from text to a hashed term count vector; they need no fitting. Null text is empty."""
    return [
        SQLTransformer(statement=f"SELECT *, coalesce(`{text}`, '') AS filled_text FROM __THIS__"),
        Tokenizer(inputCol="filled_text", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=ENGLISH_STOP_WORDS),
        HashingTF(inputCol="filtered_words", outputCol=output, numFeatures=buckets),
    ]


def staged_term_vectors(df: DataFrame, text: str, output: str = "raw_features", buckets: int = TERM_BUCKETS) -> DataFrame:
    """``df`` staged for a fit with, in place of its text, the vector that ``term_vector_stages`` make of it.

    Each of those stages takes a row's words into objects and back. Here Spark lower-cases the text, and numpy cuts,
    hashes and counts the words of many rows at once (``functions/hashing.py``), in the tasks that read them.
    """
    others = [c for c in df.columns if c != text]
    lowered = df.select(*[f"`{c}`" for c in others], F.lower(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias(text))
    kept = [df.schema[c] for c in others]
    rows = lowered.mapInArrow(hashing.vector_batches(text, output, buckets), StructType([*kept, StructField(output, VectorUDT.sqlType())]))
    return stage_for_fit(rows, "term-vectors", schema=StructType([*kept, StructField(output, VectorUDT())]), least=ONE_STAGE)
