from __future__ import annotations

import math

import pytest
from conftest import plan_of, rows
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, StopWordsRemover, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staylens.functions import text as tx
from staylens.functions.stopwords import ENGLISH_STOP_WORDS
from staylens.operators import text_features

TEXTS = ["The Room  was GOOD", " leading", "trailing  ", "", "   ", "tab\there\nline", "Ñandú ÉTÉ straße", "a a b  "]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").cache()


def test_tokens_equal_mllib(spark, texts):
    tokenized = Tokenizer(inputCol="text", outputCol="mllib").transform(texts)
    compared = tokenized.withColumn("ours", tx.tokens(F.col("text")))
    for row in compared.collect():
        assert row.ours == row.mllib, row.text
    null = spark.createDataFrame([(None,)], "text string")
    assert null.select(tx.tokens(F.col("text"))).first()[0] == [""]


def test_stop_words_equal_mllib(spark, texts):
    assert StopWordsRemover.loadDefaultStopWords("english") == ENGLISH_STOP_WORDS
    words = texts.withColumn("words", F.split("text", " "))
    remover = StopWordsRemover(inputCol="words", outputCol="mllib")
    compared = remover.transform(words).withColumn("ours", tx.without_stop_words(F.col("words")))
    assert all(r.ours == r.mllib for r in compared.collect())


@pytest.mark.parametrize("text, right, compat", [("one two  three", 3, 1), (" a", 2, 1), ("", 1, 1), (r"a\sb c", 2, 2)])
def test_word_count(spark, text, right, compat):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(tx.word_count(F.col("t")), tx.word_count(F.col("t"), compat=True)).first() == (right, compat)


def test_buckets_equal_hashing_tf(spark):
    """On terms of whole four-byte words all versions of HashingTF agree."""
    words = spark.createDataFrame([(["good", "room", "bathroom", "verygoodstay"],)], "w array<string>")
    vector = HashingTF(inputCol="w", outputCol="v", numFeatures=20_000).transform(words).first().v
    buckets = words.select(F.transform("w", lambda w: tx.term_bucket(w))).first()[0]
    assert sorted(buckets) == sorted(int(i) for i in vector.indices)


def test_current_buckets_equal_hashing_tf(spark):
    """Terms of every length modulo four, one to four bytes a letter, empty and long ones, null."""
    import random

    rng = random.Random(6)
    terms = ["", "a", "ab", "abc", "x" * 1_001, "\x00", "\x00\x00\x00", "\x7f"]
    terms += ["".join(rng.choice("abcxyz éßñЖ中文🙂\u00ff") for _ in range(rng.randint(0, 13))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in terms], "t string")
    hasher = HashingTF(numFeatures=20_000)
    found = df.select("t", tx.current_term_bucket(F.col("t")).alias("b"), F.transform(F.array("t"), lambda t: tx.current_term_bucket(t))[0].alias("c")).collect()
    for row in found:
        assert row.b == row.c == hasher.indexOf(row.t), row.t
    assert spark.sql("SELECT CAST(NULL AS STRING) AS t").select(tx.current_term_bucket(F.col("t"))).first()[0] is None


def test_term_indices_equal_the_jobs_vectors(spark, texts):
    stages = text_features.term_vector_stages("text")
    vectors = texts
    for stage in stages:
        vectors = stage.transform(vectors)
    for row in vectors.select("raw_features", text_features.term_indices(F.col("text")).alias("ours")).collect():
        expected = {int(i): n for i, n in zip(row.raw_features.indices, row.raw_features.values, strict=True)}
        assert {i: row.ours.count(i) for i in row.ours} == expected


def test_indexed_terms_equal_term_indices(spark, texts):
    """Every row once with its indices, null, empty, blank and repeated ones too; words are hashed in plain projections."""
    odd = [(None, "b", None), (1, "a", ""), (1, "a", "   "), (1, "a", "the The of"), (2, "a", "abc ab a abcd the abc é 🙂"), (2, "a", "abc ab a abcd the abc é 🙂")]
    rows = spark.createDataFrame(odd, "id long, kind string, text string")
    rows = rows.union(texts.select("id", F.lit("t"), "text"))
    found = text_features.indexed_terms(rows, "text")
    expected = rows.select("id", "kind", F.array_sort(text_features.term_indices(F.col("text"))).alias("indices"))
    assert sorted(map(str, found.select("id", "kind", F.array_sort("indices").alias("indices")).collect())) == sorted(map(str, expected.collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan and "transform(" not in plan


def test_tfidf_equals_mllib(spark, texts):
    words = texts.withColumn("words", tx.tokens(F.col("text")))
    model = CountVectorizer(inputCol="words", outputCol="tf").fit(words)
    weighted = IDF(inputCol="tf", outputCol="w").fit(model.transform(words)).transform(model.transform(words))
    expected = {}
    for row in weighted.select("id", vector_to_array("w").alias("w"), vector_to_array("tf").alias("tf")).collect():
        expected |= {(row.id, model.vocabulary[i]): row.w[i] for i in range(len(row.w)) if row.tf[i]}
    counts = text_features.term_counts(texts, "id", tx.tokens(F.col("text")))
    for buckets in (100, None):
        found = text_features.tfidf(counts, texts, "id", "term", buckets)
        ours = {(r.id, r.term): r.tfidf for r in found.collect()}
        assert ours.keys() == expected.keys()
        assert all(math.isclose(ours[k], expected[k], abs_tol=1e-12) for k in ours)


def test_hashed_counts_add_up(spark, texts):
    words = tx.tokens(F.col("text"))
    plain = text_features.term_counts(texts, "id", words).groupBy("id").agg(F.sum("tf"))
    hashed = text_features.hashed_term_counts(texts, "id", words, 3).groupBy("id").agg(F.sum("tf"))
    assert rows(plain) == [tuple(r) for r in rows(hashed)]


def test_current_hash_runs_as_generated_code(spark, texts):
    """The hash of the running Spark is held in columns, not in lambdas, and is that of ``HashingTF``."""
    counts = text_features.hashed_term_counts(texts, "id", F.split("text", " "), bucket=tx.current_term_bucket)
    assert "lambda" not in plan_of(counts)
    vectors = HashingTF(inputCol="words", outputCol="v", numFeatures=20_000).transform(texts.withColumn("words", F.split("text", " ")))
    expected = {(r.id, int(i)): int(n) for r in vectors.collect() for i, n in zip(r.v.indices, r.v.values, strict=True)}
    assert {(r.id, r.bucket): r.tf for r in counts.collect()} == expected


def test_hashed_weights_count_terms_once(spark, texts):
    words = tx.without_stop_words(tx.tokens(F.col("text")))
    counts = text_features.hashed_term_counts(texts, "id", words, bucket=tx.current_term_bucket)
    weighted = text_features.tfidf(counts, texts, "id", "bucket", 20_000)
    assert "Generate" not in plan_of(weighted)
    assert weighted.count() == counts.count()


def test_long_runs_of_blanks_take_linear_time(spark):
    import time

    from pyspark.sql import functions as F

    from staylens.functions.text import tokens

    frame = spark.createDataFrame([("a" + " " * 100_000 + "b \t",)], "text string")
    start = time.monotonic()
    assert frame.select(F.size(tokens(F.col("text")))).first()[0] == 100_001
    assert time.monotonic() - start < 5


def test_staged_term_vectors_equal_the_stages(spark, texts, monkeypatch):
    """Vectors of the stages, bit by bit, for null, empty, blank, long and accented texts and every stop word; rows may repeat."""
    import random

    from staylens.functions import hashing
    from staylens.functions.stopwords import ENGLISH_STOP_WORDS

    rng = random.Random(8)
    pieces = [*ENGLISH_STOP_WORDS, "The", "YOURSELVES", "themselvesx", "yourselve", "a\x00", "\x00", "İx", "ΑΣ", "ß", "中文", "🙂", "K", "é", "x" * 1_001, "Word", "\u00a0", "\u2003"]
    odd = [None, "", " ", " \t\n\x0b\f\r", "  a  b ", "the", "x", " ".join(ENGLISH_STOP_WORDS), "\x1c x\x1dy"]
    odd += ["".join(rng.choice(pieces) + rng.choice([" ", "  ", "\n", "\t", "", "\r"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    rows = spark.createDataFrame([(None if i % 9 == 0 else i % 50, t) for i, t in enumerate(odd)], "id long, text string").union(texts.select("id", "text"))
    expected = rows
    for stage in text_features.term_vector_stages("text", buckets=500):
        expected = stage.transform(expected)
    monkeypatch.setattr(hashing, "SLICE_BYTES", 200)
    found = text_features.staged_term_vectors(rows, "text", buckets=500)
    assert found.schema["raw_features"].dataType == expected.schema["raw_features"].dataType
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.select("id", "raw_features").collect()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
    none = text_features.staged_term_vectors(rows.limit(0), "text")
    assert none.count() == 0
