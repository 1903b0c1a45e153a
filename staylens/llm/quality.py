"""Quality classifier: averaged embeddings of hashed words and character n-grams, softmax, numpy SGD."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from staylens.llm.base import leanly, query, table
from staylens.llm.texts import Texts, blank_words, mix, piece_keys, slices, words_at

BITS = 17
GRAMS = (3, 5)
TEXT_BYTES = 1 << 20
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    """``gain`` is each feature's vector times the difference of the two output vectors.

    Averaging is linear, so the mean of gains is the difference of the two softmax inputs.
    """

    gain: np.ndarray


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each row, and where each row's begin.

    Words between white space, byte n-grams of ``GRAMS`` lengths with no white space inside (at
    their ends it marks a word's edge), and one end mark for every row, so the empty text has a feature.
    """
    rows = len(texts.at) - 1
    shift = np.uint64(64 - BITS)
    found, owner = [np.full(rows, mix(np.uint64([7]))[0] >> shift)], [np.arange(rows)]
    begin, end, first = blank_words(texts)
    if len(begin):
        found.append(mix(piece_keys(texts.data, begin, end) + np.uint64(1)) >> shift)
        owner.append(np.repeat(np.arange(rows), np.diff(np.append(first[:-1], len(begin)))))
        padded = np.concatenate((texts.data, np.full(8, 0x20, np.uint8)))
        blank = padded <= 0x20
        where = np.repeat(np.arange(rows), np.diff(texts.at))
        head = words_at(padded, slice(0, len(texts.data)))
        for n in GRAMS:
            good = ~(blank[: len(texts.data)] & blank[n - 1 : len(texts.data) + n - 1])
            for k in range(1, n - 1):
                good &= ~blank[k : len(texts.data) + k]
            for k in range(1, n):
                good[np.maximum(texts.at[1:] - k, 0)[texts.at[1:] > 0]] = False
            at = np.flatnonzero(good)
            gram = (head[at] & np.uint64((1 << 8 * n) - 1)) * np.uint64(2) + np.uint64(1)
            found.append(gram * np.uint64(0x9E3779B97F4A7C15 + 2 * n) >> shift)
            owner.append(where[at])
    return np.concatenate(found), np.concatenate(owner)


def train(texts: list[str], labels: np.ndarray, *, dim: int = 16, epochs: int = 6, rate: float = 1.0, seed: int = 3) -> Model:
    """Stochastic gradient descent, one text at a time, over texts in seeded random order, with a falling rate."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    output = np.zeros((2, dim), np.float32)
    bags = []
    for text in texts:
        found, _ = features(Texts(pa.array([text], pa.string())))
        ids, count = np.unique(found.astype(np.int64), return_counts=True)
        bags.append((ids, (count / count.sum()).astype(np.float32)))
    total, done = max(1, epochs * len(texts)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(texts)):
            step = np.float32(rate * (1 - done / total))
            ids, share = bags[i]
            mean = share @ vectors[ids]
            logits = output @ mean
            p = np.exp(logits - logits.max())
            error = p / p.sum()
            error[labels[i]] -= 1
            back = error @ output
            output -= step * np.outer(error, mean)
            vectors[ids] -= step * share[:, None] * len(ids) ** np.float32(0.5) * back
            done += 1
    return Model((vectors @ (output[1] - output[0])).astype(np.float32))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, *, most: int = 4000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on at most ``most`` labelled documents outside the held-out fold: those with the smallest hashed ids.

    The bound is on rows; their whole texts go to the driver, where the model of fixed size is
    trained. Null labels and ids are left out; of several labels for an id the largest holds;
    of several texts for an id each counts. Without labelled rows every score is 0.5.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    chosen = known.groupBy(id_col).agg(F.max(label_col).alias("_label")).orderBy(F.xxhash64(id_col), id_col).limit(most)
    rows = (
        docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
        .join(F.broadcast(chosen), id_col)  # at most ``most`` rows of two numbers
        .orderBy(F.xxhash64(id_col), id_col, "_text")
        .limit(most)
        .collect()
    )
    return train([r["_text"] for r in rows], np.array([int(r["_label"] > 0) for r in rows]))


def score(docs: DataFrame, model: Model, *, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1, higher: good likelier): row by row, over whole texts, without a shuffle.

    Null text scores as empty; repeated rows score alike; an empty table gives an empty result.
    Nothing but the text is an input. A column of the name ``score_col`` is replaced.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.gain)  # 2 ** BITS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value.astype(np.float64)
        for batch in slices(batches, text_col, TEXT_BYTES):
            found, owner = features(Texts(batch.column(text_col)))
            total = np.bincount(owner, gain[found], batch.num_rows)
            value = 1 / (1 + np.exp(-total / np.bincount(owner, minlength=batch.num_rows)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, score_col])

    plain = docs.drop(score_col)
    return plain.mapInArrow(leanly(run), StructType([*plain.schema.fields, StructField(score_col, DoubleType())]))


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
