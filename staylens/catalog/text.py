"""Tokens, stop words, term counts and TF-IDF over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.functions import text as tx
from staylens.functions.stopwords import ENGLISH_STOP_WORDS
from staylens.operators import text_features
from staylens.operators.text_features import TERM_BUCKETS
from staylens.sources.tables import read_table

BLANK = "[\\t\\n\\v\\f\\r ]"
STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS)

TOKENS_CTE = f"""
lowered AS (SELECT doc_id, lower(coalesce(text, '')) AS lowered FROM documents),
bodies AS (SELECT doc_id, lowered, regexp_replace(lowered, '{BLANK}+$', '') AS body FROM lowered),
tokenized AS (
  SELECT doc_id, CASE WHEN body = '' AND lowered <> '' THEN []
                      ELSE regexp_split_to_array(body, '{BLANK}') END AS words
  FROM bodies
),
filtered AS (
  SELECT doc_id, list_filter(words, lambda w: w NOT IN ({STOP_SQL})) AS words FROM tokenized
),
terms AS (SELECT doc_id, unnest(words) AS term FROM filtered),
counts AS (SELECT doc_id, term, CAST(count(*) AS BIGINT) AS tf FROM terms GROUP BY doc_id, term)"""


def documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def filtered_words():
    return tx.without_stop_words(tx.tokens(F.col("text")))


def words_row(words):
    return [F.size(words).cast("long").alias("n_words"), F.array_join(words, "|").alias("words")]


@query(
    "tokenize",
    f"WITH {TOKENS_CTE} SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, '|') AS words FROM tokenized",
)
def tokenize(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", *words_row(tx.tokens(F.col("text"))))


@query(
    "stopwords",
    f"WITH {TOKENS_CTE} SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, array_to_string(words, '|') AS words FROM filtered",
)
def stopwords(spark, sf_dir):
    kept = documents(spark, sf_dir).select("doc_id", filtered_words().alias("kept"))
    return kept.select("doc_id", *words_row(F.col("kept")))


@query("term_counts", f"WITH {TOKENS_CTE} SELECT doc_id, term, tf FROM counts")
def term_counts(spark, sf_dir):
    return text_features.term_counts(documents(spark, sf_dir), "doc_id", filtered_words())


WEIGHT_SQL = """
SELECT doc_id, {term}, tf, round(ln((m + 1) / CAST(df + 1 AS DOUBLE)), 6) AS idf,
       round(tf * ln((m + 1) / CAST(df + 1 AS DOUBLE)), 6) + 0.0 AS tfidf
FROM {counts} JOIN (SELECT {term}, count(*) AS df FROM {counts} GROUP BY {term}) USING ({term}),
     (SELECT count(*) AS m FROM documents)"""


def rounded_weights(weights):
    return weights.withColumns({"idf": F.round("idf", 6), "tfidf": F.round("tfidf", 6) + F.lit(0.0)})


@query("tfidf", f"WITH {TOKENS_CTE} {WEIGHT_SQL.format(term='term', counts='counts')}")
def tfidf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    counts = text_features.term_counts(docs, "doc_id", filtered_words())
    return rounded_weights(text_features.tfidf(counts, docs, "doc_id", "term"))


# MurmurHash3 (32 bit, seed 42) of each distinct term in SQL: whole words of four bytes,
# then each byte left over as a signed number; all arithmetic modulo 2^32.
HASHED_CTE = f"""{TOKENS_CTE},
vocabulary AS (
  SELECT term, hex(encode(term)) AS h, CAST(octet_length(encode(term)) AS BIGINT) AS n
  FROM (SELECT DISTINCT term FROM counts)
),
bytes AS (
  SELECT term, n, list_transform(range(n), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS UBIGINT)) AS b FROM vocabulary
),
blocks AS (
  SELECT term, n, list_concat(
    list_transform(range(n // 4), lambda i: b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216),
    list_transform(range(n // 4 * 4, n), lambda i: CASE WHEN b[i + 1] >= 128 THEN b[i + 1] + 4294967040 ELSE b[i + 1] END)
  ) AS k FROM bytes
),
k1 AS (SELECT term, n, list_transform(k, lambda x: CAST(x AS UBIGINT) * 3432918353 % 4294967296) AS k FROM blocks),
k2 AS (SELECT term, n, list_transform(k, lambda x: ((x << 15) % 4294967296 + (x >> 17)) * 461845907 % 4294967296) AS k FROM k1),
mixed AS (
  SELECT term, n, list_reduce(k, lambda h, x: (((xor(h, x) << 13) % 4294967296 + (xor(h, x) >> 19)) * 5 + 3864292196) % 4294967296,
                              CAST(42 AS UBIGINT)) AS h FROM k2
),
f1 AS (SELECT term, xor(h, CAST(n AS UBIGINT)) AS h FROM mixed),
f2 AS (SELECT term, xor(h, h >> 16) * 2246822507 % 4294967296 AS h FROM f1),
f3 AS (SELECT term, xor(h, h >> 13) * 3266489909 % 4294967296 AS h FROM f2),
f4 AS (SELECT term, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM f3),
signed AS (SELECT term, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS h FROM f4),
buckets AS (SELECT term, CAST((h % {TERM_BUCKETS} + {TERM_BUCKETS}) % {TERM_BUCKETS} AS INT) AS bucket FROM signed),
hashed AS (SELECT doc_id, bucket, CAST(sum(tf) AS BIGINT) AS tf FROM counts JOIN buckets USING (term) GROUP BY doc_id, bucket)"""


@query("hashing_tf", f"WITH {HASHED_CTE} SELECT doc_id, bucket, tf FROM hashed")
def hashing_tf(spark, sf_dir):
    return text_features.hashed_term_counts(documents(spark, sf_dir), "doc_id", filtered_words())


@query("hashing_tfidf", f"WITH {HASHED_CTE} {WEIGHT_SQL.format(term='bucket', counts='hashed')}")
def hashing_tfidf(spark, sf_dir):
    docs = documents(spark, sf_dir)
    counts = text_features.hashed_term_counts(docs, "doc_id", filtered_words())
    return rounded_weights(text_features.tfidf(counts, docs, "doc_id", "bucket", TERM_BUCKETS))


# The standard hash, as the running Spark's HashingTF takes it: up to three bytes left over are one number
# that is mixed in without the closing rotation.
CURRENT_CTE = f"""{TOKENS_CTE},
vocabulary AS (
  SELECT term, hex(encode(term)) AS h, CAST(octet_length(encode(term)) AS BIGINT) AS n
  FROM (SELECT DISTINCT term FROM counts)
),
bytes AS (
  SELECT term, n, list_transform(range(n), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS UBIGINT)) AS b FROM vocabulary
),
blocks AS (
  SELECT term, n, list_transform(range(n // 4),
      lambda i: b[4 * i + 1] + b[4 * i + 2] * 256 + b[4 * i + 3] * 65536 + b[4 * i + 4] * 16777216) AS k,
    coalesce(b[n // 4 * 4 + 1], 0) + coalesce(b[n // 4 * 4 + 2], 0) * 256 + coalesce(b[n // 4 * 4 + 3], 0) * 65536 AS t
  FROM bytes
),
k1 AS (
  SELECT term, n, list_transform(k, lambda x: CAST(x AS UBIGINT) * 3432918353 % 4294967296) AS k,
         CAST(t AS UBIGINT) * 3432918353 % 4294967296 AS t FROM blocks
),
k2 AS (
  SELECT term, n, list_transform(k, lambda x: ((x << 15) % 4294967296 + (x >> 17)) * 461845907 % 4294967296) AS k,
         ((t << 15) % 4294967296 + (t >> 17)) * 461845907 % 4294967296 AS t FROM k1
),
mixed AS (
  SELECT term, n, xor(list_reduce(k, lambda h, x: (((xor(h, x) << 13) % 4294967296 + (xor(h, x) >> 19)) * 5 + 3864292196) % 4294967296,
                                  CAST(42 AS UBIGINT)), t) AS h FROM k2
),
f1 AS (SELECT term, xor(h, CAST(n AS UBIGINT)) AS h FROM mixed),
f2 AS (SELECT term, xor(h, h >> 16) * 2246822507 % 4294967296 AS h FROM f1),
f3 AS (SELECT term, xor(h, h >> 13) * 3266489909 % 4294967296 AS h FROM f2),
f4 AS (SELECT term, CAST(xor(h, h >> 16) AS BIGINT) AS h FROM f3),
signed AS (SELECT term, CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS h FROM f4),
buckets AS (SELECT term, CAST((h % {TERM_BUCKETS} + {TERM_BUCKETS}) % {TERM_BUCKETS} AS INT) AS bucket FROM signed),
hashed AS (SELECT doc_id, bucket, CAST(sum(tf) AS BIGINT) AS tf FROM counts JOIN buckets USING (term) GROUP BY doc_id, bucket)"""


@query("hashing_tf_current", f"WITH {CURRENT_CTE} SELECT doc_id, bucket, tf FROM hashed")
def hashing_tf_current(spark, sf_dir):
    """The indices the jobs' HashingTF gives."""
    return text_features.hashed_term_counts(
        documents(spark, sf_dir), "doc_id", filtered_words(), bucket=tx.current_term_bucket
    )


@query("hashing_tfidf_current", f"WITH {CURRENT_CTE} {WEIGHT_SQL.format(term='bucket', counts='hashed')}")
def hashing_tfidf_current(spark, sf_dir):
    docs = documents(spark, sf_dir)
    counts = text_features.hashed_term_counts(docs, "doc_id", filtered_words(), bucket=tx.current_term_bucket)
    return rounded_weights(text_features.tfidf(counts, docs, "doc_id", "bucket", TERM_BUCKETS))
