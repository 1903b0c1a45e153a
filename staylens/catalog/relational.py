"""Scans, projections, filters, nulls, joins and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.functions.vectors import vector_columns
from staylens.operators import aggregates, joins, nulls, projection
from staylens.operators.aggregates import row_counts as count_rows
from staylens.sources.keylists import read_key_list
from staylens.sources.reviews import RATINGS, REVIEWS_CTE, read_review_lines, read_reviews_json, register_reviews, reviews_from_orders
from staylens.sources.tables import read_table
from staylens.workspace import new_dir, stage

WITH_REVIEWS = f"WITH {REVIEWS_CTE}"


def flat(reviews):
    """Nested review fields as plain columns."""
    return reviews.select(
        "id",
        "offering_id",
        "text",
        "date_stayed",
        "ratings.*",
        F.col("author.id").alias("author_id"),
        F.col("author.num_helpful_votes").alias("num_helpful_votes"),
    )


@query("scan_sql", f"{WITH_REVIEWS} SELECT id, text, overall FROM reviews")
def scan_sql(spark, sf_dir):
    name = register_reviews(reviews_from_orders(spark, sf_dir))
    return spark.sql(f"SELECT id, text, ratings.overall FROM {name}")


@query("scan_table", f"{WITH_REVIEWS} SELECT id, offering_id, date_stayed, num_helpful_votes FROM reviews")
def scan_table(spark, sf_dir):
    name = register_reviews(reviews_from_orders(spark, sf_dir, with_text=False))
    return spark.table(name).select("id", "offering_id", "date_stayed", "author.num_helpful_votes")


@query("scan_json", f"{WITH_REVIEWS} SELECT * FROM reviews")
def scan_json(spark, sf_dir):
    path = new_dir(spark, "reviews-json")
    reviews_from_orders(spark, sf_dir).write.json(path)
    return flat(read_reviews_json(spark, path))


def written_lines(spark, sf_dir):
    """Reviews as JSON lines, every fiftieth cut in half, and blank lines between them."""
    line = F.to_json(F.struct("*"))
    cut = F.when(F.col("id") % 50 == 7, F.substring(line, F.lit(1), (F.length(line) / 2).cast("int"))).otherwise(line)
    path = new_dir(spark, "review-lines")
    padded = F.when(F.col("id") % 9 == 0, F.concat(cut, F.lit("\n\n"))).otherwise(cut)
    reviews_from_orders(spark, sf_dir).select(padded.alias("value")).write.text(path)
    return read_review_lines(spark, path)


@query("scan_json_checked", f"{WITH_REVIEWS} SELECT * FROM reviews WHERE id % 50 <> 7")
def scan_json_checked(spark, sf_dir):
    """The lines that are reviews, unchanged."""
    return flat(written_lines(spark, sf_dir)[0])


@query("scan_json_broken", f"{WITH_REVIEWS} SELECT CAST(id AS VARCHAR) AS id FROM reviews WHERE id % 50 = 7")
def scan_json_broken(spark, sf_dir):
    """The lines that are none, by the id they still show."""
    return written_lines(spark, sf_dir)[1].select(F.regexp_extract("line", r'^\{"id":(\d+),', 1).alias("id"))


@query(
    "load_keys",
    "SELECT c_name || ' ' || c_mktsegment AS row_key FROM customer WHERE c_acctbal >= 0",
)
def load_keys(spark, sf_dir):
    """Keys of all customers as padded text lines, blank for those in debt, read back."""
    name = F.concat_ws(" ", "c_name", "c_mktsegment")
    line = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" \t"), name, F.lit("  "))).otherwise("   ")
    path = new_dir(spark, "keys")
    read_table(spark, sf_dir, "customer").select(line).write.text(path)
    return read_key_list(spark, path)


@query("struct_expand", f"{WITH_REVIEWS} SELECT offering_id, {', '.join(RATINGS)} FROM reviews")
def struct_expand(spark, sf_dir):
    return projection.expand_struct(reviews_from_orders(spark, sf_dir, with_text=False), ["offering_id"], "ratings")


@query(
    "rating_projection",
    f"""{WITH_REVIEWS}
    SELECT id AS review_id, author_id, {", ".join(f"{r} AS {r}_rating" for r in RATINGS)} FROM reviews""",
)
def rating_projection(spark, sf_dir):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    author = F.col("author.id").alias("author_id")
    return reviews.select(F.col("id").alias("review_id"), author, *projection.rating_columns(reviews, RATINGS))


@query(
    "filter_not_null",
    f"""{WITH_REVIEWS} SELECT id, rooms, author_id FROM reviews
    WHERE rooms IS NOT NULL AND author_id IS NOT NULL""",
)
def filter_not_null(spark, sf_dir):
    kept = projection.not_null(reviews_from_orders(spark, sf_dir, with_text=False), ["ratings.rooms", "author.id"])
    return kept.select("id", "ratings.rooms", F.col("author.id").alias("author_id"))


# First word of the stay date and its place in the year, as SQL.
MONTH_SQL = """CAST(list_position(['January', 'February', 'March', 'April', 'May', 'June', 'July', 'August',
  'September', 'October', 'November', 'December'], split_part(date_stayed, ' ', 1)) AS INT)"""


def dated_sql(table):
    return f"""
  SELECT * FROM (
    SELECT *, nullif({MONTH_SQL}, 0) AS month,
           TRY_CAST(regexp_extract(date_stayed, '([0-9]{{4}})', 1) AS INT) AS year
    FROM {table}
  ) WHERE month IS NOT NULL AND year IS NOT NULL"""


DATED_CTE = f"{REVIEWS_CTE}, dated AS ({dated_sql('reviews')})"


@query("date_features", f"WITH {DATED_CTE} SELECT id, month, year FROM dated")
def date_features(spark, sf_dir):
    dated = projection.with_stay_date(reviews_from_orders(spark, sf_dir, with_text=False))
    return dated.select("id", "month", "year")


@query(
    "drop_incomplete",
    f"""WITH {DATED_CTE} SELECT id, {", ".join(RATINGS)}, month, year FROM dated
    WHERE {" AND ".join(f"{r} IS NOT NULL" for r in RATINGS)}""",
)
def drop_incomplete(spark, sf_dir):
    dated = projection.with_stay_date(reviews_from_orders(spark, sf_dir, with_text=False))
    return nulls.drop_incomplete(dated.select("id", "ratings.*", "month", "year"), [*RATINGS, "month", "year"])


@query(
    "assemble_skip",
    f"""{WITH_REVIEWS} SELECT id, {", ".join(RATINGS)} FROM reviews
    WHERE {" AND ".join(f"{r} IS NOT NULL" for r in RATINGS)}""",
)
def assemble_skip(spark, sf_dir):
    ratings = projection.expand_struct(reviews_from_orders(spark, sf_dir, with_text=False), ["id"], "ratings")
    assembled = nulls.assemble(ratings, RATINGS, "features", skip_invalid=True)
    return assembled.select("id", *vector_columns("features", RATINGS))


@query(
    "mean_impute",
    f"""{WITH_REVIEWS},
    users AS (
      SELECT author_id AS user_id, CAST(count(*) AS BIGINT) AS review_count,
             avg(length(text)) AS avg_text_length, avg(num_helpful_votes) AS avg_helpful_votes
      FROM reviews WHERE author_id IS NOT NULL GROUP BY author_id
    )
    SELECT user_id, review_count,
           round(coalesce(avg_text_length, avg(avg_text_length) OVER (), 0), 6) AS avg_text_length,
           round(coalesce(avg_helpful_votes, avg(avg_helpful_votes) OVER (), 0), 6) AS avg_helpful_votes
    FROM users""",
)
def mean_impute(spark, sf_dir):
    columns = ["avg_text_length", "avg_helpful_votes"]
    users = stage(aggregates.user_features(reviews_from_orders(spark, sf_dir)), "users")
    filled = nulls.impute_means(users, columns)
    return filled.withColumns({c: F.round(c, 6) for c in columns})


@query(
    "left_join_features",
    """SELECT d.doc_id, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def left_join_features(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return joins.left_join_features(documents, read_table(spark, sf_dir, "labels"), "doc_id")


@query(
    "feature_fold",
    """SELECT c.c_custkey AS user_id, c.c_acctbal,
           o.n_orders, round(o.avg_price, 6) AS avg_price, CAST(e.n_events AS BIGINT) AS n_events
    FROM customer c
    LEFT JOIN (SELECT o_custkey, CAST(count(*) AS BIGINT) AS n_orders, avg(o_totalprice) AS avg_price
               FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
    LEFT JOIN (SELECT user_id, count(*) AS n_events FROM events GROUP BY 1) e ON e.user_id = c.c_custkey""",
)
def feature_fold(spark, sf_dir):
    base = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_acctbal")
    orders = (
        read_table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.count("*").alias("n_orders"), F.avg("o_totalprice").alias("avg_price"))
    )
    events = read_table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n_events"))
    folded = joins.fold_features(base, [orders, None, events], "user_id")
    return folded.withColumn("avg_price", F.round("avg_price", 6))


@query(
    "union_all",
    """SELECT doc_id AS id, 'document' AS kind, text FROM documents
    UNION ALL SELECT conv_id AS id, 'turn' AS kind, text FROM conversations
    UNION ALL SELECT doc_id AS id, 'document' AS kind, text FROM documents""",
)
def union_all(spark, sf_dir):
    documents = read_table(spark, sf_dir, "documents")
    documents = documents.select(F.col("doc_id").alias("id"), F.lit("document").alias("kind"), "text")
    turns = read_table(spark, sf_dir, "conversations")
    turns = turns.select("text", F.lit("turn").alias("kind"), F.col("conv_id").alias("id"))
    return projection.union_all(documents, turns, documents)


@query(
    "row_counts",
    f"""{WITH_REVIEWS} SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(text) AS BIGINT) AS n_text,
    CAST(count(rooms) AS BIGINT) AS n_ratings_rooms, CAST(count(author_id) AS BIGINT) AS n_author_id FROM reviews""",
)
def row_counts(spark, sf_dir):
    return count_rows(reviews_from_orders(spark, sf_dir), ["text", "ratings.rooms", "author.id"])
