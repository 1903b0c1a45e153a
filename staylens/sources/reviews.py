"""The ``reviews`` table: schema, readers, and a view over order data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.functions.text import BLANKS
from staylens.sources.tables import read_table

# The rating names of a review, in table order.
RATINGS = ["service", "cleanliness", "overall", "value", "location", "sleep_quality", "rooms"]

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("offering_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("date_stayed", T.StringType()),
        T.StructField("ratings", T.StructType([T.StructField(r, T.DoubleType()) for r in RATINGS])),
        T.StructField(
            "author",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("num_helpful_votes", T.LongType()),
                ]
            ),
        ),
    ]
)


def read_reviews_json(spark: SparkSession, path: str) -> DataFrame:
    """Reviews as JSON lines. The schema is given, so no inference pass runs."""
    return spark.read.schema(REVIEW_SCHEMA).json(path)


# Holds a line that is no review while it is told apart from the others.
_BROKEN = "_broken_line"


def read_review_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Reviews as JSON lines, and the lines that are none: (reviews, broken).

    A line is broken if it is no JSON object, or if a field does not have its type; its parseable
    fields are not used. Broken lines come with the ``file`` they are in, whole, as ``line``.
    Blank lines are neither. Both frames scan the files; no line is lost between them.
    """
    schema = T.StructType([*REVIEW_SCHEMA.fields, T.StructField(_BROKEN, T.StringType())])
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": _BROKEN})
    # As text lines, because the JSON reader does not give out broken lines alone.
    lines = spark.read.text(path).where(F.trim("value", F.lit(BLANKS)) != "")
    read = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"), parsed.alias("review"))
    is_review = F.col("review").isNotNull() & F.col(f"review.{_BROKEN}").isNull()
    return read.where(is_review).select("review.*").drop(_BROKEN), read.where(~is_review).select("file", "line")


def line_counts(broken: DataFrame) -> DataFrame:
    """Broken lines per file."""
    return broken.groupBy("file").agg(F.count("*").alias("n_broken"))


def read_reviews_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(REVIEW_SCHEMA).parquet(path)


def register_reviews(df: DataFrame, name: str = "reviews") -> str:
    """Publish a review frame to the session catalog for SQL and table scans."""
    df.createOrReplaceTempView(name)
    return name


def reviews_from_orders(spark: SparkSession, directory: str, with_text: bool = True) -> DataFrame:
    """One review per order; ``with_text`` adds the document of the same id.

    Pass ``with_text=False`` when no text is read: the join, and with it the only
    shuffle, is then left out of the plan.
    """
    orders = read_table(spark, directory, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    order_id, customer = F.col("o_orderkey"), F.col("o_custkey")
    priority, status, day = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("o_orderdate")
    rating = {
        "service": cents % 5 + 1,
        "cleanliness": (cents * 3 + order_id) % 5 + 1,
        "overall": 6 - F.substring(priority, 1, 1).cast("int"),
        "value": (cents + customer) % 5 + 1,
        "location": (customer * 3 + order_id) % 5 + 1,
        "sleep_quality": F.when(priority != "3-MEDIUM", (cents * 2 + customer) % 5 + 1),
        "rooms": F.when(priority != "4-NOT SPECIFIED", (cents * 7 + order_id) % 5 + 1),
    }
    text = F.lit(None).cast("string")
    if with_text:
        documents = read_table(spark, directory, "documents").select("doc_id", "text")
        orders = orders.join(documents, F.col("o_orderkey") == F.col("doc_id"), "left")
        text = F.col("text")
    return orders.select(
        order_id.alias("id"),
        F.expr("o_custkey div 10").alias("offering_id"),
        text.alias("text"),
        F.when(priority == "5-LOW", F.date_format(day, "MMM yyyy"))
        .otherwise(F.date_format(day, "MMMM yyyy"))
        .alias("date_stayed"),
        F.struct(*[rating[r].cast("double").alias(r) for r in RATINGS]).alias("ratings"),
        F.struct(
            F.when(status != "P", customer).cast("string").alias("id"),
            F.when(status != "F", cents % 23).alias("num_helpful_votes"),
        ).alias("author"),
    )


# The same view for the SQL oracle, flat: nested fields become plain columns.
REVIEWS_CTE = """
orders_in_cents AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders
),
reviews AS (
  SELECT o_orderkey AS id,
         o_custkey // 10 AS offering_id,
         d.text AS text,
         CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%b %Y')
              ELSE strftime(o_orderdate, '%B %Y') END AS date_stayed,
         CAST(cents % 5 + 1 AS DOUBLE) AS service,
         CAST((cents * 3 + o_orderkey) % 5 + 1 AS DOUBLE) AS cleanliness,
         CAST(6 - CAST(substr(o_orderpriority, 1, 1) AS INT) AS DOUBLE) AS overall,
         CAST((cents + o_custkey) % 5 + 1 AS DOUBLE) AS value,
         CAST((o_custkey * 3 + o_orderkey) % 5 + 1 AS DOUBLE) AS location,
         CAST(CASE WHEN o_orderpriority <> '3-MEDIUM'
              THEN (cents * 2 + o_custkey) % 5 + 1 END AS DOUBLE) AS sleep_quality,
         CAST(CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
              THEN (cents * 7 + o_orderkey) % 5 + 1 END AS DOUBLE) AS rooms,
         CAST(CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS VARCHAR) AS author_id,
         CASE WHEN o_orderstatus <> 'F' THEN cents % 23 END AS num_helpful_votes
  FROM orders_in_cents LEFT JOIN documents d ON d.doc_id = o_orderkey
)
"""
