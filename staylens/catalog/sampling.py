"""Splits, samples and class balancing.

Those with an oracle use the arithmetic bucket, so that SQL can repeat the choice.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.catalog.statistics import LABELLED_CTE, labelled_rooms
from staylens.functions.keys import arithmetic_bucket, arithmetic_bucket_sql
from staylens.operators import sampling
from staylens.sources.tables import read_table
from staylens.workspace import stage


@query(
    "hash_split",
    f"""SELECT o_orderkey, CASE WHEN {arithmetic_bucket_sql("o_orderkey", 100)} < 80
    THEN 'train' ELSE 'test' END AS split FROM orders""",
)
def hash_split(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    return sampling.with_split(orders, "o_orderkey", 80, arithmetic_bucket)


@query(
    "random_split",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_in_both, true AS near_share FROM orders",
)
def random_split(spark, sf_dir):
    """What holds for any layout: both parts together are the table, no row is in both."""
    train, test = sampling.random_split(read_table(spark, sf_dir, "orders").select("o_orderkey"))
    parts = train.withColumn("train", F.lit(1)).unionByName(test.withColumn("train", F.lit(0)))
    per_row = parts.groupBy("o_orderkey").agg(F.sum("train").alias("train"), F.count("*").alias("n"))
    return per_row.agg(
        F.sum("n").alias("n_rows"),
        F.count_if((F.col("train") > 0) & (F.col("train") < F.col("n"))).alias("n_in_both"),
        (F.abs(F.sum("train") / F.sum("n") - 0.8) < 0.05).alias("near_share"),
    )


@query(
    "sample_with_replacement",
    """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_foreign, true AS has_repeats, true AS near_size
    FROM orders""",
)
def sample_with_replacement(spark, sf_dir):
    """What holds for any layout: rows of the table only, some repeated, about as many."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey")
    sampled = sampling.sample_with_replacement(orders, 1.0)
    drawn = sampled.groupBy("o_orderkey").agg(F.count("*").alias("drawn"))
    compared = orders.withColumn("known", F.lit(1)).join(drawn, "o_orderkey", "full")
    rows, size = F.sum("known"), F.sum("drawn")
    return compared.agg(
        rows.alias("n_rows"),
        F.count_if(F.col("known").isNull()).alias("n_foreign"),
        (F.max("drawn") > 1).alias("has_repeats"),
        (F.abs(size / rows - 1) < 0.1).alias("near_size"),
    )


def draw_sql(rates: str, rows: str, key: str, columns: str) -> str:
    """Poisson copies per row: ``rates`` gives a rate per row class, ``rows`` joins it."""
    return f"""
cdf AS (
  SELECT rates.*, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY rate_class ORDER BY k) AS cdf
  FROM ({rates}) rates, (SELECT range AS k FROM range(81)) steps
),
copies AS (
  SELECT {columns}, CAST(count(*) AS INT) AS copies
  FROM ({rows}) d JOIN cdf ON cdf.rate_class = d.rate_class
   AND cdf.cdf <= {arithmetic_bucket_sql(key, 1_000_000)} / CAST(1000000 AS DOUBLE)
  GROUP BY ALL
)
SELECT {columns}, unnest(range(CAST(1 AS INT), copies + 1))::INT AS copy FROM copies"""


@query(
    "bootstrap_sample",
    "WITH "
    + draw_sql(
        "SELECT 1 AS rate_class, CAST(1 AS DOUBLE) AS rate",
        "SELECT o_orderkey, o_orderpriority, 1 AS rate_class FROM orders",
        "o_orderkey",
        "o_orderkey, o_orderpriority",
    ),
)
def bootstrap_sample(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return sampling.bootstrap_sample(orders, 1.0, "o_orderkey", arithmetic_bucket)


@query(
    "oversample_poisson",
    f"WITH {LABELLED_CTE},"
    + draw_sql(
        """SELECT rooms_label AS rate_class, max(count(*)) OVER () / CAST(count(*) AS DOUBLE) AS rate
        FROM labelled GROUP BY rooms_label""",
        "SELECT id, rooms_label, rooms_label AS rate_class FROM labelled",
        "id",
        "id, rooms_label",
    ),
)
def oversample_poisson(spark, sf_dir):
    rooms = staged_rooms(spark, sf_dir)
    return sampling.oversample_poisson(rooms, "rooms_label", "id", arithmetic_bucket)


def staged_rooms(spark, sf_dir):
    """Labelled reviews, staged because balancing reads them more than once."""
    return stage(labelled_rooms(spark, sf_dir).select("id", "rooms_label"), "labelled-rooms")


COPIES = "SELECT id, rooms_label, unnest(range(CAST(1 AS INT), CAST(copies AS INT) + 1))::INT AS copy FROM copies"


@query(
    "oversample",
    f"""WITH {LABELLED_CTE},
    placed AS (
      SELECT id, rooms_label, count(*) OVER (PARTITION BY rooms_label) AS n,
             row_number() OVER (PARTITION BY rooms_label ORDER BY {arithmetic_bucket_sql("id", 65536)}, id) AS place
      FROM labelled
    ),
    copies AS (
      SELECT id, rooms_label, target // n + CASE WHEN place <= target % n THEN 1 ELSE 0 END AS copies
      FROM placed, (SELECT max(n) AS target FROM placed)
    )
    {COPIES}""",
)
def oversample(spark, sf_dir):
    rooms = staged_rooms(spark, sf_dir)
    return sampling.oversample(rooms, "rooms_label", "id", arithmetic_bucket)


@query(
    "oversample_near",
    f"""WITH {LABELLED_CTE},
    sized AS (SELECT id, rooms_label, count(*) OVER (PARTITION BY rooms_label) AS n FROM labelled),
    copies AS (
      SELECT id, rooms_label, target // n + CASE WHEN {arithmetic_bucket_sql("id", 1_000_000)}
             < (target % n) / CAST(n AS DOUBLE) * 1000000 THEN 1 ELSE 0 END AS copies
      FROM sized, (SELECT max(n) AS target FROM sized)
    )
    {COPIES}""",
)
def oversample_near(spark, sf_dir):
    rooms = staged_rooms(spark, sf_dir)
    return sampling.oversample_near(rooms, "rooms_label", "id", arithmetic_bucket)
