"""Entity, author and review statistics, quantiles, labels, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens.catalog.base import query
from staylens.catalog.relational import WITH_REVIEWS
from staylens.functions.ratings import sentiment_label as label_sentiment
from staylens.functions.text import word_count as count_words
from staylens.operators import aggregates, features, quantiles, ranking
from staylens.operators.quantiles import THIRDS
from staylens.operators.sketches import SketchStore
from staylens.sources.reviews import RATINGS, REVIEWS_CTE, reviews_from_orders
from staylens.sources.tables import read_table
from staylens.workspace import new_dir, stage

LINE_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def stats_sql(measures):
    means = [f"round(coalesce(avg({m}), 0), 6) AS avg_{m}" for m in measures]
    spreads = [f"round(coalesce(stddev_pop({m}), 0), 6) AS stddev_{m}" for m in measures]
    return ", ".join(means + spreads)


def rounded(df, key, digits=6):
    return df.select(key, *[F.round(c, digits).alias(c) for c in df.columns if c != key])


@query("entity_stats", f"{WITH_REVIEWS} SELECT offering_id, {stats_sql(RATINGS)} FROM reviews GROUP BY offering_id")
def entity_stats(spark, sf_dir):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False).select("offering_id", "ratings.*")
    return rounded(aggregates.entity_stats(reviews, "offering_id", RATINGS), "offering_id")


@query("entity_stats_lines", f"SELECT l_suppkey, {stats_sql(LINE_MEASURES)} FROM lineitem GROUP BY l_suppkey")
def entity_stats_lines(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem")
    return rounded(aggregates.entity_stats(lines, "l_suppkey", LINE_MEASURES), "l_suppkey")


@query(
    "user_features",
    f"""{WITH_REVIEWS} SELECT author_id AS user_id, CAST(count(*) AS BIGINT) AS review_count,
           round(avg(length(text)), 6) AS avg_text_length, round(avg(num_helpful_votes), 6) AS avg_helpful_votes
    FROM reviews WHERE author_id IS NOT NULL GROUP BY author_id""",
)
def user_features(spark, sf_dir):
    users = aggregates.user_features(reviews_from_orders(spark, sf_dir))
    return users.withColumns({c: F.round(c, 6) for c in ("avg_text_length", "avg_helpful_votes")})


@query(
    "review_features",
    f"""{WITH_REVIEWS} SELECT id AS review_id, CAST(length(text) AS INT) AS text_length,
           CAST(len(regexp_split_to_array(text, '[\\t\\n\\v\\f\\r ]+')) AS INT) AS word_count
    FROM reviews WHERE text IS NOT NULL""",
)
def review_features(spark, sf_dir):
    return aggregates.review_features(reviews_from_orders(spark, sf_dir))


@query(
    "word_count",
    """SELECT doc_id, CAST(len(regexp_split_to_array(text, '[\\t\\n\\v\\f\\r ]+')) AS INT) AS word_count
    FROM documents""",
)
def word_count(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", count_words(F.col("text")).alias("word_count"))


@query(
    "word_count_compat",
    """SELECT doc_id, CAST(len(regexp_split_to_array(text, '\\\\s+')) AS INT) AS word_count FROM documents""",
)
def word_count_compat(spark, sf_dir):
    words = count_words(F.col("text"), compat=True)
    return read_table(spark, sf_dir, "documents").select("doc_id", words.alias("word_count"))


@query(
    "quantiles",
    f"""{WITH_REVIEWS}
    SELECT quantile_disc(rooms, {THIRDS[0]}) AS rooms_low, quantile_disc(rooms, {THIRDS[1]}) AS rooms_high,
           quantile_disc(sleep_quality, {THIRDS[0]}) AS sleep_low, quantile_disc(sleep_quality, {THIRDS[1]}) AS sleep_high
    FROM reviews""",
)
def rating_quantiles(spark, sf_dir):
    ratings = reviews_from_orders(spark, sf_dir, with_text=False).select("ratings.*")
    ratings = stage(ratings.select("rooms", "sleep_quality"), "ratings")
    rooms = quantiles.quantile_struct(ratings, "rooms", THIRDS, accuracy=None).scalar()
    sleep = quantiles.quantile_struct(ratings, "sleep_quality", THIRDS, accuracy=None)
    return sleep.select(
        rooms["q0"].alias("rooms_low"),
        rooms["q1"].alias("rooms_high"),
        F.col("q.q0").alias("sleep_low"),
        F.col("q.q1").alias("sleep_high"),
    )


QUARTILES = (0.25, 0.5, 0.75, 0.99)


@query(
    "exact_quantiles",
    " UNION ALL ".join(
        f"SELECT CAST({p} AS DOUBLE) AS p, quantile_disc(l_extendedprice, {p}) AS value FROM lineitem" for p in QUARTILES
    ),
)
def exact_quantiles(spark, sf_dir):
    return ranking.exact_quantiles(read_table(spark, sf_dir, "lineitem"), "l_extendedprice", QUARTILES)


@query(
    "exact_quantiles_by_day",
    " UNION ALL ".join(
        f"SELECT o_orderpriority, CAST({p} AS DOUBLE) AS p, quantile_disc(o_orderdate, {p}) AS value FROM orders GROUP BY o_orderpriority"
        for p in (0.1, 0.5, 0.9)
    ),
)
def exact_quantiles_by_day(spark, sf_dir):
    """Quantiles of a timestamp per group, in its own type."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderdate")
    return ranking.exact_quantiles(orders, "o_orderdate", (0.1, 0.5, 0.9), ["o_orderpriority"])


BIG = 2**53


@query(
    "ranks_of_large_integers",
    f"""SELECT o_orderkey, o_orderstatus, CAST(rank() OVER (PARTITION BY nullif(o_orderstatus, 'P') ORDER BY {BIG} + o_custkey DESC) AS BIGINT) AS rank,
           CAST(rank() OVER (PARTITION BY nullif(o_orderstatus, 'P') ORDER BY CAST(o_totalprice AS DECIMAL(18, 2))) AS BIGINT) AS price_rank,
           CAST(rank() OVER (PARTITION BY nullif(o_orderstatus, 'P') ORDER BY o_orderdate) AS BIGINT) AS day_rank FROM orders""",
)
def ranks_of_large_integers(spark, sf_dir):
    """Ranks of integers that doubles cannot tell apart, of decimals and of timestamps; one group is null."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        (F.lit(BIG) + F.col("o_custkey")).alias("big"),
        F.col("o_totalprice").cast("decimal(18, 2)").alias("price"),
        "o_orderdate",
    )
    ranks = ranking.ranked(orders, ["status"], "big")
    ranks = ranking.ranked(ranks.withColumnRenamed("rank", "big_rank"), ["status"], "price", descending=False)
    ranks = ranking.ranked(ranks.withColumnRenamed("rank", "price_rank"), ["status"], "o_orderdate", descending=False)
    return ranks.select("o_orderkey", "o_orderstatus", F.col("big_rank").alias("rank"), "price_rank", F.col("rank").alias("day_rank"))


@query(
    "sketch_quantiles",
    f"{WITH_REVIEWS}, rated AS (SELECT CASE WHEN overall >= 4 THEN 'good' ELSE 'other' END AS kind, rooms FROM reviews) "
    + " UNION ALL ".join(
        f"SELECT kind, CAST({p} AS DOUBLE) AS p, quantile_disc(rooms, {p}) AS value FROM rated GROUP BY kind" for p in THIRDS
    ),
)
def sketch_quantiles(spark, sf_dir):
    """Thirds per kind of review, from a store of sketches per weekday of which one day is written twice.

    A rating has few values, each with far more than the sketch's rank error of rows, so the thirds are exact.
    """
    kind = F.when(F.col("ratings.overall") >= 4, "good").otherwise("other")
    reviews = reviews_from_orders(spark, sf_dir, with_text=False).select("id", kind.alias("kind"), "ratings.rooms")
    store = SketchStore(spark, new_dir(spark, "sketches"), T.StructType([T.StructField("kind", T.StringType())]))
    for day in (0, 1, 2, 3, 1):
        store.put(str(day), reviews.where(F.col("id") % 4 == day), "rooms")
    return store.quantiles(THIRDS)


LABELLED_CTE = f"""{REVIEWS_CTE},
cuts AS (SELECT quantile_disc(rooms, {THIRDS[0]}) AS low, quantile_disc(rooms, {THIRDS[1]}) AS high FROM reviews),
labelled AS (
  SELECT reviews.*, CASE WHEN rooms <= low THEN 'Low' WHEN rooms <= high THEN 'Medium' ELSE 'High' END AS rooms_label
  FROM reviews, cuts WHERE rooms IS NOT NULL
)"""


def labelled_rooms(spark, sf_dir):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False).where(F.col("ratings.rooms").isNotNull())
    rooms = reviews.select("id", "date_stayed", "ratings.*")
    return quantiles.with_quantile_label(rooms, "rooms", "rooms_label", accuracy=None)


@query("quantile_labels", f"WITH {LABELLED_CTE} SELECT id, rooms, rooms_label FROM labelled")
def quantile_labels(spark, sf_dir):
    return labelled_rooms(spark, sf_dir).select("id", "rooms", "rooms_label")


@query(
    "class_distribution",
    f"WITH {LABELLED_CTE} SELECT rooms_label, CAST(count(*) AS BIGINT) AS n FROM labelled GROUP BY rooms_label",
)
def class_distribution(spark, sf_dir):
    return aggregates.class_distribution(labelled_rooms(spark, sf_dir), "rooms_label")


@query(
    "sentiment_label",
    f"""{WITH_REVIEWS} SELECT id, CAST(CASE WHEN rooms >= 4.0 THEN 1 WHEN rooms IS NOT NULL THEN 0 END AS DOUBLE) AS label,
    CAST(CASE WHEN rooms >= 4.0 THEN 1 ELSE 0 END AS DOUBLE) AS label_null_is_negative FROM reviews""",
)
def sentiment_label(spark, sf_dir):
    """Over the rooms rating, as it has nulls and the overall rating has none here."""
    rooms = F.col("ratings.rooms")
    return reviews_from_orders(spark, sf_dir, with_text=False).select(
        "id",
        label_sentiment(rooms).alias("label"),
        label_sentiment(rooms, null_is_negative=True).alias("label_null_is_negative"),
    )


def scaled_sql(c):
    return f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS {c}"


@query(
    "standard_scale",
    f"SELECT l_orderkey, l_linenumber, {', '.join(scaled_sql(c) for c in LINE_MEASURES)} FROM lineitem",
)
def standard_scale(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *LINE_MEASURES)
    scaled = features.standard_scale(lines, LINE_MEASURES)
    return scaled.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in LINE_MEASURES})


@query(
    "string_index",
    """SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS label,
           CAST(count(*) AS BIGINT) AS n
    FROM orders GROUP BY o_orderpriority""",
)
def string_index(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    index = features.fit_label_index(orders, "o_orderpriority")
    indexed = index.transform(orders.select("o_orderpriority"))
    return indexed.groupBy("o_orderpriority", "label").agg(F.count("*").alias("n"))
