"""Confusion matrix, F1, AUC, silhouette, distances and anomaly flags.

Labels, predictions, scores and centres come from columns and fixed parameters, so SQL
can compute the same numbers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.catalog.relational import DATED_CTE
from staylens.functions.text import word_count
from staylens.operators import clusters, nulls, projection
from staylens.operators import metrics as m
from staylens.sources.reviews import RATINGS, REVIEWS_CTE, reviews_from_orders
from staylens.sources.tables import read_table


def rating_pairs(spark, sf_dir):
    """The overall rating as label, the rating of the service as its prediction."""
    ratings = reviews_from_orders(spark, sf_dir, with_text=False)
    return ratings.select(F.col("ratings.overall").alias("label"), F.col("ratings.service").alias("prediction"))


CELLS_CTE = f"""{REVIEWS_CTE},
cells AS (SELECT overall AS label, service AS prediction, CAST(count(*) AS BIGINT) AS n FROM reviews GROUP BY 1, 2)"""


@query("confusion_matrix", f"WITH {CELLS_CTE} SELECT label, prediction, n FROM cells")
def confusion_matrix(spark, sf_dir):
    return m.confusion_matrix(rating_pairs(spark, sf_dir))


F1_CTE = f"""{CELLS_CTE},
actual AS (SELECT label AS c, sum(n) AS n FROM cells GROUP BY 1),
predicted AS (SELECT prediction AS c, sum(n) AS n FROM cells GROUP BY 1),
hits AS (SELECT label AS c, n FROM cells WHERE label = prediction),
rated AS (
  SELECT coalesce(a.n, 0) AS n, coalesce(h.n, 0) AS hit,
         coalesce(h.n / CAST(p.n AS DOUBLE), 0) AS p, coalesce(h.n / CAST(a.n AS DOUBLE), 0) AS r
  FROM actual a FULL JOIN predicted p ON p.c = a.c LEFT JOIN hits h ON h.c = coalesce(a.c, p.c)
),
scores AS (
  SELECT sum(hit) / sum(n) AS accuracy, sum(p * n) / sum(n) AS weighted_precision, sum(r * n) / sum(n) AS weighted_recall,
         sum(n * CASE WHEN hit > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(n) AS weighted_f1,
         avg(CASE WHEN hit > 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS macro_f1
  FROM rated
)"""
SCORES = ["accuracy", "weighted_precision", "weighted_recall", "weighted_f1", "macro_f1"]


@query("f1_scores", f"WITH {F1_CTE} SELECT {', '.join(f'round({s}, 6) AS {s}' for s in SCORES)} FROM scores")
def f1_scores(spark, sf_dir):
    return m.f1_scores(rating_pairs(spark, sf_dir)).select(*[F.round(s, 6).alias(s) for s in SCORES])


@query(
    "metrics_json",
    f"""WITH {F1_CTE}
    SELECT '{{"f1_score":' || round(weighted_f1, 4) || ',"macro_f1":' || round(macro_f1, 4) || ',"precision":' || round(weighted_precision, 4)
        || ',"recall":' || round(weighted_recall, 4) || ',"confusion_matrix":[' || (
          SELECT string_agg('{{"label":' || label || ',"prediction":' || prediction || ',"count":' || n || '}}', ','
                            ORDER BY label, prediction) FROM cells
        ) || ']}}' AS metrics FROM scores""",
)
def metrics_json(spark, sf_dir):
    return m.metrics_record(rating_pairs(spark, sf_dir)).select(F.to_json("details").alias("metrics"))


@query(
    "auc",
    """WITH scored AS (SELECT l_extendedprice AS score, l_returnflag = 'R' AS positive FROM lineitem),
    placed AS (
      SELECT positive, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS place FROM scored
    ),
    summed AS (
      SELECT sum(place) FILTER (positive) AS places, count(*) FILTER (positive)::DOUBLE AS p, count(*) FILTER (NOT positive)::DOUBLE AS n
      FROM placed
    )
    SELECT round((places - p * (p + 1) / 2) / (p * n), 6) AS auc FROM summed""",
)
def auc(spark, sf_dir):
    """How well the price of a line separates returned lines from the rest."""
    lines = read_table(spark, sf_dir, "lineitem")
    scored = lines.select(F.col("l_extendedprice").alias("score"), (F.col("l_returnflag") == "R").cast("double").alias("label"))
    return m.auc(scored, "score").select(F.round("auc", 6).alias("auc"))


# Centres for the assignment queries, given by hand.
TEXT_COLUMNS = ["text_length", "word_count"]
TEXT_CENTRES = [(300.0, 50.0), (2000.0, 330.0), (9000.0, 1500.0)]
LINE_COLUMNS = ["l_quantity", "discount_percent", "tax_percent"]
LINE_CENTRES = [(10.0, 2.0, 2.0), (25.0, 5.0, 4.0), (40.0, 8.0, 6.0)]


def assigned_sql(columns, centres):
    distances = ", ".join(
        "(" + " + ".join(f"({c} - ({p!r})::DOUBLE) ** 2" for c, p in zip(columns, centre)) + ")" for centre in centres
    )
    return f"[{distances}]"


TEXT_CTE = f"""sized AS (
  SELECT doc_id, length(text)::DOUBLE AS text_length,
         len(regexp_split_to_array(text, '[\\t\\n\\v\\f\\r ]+'))::DOUBLE AS word_count FROM documents
),
measured AS (SELECT doc_id, {assigned_sql(TEXT_COLUMNS, TEXT_CENTRES)} AS d FROM sized),
assigned AS (
  SELECT doc_id, CAST(list_position(d, list_min(d)) - 1 AS INT) AS cluster, sqrt(list_min(d)) AS distance FROM measured
)"""


def assigned_documents(spark, sf_dir):
    sized = read_table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length("text").cast("double").alias("text_length"),
        word_count(F.col("text")).cast("double").alias("word_count"),
    )
    return clusters.assign_to_centres(sized, TEXT_COLUMNS, TEXT_CENTRES)


@query("kmeans_assign", f"WITH {TEXT_CTE} SELECT doc_id, cluster, round(distance, 6) AS distance FROM assigned")
def kmeans_assign(spark, sf_dir):
    return assigned_documents(spark, sf_dir).select("doc_id", "cluster", F.round("distance", 6).alias("distance"))


@query("avg_distance", f"WITH {TEXT_CTE} SELECT round(avg(distance), 6) AS avg_distance FROM assigned")
def avg_distance(spark, sf_dir):
    return clusters.mean_distance(assigned_documents(spark, sf_dir)).select(F.round("avg_distance", 6).alias("avg_distance"))


@query(
    "flag_anomalies",
    f"""WITH {TEXT_CTE},
    limits AS (SELECT cluster, avg(distance) + 3 * coalesce(stddev_samp(distance), 0) AS threshold FROM assigned GROUP BY cluster)
    SELECT doc_id, cluster, round(distance, 6) AS distance, round(threshold, 6) AS threshold,
           distance > threshold AS is_anomaly FROM assigned JOIN limits USING (cluster)""",
)
def flag_anomalies(spark, sf_dir):
    flagged = clusters.flag_anomalies(assigned_documents(spark, sf_dir), len(TEXT_CENTRES))
    rounded = [F.round(c, 6).alias(c) for c in ("distance", "threshold")]
    return flagged.select("doc_id", "cluster", *rounded, "is_anomaly")


LINES_CTE = f"""sized AS (
  SELECT l_quantity, l_discount * 100 AS discount_percent, l_tax * 100 AS tax_percent FROM lineitem
),
assigned AS (
  SELECT *, list_position(d, list_min(d)) - 1 AS cluster
  FROM (SELECT *, {assigned_sql(LINE_COLUMNS, LINE_CENTRES)} AS d FROM sized)
)"""


@query(
    "silhouette",
    f"""WITH {LINES_CTE},
    points AS (SELECT {", ".join(LINE_COLUMNS)}, cluster, {" + ".join(f"{c} * {c}" for c in LINE_COLUMNS)} AS norm FROM assigned),
    sums AS (SELECT cluster, count(*) AS n, sum(norm) AS s, {", ".join(f"sum({c}) AS y_{c}" for c in LINE_COLUMNS)} FROM points GROUP BY 1),
    distances AS (
      SELECT p.cluster, c.cluster AS other, c.n,
             p.norm + c.s / c.n - 2 * ({" + ".join(f"p.{c} * c.y_{c}" for c in LINE_COLUMNS)}) / c.n AS d, p.point
      FROM (SELECT *, row_number() OVER () AS point FROM points) p, sums c
    ),
    ab AS (
      SELECT cluster, max(CASE WHEN cluster = other THEN n END) AS n,
             max(CASE WHEN cluster = other THEN d * n / (n - 1) END) AS a, min(CASE WHEN cluster <> other THEN d END) AS b
      FROM distances GROUP BY point, cluster
    ),
    s AS (
      SELECT cluster, CASE WHEN n = 1 THEN 0 WHEN a < b THEN 1 - a / b WHEN a > b THEN b / a - 1 ELSE 0 END AS silhouette FROM ab
    )
    SELECT CAST(cluster AS INT) AS cluster, CAST(count(*) AS BIGINT) AS n, round(avg(silhouette), 6) AS silhouette FROM s GROUP BY 1""",
)
def silhouette(spark, sf_dir):
    sized = read_table(spark, sf_dir, "lineitem").select(
        "l_quantity", (F.col("l_discount") * 100).alias("discount_percent"), (F.col("l_tax") * 100).alias("tax_percent")
    )
    assigned = clusters.assign_to_centres(sized, LINE_COLUMNS, LINE_CENTRES)
    rows = m.silhouette_rows(assigned, LINE_COLUMNS, "cluster")
    return rows.groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


NB_COLUMNS = [*RATINGS, "month", "year"]


@query(
    "nb_parameters",
    f"""WITH {DATED_CTE},
    long AS (
      SELECT overall AS label, id, unnest([{", ".join(f"'{c}'" for c in NB_COLUMNS)}]) AS feature,
             unnest([{", ".join(f"{c}::DOUBLE" for c in NB_COLUMNS)}]) AS x
      FROM dated WHERE {" AND ".join(f"{r} IS NOT NULL" for r in RATINGS)}
    ),
    classes AS (SELECT label, count(DISTINCT id) AS n, sum(x) AS total FROM long GROUP BY 1),
    parts AS (SELECT label, feature, sum(x) AS x FROM long GROUP BY 1, 2)
    SELECT label, feature,
           round(ln((n + 1) / CAST((SELECT sum(n) + count(*) FROM classes) AS DOUBLE)), 6) AS pi,
           round(ln((x + 1) / (total + {len(NB_COLUMNS)})), 6) AS theta
    FROM parts JOIN classes USING (label)""",
)
def nb_parameters(spark, sf_dir):
    dated = projection.with_stay_date(reviews_from_orders(spark, sf_dir, with_text=False))
    complete = nulls.drop_incomplete(dated.select("ratings.*", "month", "year"), NB_COLUMNS)
    labelled = complete.withColumn("label", F.col("overall"))
    parameters = clusters.naive_bayes_parameters(labelled, "label", NB_COLUMNS)
    return parameters.withColumns({c: F.round(c, 6) for c in ("pi", "theta")})
