"""Fitted models against what they must satisfy; the SQL side counts the rows and, for the tree, finds the split itself."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.catalog.models import TRAINING_CTE, entity_ratings, rated_documents
from staylens.functions.keys import arithmetic_bucket, arithmetic_bucket_sql
from staylens.operators import certificates
from staylens.operators.clusters import assign_to_centres
from staylens.operators.sampling import hash_split
from staylens.operators.text_features import indexed_terms
from staylens.plans import room_experience, segmentation, sentiment
from staylens.sources.models import load_pipeline
from staylens.sources.reviews import RATINGS, reviews_from_orders
from staylens.workspace import new_dir, stage

IS_TRAIN = f"{arithmetic_bucket_sql('doc_id', 100)} < 80"

LINEAR_SQL = f"""
SELECT CAST(count(*) FILTER (WHERE NOT is_train) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed,
       CAST(count(*) FILTER (WHERE is_train) AS BIGINT) AS n_train, true AS loss_is_lower, true AS gradient_is_small
FROM (SELECT {IS_TRAIN} AS is_train FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL)"""


def linear_certificate(spark, sf_dir, model_name, loss, bound):
    """Predictions of the held-out part re-scored from the saved coefficients, and the gradient of the training loss.

    Nothing of the fitted pipeline runs here but for the predictions it is compared with:
    words, hashes, weights and sums are column expressions.
    """
    rated = stage(rated_documents(spark, sf_dir), "rated-documents")
    models = {model_name: sentiment.estimators()[model_name]}
    job = sentiment.compare_sentiment_models(rated, models=models, bucket=arithmetic_bucket, model_dir=new_dir(spark, "models"))
    *_, idf, model = load_pipeline(job.runs[0].record.model_path).stages
    coefficients, intercept = model.coefficients.toArray(), model.intercept

    label = (F.col("overall") >= 4.0).cast("double")
    indexed = indexed_terms(rated.where("overall IS NOT NULL").select("id", label.alias("label"), "text"), "text")
    weights = certificates.numbers_column(rated, idf.idf.toArray())
    entries = indexed.withColumn("_idf", weights).withColumn("entries", certificates.sparse_entries(F.col("indices"), F.col("_idf")))
    train, test = hash_split(stage(entries.select("id", "label", "entries"), "entries"), "id", bucket=arithmetic_bucket)

    scored = test.withColumn("_coefficients", certificates.numbers_column(test, coefficients))
    margin = certificates.linear_margin(F.col("entries"), F.col("_coefficients"), intercept)
    again = scored.select("id", F.when(margin > 0, 1.0).otherwise(0.0).alias("again"))
    compared = job.predictions(model_name).select("id", "prediction").join(again, "id", "full")
    changed = compared.agg(F.count("*").alias("n_rows"), F.count_if(~F.col("prediction").eqNullSafe(F.col("again"))).alias("n_changed"))
    proof = certificates.linear_certificate(train, "entries", "label", coefficients, intercept, loss)
    found = proof.select(
        (F.col("loss") < F.col("start_loss")).alias("loss_is_lower"),
        (F.col("gradient") <= bound * F.col("start_gradient")).alias("gradient_is_small"),
    ).first()
    counted = train.agg(F.count("*")).scalar()
    return changed.select("*", counted.alias("n_train"), *[F.lit(found[c]).alias(c) for c in found.asDict()])


@query("lr_certificate", LINEAR_SQL)
def lr_certificate(spark, sf_dir):
    return linear_certificate(spark, sf_dir, "LogisticRegression", "logistic", 0.01)


@query("svm_certificate", LINEAR_SQL)
def svm_certificate(spark, sf_dir):
    return linear_certificate(spark, sf_dir, "LinearSVM", "hinge", 0.05)


FEATURES = {c: c.removesuffix("_rating") for c in room_experience.FEATURES}


@query(
    "tree_root_split",
    f"""WITH {TRAINING_CTE},
    cells AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {c} AS at_most, label, w FROM weighted" for f, c in FEATURES.items())}),
    counts AS (
      SELECT feature, at_most, sum(CASE WHEN label = 0 THEN w ELSE 0 END) AS c0, sum(CASE WHEN label = 1 THEN w ELSE 0 END) AS c1,
             sum(CASE WHEN label = 2 THEN w ELSE 0 END) AS c2 FROM cells GROUP BY feature, at_most
    ),
    sides AS (
      SELECT feature, at_most, {", ".join(f"CAST(sum(c{k}) OVER w AS DOUBLE) AS l{k}, CAST(sum(c{k}) OVER (PARTITION BY feature) AS DOUBLE) AS t{k}" for k in range(3))}
      FROM counts WINDOW w AS (PARTITION BY feature ORDER BY at_most)
    ),
    halves AS (SELECT *, l0 + l1 + l2 AS nl, t0 + t1 + t2 AS n FROM sides),
    gains AS (
      SELECT feature, at_most, nl, n - nl AS nr, 1 - (t0 * t0 + t1 * t1 + t2 * t2) / (n * n)
        - (nl - (l0 * l0 + l1 * l1 + l2 * l2) / nl + n - nl - ((t0 - l0) ** 2 + (t1 - l1) ** 2 + (t2 - l2) ** 2) / (n - nl)) / n AS gain
      FROM halves WHERE nl < n
    )
    SELECT feature, CAST(at_most AS DOUBLE) AS at_most, CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right, round(gain, 9) AS gain,
           true AS tree_agrees
    FROM gains ORDER BY gains.gain DESC LIMIT 1""",
)
def tree_root_split(spark, sf_dir):
    """The best first split of the balanced training part, which is the fitted tree's root."""
    parts = room_experience.room_parts(reviews_from_orders(spark, sf_dir, with_text=False), bucket=arithmetic_bucket)
    train = stage(parts.train.select("label", *room_experience.FEATURES), "tree-rows")
    tree = room_experience.estimators()["DecisionTree"].fit(parts.assembler.transform(train))
    split = tree._java_obj.rootNode().split()
    feature, threshold = room_experience.FEATURES[split.featureIndex()], split.threshold()
    best = certificates.split_gains(train, room_experience.FEATURES, "label", len(parts.index.labels)).orderBy(F.desc("gain")).limit(1)
    below = train.where(F.col(feature) <= threshold).agg(F.max(feature)).scalar()
    agrees = (F.col("feature") == feature) & (F.col("at_most") == below)
    return best.select("feature", "at_most", "n_left", "n_right", F.round("gain", 9).alias("gain"), agrees.alias("tree_agrees"))


CLUSTER_SQL = """SELECT CAST(count(DISTINCT o_custkey // 10) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed,
    CAST(0 AS BIGINT) AS n_far FROM orders"""


def clustered(spark, sf_dir, model_name):
    job = segmentation.segment_entities(entity_ratings(spark, sf_dir), "offering_id", RATINGS)
    run = next(r for r in job.runs if r.record.model_name == model_name)
    return run.model.stages[-1], run.predictions.withColumn("x", vector_to_array("features"))


@query("mixture_certificate", CLUSTER_SQL)
def mixture_certificate(spark, sf_dir):
    """Shares of the fitted mixture's components, and the component of each entity, from densities of our own."""
    model, rows = clustered(spark, sf_dir, "GMM")
    gaussians = model.gaussiansDF.collect()
    shared = certificates.mixture_shares(
        rows.withColumn("p", vector_to_array("probability")), "x", model.weights, [g["mean"].toArray() for g in gaussians], [g["cov"].toArray() for g in gaussians]
    )
    gap = F.array_max(F.zip_with("shares", "p", lambda a, b: F.abs(a - b)))
    return shared.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("component") != F.col("cluster_id")).alias("n_changed"),
        F.count_if(gap > 1e-9).alias("n_far"),
    )


@query("kmeans_certificate", CLUSTER_SQL)
def kmeans_certificate(spark, sf_dir):
    """Entities not at their nearest centre, and centres farther than 1e-4 from the mean of their rows: a fixed point has none of either."""
    model, rows = clustered(spark, sf_dir, "KMeans")
    centres = np.array(model.clusterCenters())
    names = [f"x{i}" for i in range(centres.shape[1])]
    flat = rows.select("cluster_id", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(names)])
    placed = assign_to_centres(flat, names, centres.tolist())
    means = placed.groupBy("cluster_id").agg(F.count("*").alias("n"), F.count_if(F.col("cluster") != F.col("cluster_id")).alias("changed"), F.array(*[F.avg(c) for c in names]).alias("mean"))
    at = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centres])
    apart = F.sqrt(F.aggregate(F.zip_with("mean", F.get(at, F.col("cluster_id")), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x))
    return means.agg(F.sum("n").alias("n_rows"), F.sum("changed").alias("n_changed"), F.count_if(apart > 1e-4).alias("n_far"))
