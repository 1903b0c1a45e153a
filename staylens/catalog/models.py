"""Single models and scoring with saved ones."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.catalog.relational import dated_sql
from staylens.catalog.statistics import LABELLED_CTE
from staylens.functions.keys import arithmetic_bucket, arithmetic_bucket_sql
from staylens.operators.aggregates import entity_stats
from staylens.operators.features import scaled_vector_stages
from staylens.plans import anomalies, room_experience, scoring, segmentation, sentiment
from staylens.sources.models import load_pipeline, save_model
from staylens.sources.registry import RunRegistry
from staylens.sources.reviews import RATINGS, REVIEWS_CTE, reviews_from_orders
from staylens.sources.tables import read_table
from staylens.streaming import features as author_stream
from staylens.streaming import scoring as stream_scoring
from staylens.workspace import new_dir, stage


def rated_documents(spark, sf_dir):
    """Documents with a quality label, as reviews rated 5 (good) or 1."""
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), "text", (F.col("quality") * 4 + 1).cast("double").alias("overall")
    )


def entity_ratings(spark, sf_dir):
    return reviews_from_orders(spark, sf_dir, with_text=False).select("offering_id", "ratings.*")


def segments(spark, sf_dir, model_name):
    job = segmentation.segment_entities(entity_ratings(spark, sf_dir), "offering_id", RATINGS)
    return job.predictions(model_name).select("offering_id", "cluster_id")


@query("cluster_entities")
def cluster_entities(spark, sf_dir):
    return segments(spark, sf_dir, "KMeans")


@query("cluster_gmm")
def cluster_gmm(spark, sf_dir):
    return segments(spark, sf_dir, "GMM")


def rooms(spark, sf_dir, model_name):
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    job = room_experience.classify_rooms(reviews, bucket=arithmetic_bucket)
    return job.predictions(model_name).select("review_id", "rooms_label", "label", "prediction")


@query("classify_tree")
def classify_tree(spark, sf_dir):
    return rooms(spark, sf_dir, "DecisionTree")


BAYES_COLUMNS = [r for r in RATINGS if r != "rooms"] + ["month", "year"]


# Featured reviews, and the training part with the copies that balancing gives each row.
TRAINING_CTE = f"""{LABELLED_CTE},
    featured AS (
      SELECT * FROM ({dated_sql("labelled")}) WHERE {" AND ".join(f"{c} IS NOT NULL" for c in BAYES_COLUMNS)}
    ),
    label_index AS (
      SELECT rooms_label, CAST(row_number() OVER (ORDER BY count(*) DESC, rooms_label) - 1 AS DOUBLE) AS label
      FROM featured GROUP BY rooms_label
    ),
    parts AS (
      SELECT *, {arithmetic_bucket_sql("id", 100)} < 80 AS is_train FROM featured JOIN label_index USING (rooms_label)
    ),
    sized AS (SELECT *, count(*) OVER (PARTITION BY label) AS n FROM parts WHERE is_train),
    weighted AS (
      SELECT *, target // n + CASE WHEN {arithmetic_bucket_sql("id", 1_000_000)}
             < (target % n) / CAST(n AS DOUBLE) * 1000000 THEN 1 ELSE 0 END AS w
      FROM sized, (SELECT max(n) AS target FROM sized)
    )"""


@query(
    "classify_bayes",
    f"""WITH {TRAINING_CTE},
    sums AS (
      SELECT label, sum(w) AS n, {", ".join(f"sum(w * {c}) AS {c}" for c in BAYES_COLUMNS)} FROM weighted GROUP BY label
    ),
    totals AS (SELECT *, {" + ".join(BAYES_COLUMNS)} + {len(BAYES_COLUMNS)} AS total FROM sums),
    scored AS (
      SELECT t.id, t.rooms_label, t.label, s.label AS candidate,
             ln((s.n + 1) / CAST((SELECT sum(n) + count(*) FROM sums) AS DOUBLE))
             + {" + ".join(f"t.{c} * ln((s.{c} + 1) / s.total)" for c in BAYES_COLUMNS)} AS score
      FROM (SELECT * FROM parts WHERE NOT is_train) t, totals s
    )
    SELECT id AS review_id, rooms_label, label, arg_max(candidate, score) AS prediction
    FROM scored GROUP BY id, rooms_label, label""",
)
def classify_bayes(spark, sf_dir):
    """Balanced training and prediction of naive Bayes, which has a closed form."""
    return rooms(spark, sf_dir, "NaiveBayes")


def sentiments(spark, sf_dir, model_name):
    models = {model_name: sentiment.estimators()[model_name]}
    job = sentiment.compare_sentiment_models(rated_documents(spark, sf_dir), models=models)
    return job.predictions(model_name).select("id", "label", "prediction")


@query("sentiment_lr")
def sentiment_lr(spark, sf_dir):
    return sentiments(spark, sf_dir, "LogisticRegression")


@query("sentiment_svm")
def sentiment_svm(spark, sf_dir):
    return sentiments(spark, sf_dir, "LinearSVM")


@query(
    "model_roundtrip",
    """SELECT CAST(count(DISTINCT o_custkey // 10) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed,
    true AS second_save_fails FROM orders""",
)
def model_roundtrip(spark, sf_dir):
    """A saved, overwritten and reloaded pipeline predicts what the fitted one does."""
    stats = stage(entity_stats(entity_ratings(spark, sf_dir), "offering_id", RATINGS), "entity-stats")
    columns = [c for c in stats.columns if c != "offering_id"]
    kmeans = KMeans(k=5, seed=1, featuresCol="features", predictionCol="fitted")
    model = Pipeline(stages=[*scaled_vector_stages(columns), kmeans]).fit(stats)
    path = save_model(model, new_dir(spark, "model"))
    try:
        save_model(model, path)
        refused = False
    except Exception as error:
        refused = "overwrite" in str(error)
    loaded = load_pipeline(save_model(model, path, overwrite=True))
    again = loaded.transform(stats).withColumnRenamed("fitted", "loaded").select("offering_id", "loaded")
    compared = model.transform(stats).select("offering_id", "fitted").join(again, "offering_id")
    return compared.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("fitted") != F.col("loaded")).alias("n_changed"),
        F.lit(refused).alias("second_save_fails"),
    )


_registries: dict[tuple[str, str], RunRegistry] = {}


def train_sentiment(spark, sf_dir):
    """Train and record the sentiment models; the session's scoring queries use them."""
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    sentiment.compare_sentiment_models(
        rated_documents(spark, sf_dir), model_dir=new_dir(spark, "models"), registry=registry
    )
    _registries[spark.sparkContext.applicationId, sf_dir] = registry
    return registry


def trained_registry(spark, sf_dir):
    """The session's registry with sentiment runs over the folder, trained if missing."""
    return _registries.get((spark.sparkContext.applicationId, sf_dir)) or train_sentiment(spark, sf_dir)


# Reviews in a file that arrives.
FILE_ROWS = 100_000


@query(
    "stream_user_features",
    f"""WITH {REVIEWS_CTE} SELECT author_id AS user_id, CAST(count(*) AS BIGINT) AS review_count,
           round(avg(length(text)), 6) AS avg_text_length, round(avg(num_helpful_votes), 6) AS avg_helpful_votes
    FROM reviews WHERE author_id IS NOT NULL GROUP BY author_id""",
)
def stream_user_features(spark, sf_dir):
    """Author features from a stream that arrives in several files and is stopped and started again."""
    reviews = reviews_from_orders(spark, sf_dir)
    folder, log, checkpoint = (new_dir(spark, name) for name in ("review-files", "author-log", "author-checkpoint"))
    # Files grow in number, not in size; each half arrives in two batches.
    files = max(2, -(-read_table(spark, sf_dir, "orders").count() // (2 * FILE_ROWS)))
    for part in range(2):
        reviews.where(F.col("id") % 2 == part).repartition(files).write.mode("append").parquet(folder)
        stream = stream_scoring.read_stream(spark, folder, reviews.schema, files_per_trigger=-(-files // 2))
        author_stream.follow_authors(stream, log, checkpoint).awaitTermination()
    features = author_stream.latest_features(author_stream.read_log(spark, log))
    return features.withColumns({c: F.round(c, 6) for c in ("avg_text_length", "avg_helpful_votes")})


@query("model_comparison")
def model_comparison(spark, sf_dir):
    """The recorded sentiment runs side by side, every metric of each."""
    details = [F.col(f"details.{c}").alias(c) for c in ("f1_score", "macro_f1", "precision", "recall")]
    cells = F.to_json("details.confusion_matrix").alias("confusion_matrix")
    board = trained_registry(spark, sf_dir).leaderboard()
    return board.select("rank", "model_name", "score_type", "evaluation_score", *details, cells)


@query("score_batch")
def score_batch(spark, sf_dir):
    """Every document scored by the best model recorded for the task."""
    registry = trained_registry(spark, sf_dir)
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return scoring.score_batch(registry, sentiment.TASK_NAME, documents).select("doc_id", "prediction")


def recorded(spark, job, *args, **settings):
    """A registry with the runs of one job, and what the job returned."""
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    return registry, job(*args, model_dir=new_dir(spark, "models"), registry=registry, **settings)


def changed(left, right, key, columns):
    """Rows on both sides, and those that differ."""
    pairs = left.select(key, *columns).join(right.select(key, *[F.col(c).alias(f"_{c}") for c in columns]), key)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return pairs.agg(F.count("*").alias("n_rows"), F.count_if(~same).alias("n_changed"))


@query(
    "score_segments",
    """SELECT CAST(count(DISTINCT o_custkey // 10) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM orders""",
)
def score_segments(spark, sf_dir):
    """Entities placed by the best saved model: where the job placed them."""
    ratings = entity_ratings(spark, sf_dir)
    registry, job = recorded(spark, segmentation.segment_entities, ratings, "offering_id", RATINGS)
    best = registry.best_run(segmentation.TASK_NAME)["model_name"]
    scored = scoring.score_segments(registry, ratings, "offering_id", RATINGS)
    return changed(scored, job.predictions(best), "offering_id", ["cluster_id"])


@query(
    "score_rooms",
    f"""WITH {LABELLED_CTE}, complete AS (
      SELECT * FROM ({dated_sql("reviews")}) WHERE {" AND ".join(f"{c} IS NOT NULL" for c in BAYES_COLUMNS)}
    )
    SELECT (SELECT CAST(count(*) AS BIGINT) FROM reviews) AS n_all, (SELECT count(*) FROM reviews) - CAST(count(*) AS BIGINT) AS n_null,
           CAST(count(*) FILTER (WHERE rooms IS NOT NULL AND {arithmetic_bucket_sql("id", 100)} >= 80) AS BIGINT) AS n_rows,
           CAST(0 AS BIGINT) AS n_changed FROM complete""",
)
def score_rooms(spark, sf_dir):
    """Every review scored by the best saved model, incomplete ones with null; held-out ones as the job scored them."""
    reviews = reviews_from_orders(spark, sf_dir, with_text=False)
    registry, job = recorded(spark, room_experience.classify_rooms, reviews, bucket=arithmetic_bucket)
    best = registry.best_run(room_experience.TASK_NAME)["model_name"]
    scored = stage(scoring.score_rooms(registry, reviews), "scored-rooms")
    counts = scored.agg(F.count("*").alias("n_all"), F.count_if(F.col("prediction").isNull()).alias("n_null")).first()
    compared = changed(scored, job.predictions(best), "review_id", ["prediction"])
    return compared.select(F.lit(counts["n_all"]).alias("n_all"), F.lit(counts["n_null"]).alias("n_null"), "n_rows", "n_changed")


@query(
    "score_anomalies",
    f"""WITH {REVIEWS_CTE}
    SELECT 'user' AS level, CAST(count(DISTINCT author_id) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM reviews
    UNION ALL SELECT 'review', CAST(count(text) AS BIGINT), CAST(0 AS BIGINT) FROM reviews""",
)
def score_anomalies(spark, sf_dir):
    """Clusters and flags of the reviews the job was fitted on, by its saved models."""
    reviews = reviews_from_orders(spark, sf_dir)
    registry, job = recorded(spark, anomalies.find_anomalies, reviews)
    users, texts = scoring.score_reviews(registry, reviews)
    columns = ["cluster", "is_anomaly"]
    levels = [
        ("user", changed(users, job.predictions("KMeans_User"), "user_id", columns)),
        ("review", changed(texts, job.predictions("KMeans_Review"), "review_id", columns)),
    ]
    return reduce(DataFrame.unionByName, [found.select(F.lit(level).alias("level"), "*") for level, found in levels])


@query(
    "score_stream",
    "SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_changed FROM documents",
)
def score_stream(spark, sf_dir):
    """Documents scored as a stream: as many rows, and the same predictions, as in batch."""
    registry = trained_registry(spark, sf_dir)
    model = load_pipeline(registry.best_run(sentiment.TASK_NAME)["model_path"])
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    stream = stream_scoring.read_stream(spark, f"{sf_dir.rstrip('/')}/documents.parque[t]", documents.schema)
    output = new_dir(spark, "scored")
    job = stream_scoring.score_stream(
        stream, model, ["doc_id", "prediction"], output, new_dir(spark, "stream-checkpoint")
    )
    job.awaitTermination()
    batch = model.transform(documents).select("doc_id", F.col("prediction").alias("batch"))
    compared = spark.read.parquet(output).join(batch, "doc_id", "full")
    return compared.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("prediction").eqNullSafe(F.col("batch"))).alias("n_changed"),
    )
