"""Registry queries over a put log with one put per event.

Keys repeat (event type and user), so puts overwrite each other; puts of small values
carry no score, so cells are merged one by one. A task has runs of several score types, and of none.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from staylens.catalog.base import query
from staylens.operators import registry_views as views
from staylens.sources.keylists import read_key_list, write_key_list
from staylens.sources.registry import RunRegistry
from staylens.sources.tables import read_table
from staylens.workspace import new_dir

PUTS_CTE = """
puts AS (
  SELECT 'task_' || event_type || '_user' || user_id AS row_key, 'Task ' || event_type AS task_name,
         'Model' || upper(event_type) AS model_name, ts AS run_timestamp, value / 3 AS training_time_seconds,
         CASE WHEN value >= 5 THEN value / 7 END AS evaluation_score,
         CASE WHEN user_id % 7 = 3 THEN NULL WHEN user_id % 7 = 5 THEN 'AUC' WHEN event_type = 'click' THEN 'AUC'
              WHEN event_type = 'view' THEN 'WeightedF1' WHEN event_type = 'error' THEN 'ClusterDistance' ELSE 'Silhouette' END AS score_type,
         'models/' || event_id AS model_path, event_id AS put_seq
  FROM events
),
merged AS (
  SELECT row_key, arg_max(task_name, put_seq) AS task_name, arg_max(model_name, put_seq) AS model_name,
         arg_max(run_timestamp, put_seq) AS run_timestamp,
         arg_max(training_time_seconds, put_seq) AS training_time_seconds,
         arg_max(evaluation_score, put_seq) AS evaluation_score,
         arg_max(score_type, put_seq) AS score_type, arg_max(model_path, put_seq) AS model_path, max(put_seq) AS put_seq
  FROM puts GROUP BY row_key
)"""
ROUNDED = "round(training_time_seconds, 6) AS training_time_seconds, round(evaluation_score, 6) AS evaluation_score"


def event_puts(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    score_type = (
        F.when(F.col("user_id") % 7 == 3, None)
        .when(F.col("user_id") % 7 == 5, "AUC")
        .when(kind == "click", "AUC")
        .when(kind == "view", "WeightedF1")
        .when(kind == "error", "ClusterDistance")
        .otherwise("Silhouette")
    )
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("task_"), kind, F.lit("_user"), F.col("user_id")).alias("row_key"),
        F.concat(F.lit("Task "), kind).alias("task_name"),
        F.concat(F.lit("Model"), F.upper(kind)).alias("model_name"),
        F.col("ts").alias("run_timestamp"),
        (value / 3).alias("training_time_seconds"),
        F.when(value >= 5, value / 7).alias("evaluation_score"),
        score_type.alias("score_type"),
        F.concat(F.lit("models/"), F.col("event_id")).alias("model_path"),
        F.col("event_id").alias("put_seq"),
    )


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("training_time_seconds", "evaluation_score")})


def written_registry(spark, sf_dir):
    registry = RunRegistry(spark, new_dir(spark, "registry"))
    registry.put_frame(event_puts(spark, sf_dir))
    return registry


@query(
    "registry_upsert",
    f"WITH {PUTS_CTE} SELECT row_key, task_name, model_name, {ROUNDED}, score_type, model_path, put_seq FROM merged",
)
def registry_upsert(spark, sf_dir):
    """Puts written to a registry path in one append and merged on reading."""
    merged = written_registry(spark, sf_dir).read()
    return rounded(merged.drop("run_timestamp", "details"))


@query(
    "registry_keys",
    f"WITH {PUTS_CTE} SELECT row_key FROM (SELECT DISTINCT row_key FROM puts) ORDER BY row_key LIMIT 100",
)
def registry_keys(spark, sf_dir):
    """The first hundred keys, written as a key list and read back."""
    path = new_dir(spark, "keys")
    write_key_list(views.keys(event_puts(spark, sf_dir)), path)
    return read_key_list(spark, path)


@query(
    "registry_lookup",
    f"""WITH {PUTS_CTE}
    SELECT k.row_key, task_name, evaluation_score IS NOT NULL AS has_score, model_path, put_seq
    FROM (SELECT 'task_click_user' || c_custkey AS row_key FROM customer) k LEFT JOIN merged ON merged.row_key = k.row_key""",
)
def registry_lookup(spark, sf_dir):
    """One key per customer, most of which have no run."""
    path = new_dir(spark, "keys")
    customers = read_table(spark, sf_dir, "customer")
    write_key_list(customers.select(F.concat(F.lit("task_click_user"), "c_custkey").alias("row_key")), path)
    found = written_registry(spark, sf_dir).lookup(read_key_list(spark, path))
    return found.select("row_key", "task_name", F.col("evaluation_score").isNotNull().alias("has_score"), "model_path", "put_seq")


@query(
    "registry_get",
    f"""WITH {PUTS_CTE}
    SELECT row_key, task_name, round(evaluation_score, 6) AS evaluation_score, model_path, put_seq
    FROM merged WHERE row_key IN ('task_click_user1', 'task_view_user2', 'task_error_user3', 'task_view_user11')""",
)
def registry_get(spark, sf_dir):
    """Four keys from a registry in folders by key; the other folders are not opened."""
    compacted = written_registry(spark, sf_dir).compact(new_dir(spark, "registry"), buckets=64)
    found = compacted.get(["task_click_user1", "task_view_user2", "task_error_user3", "task_view_user11", "no such key"])
    return found.select("row_key", "task_name", F.round("evaluation_score", 6).alias("evaluation_score"), "model_path", "put_seq")


@query(
    "leaderboard",
    f"""WITH {PUTS_CTE}
    SELECT row_key, score_type, round(evaluation_score, 6) AS evaluation_score, CAST(rank() OVER (
      PARTITION BY score_type
      ORDER BY CASE WHEN score_type = 'ClusterDistance' THEN -evaluation_score ELSE evaluation_score END DESC
    ) AS BIGINT) AS rank FROM merged WHERE evaluation_score IS NOT NULL""",
)
def leaderboard(spark, sf_dir):
    board = written_registry(spark, sf_dir).leaderboard()
    return board.select("row_key", "score_type", F.round("evaluation_score", 6).alias("evaluation_score"), "rank")


@query(
    "best_runs",
    f"""WITH {PUTS_CTE},
    placed AS (
      SELECT *, row_number() OVER (
        PARTITION BY task_name, score_type
        ORDER BY CASE WHEN score_type = 'ClusterDistance' THEN -evaluation_score ELSE evaluation_score END DESC, row_key DESC
      ) AS place FROM merged WHERE evaluation_score IS NOT NULL
    )
    SELECT task_name, score_type, row_key, round(evaluation_score, 6) AS evaluation_score, model_path FROM placed WHERE place = 1""",
)
def best_runs(spark, sf_dir):
    best = views.best_runs(views.latest(event_puts(spark, sf_dir)))
    return best.select("task_name", "score_type", "row_key", F.round("evaluation_score", 6).alias("evaluation_score"), "model_path")


@query(
    "registry_record",
    f"""WITH {PUTS_CTE}
    SELECT row_key || '_' || lower(model_name) || '_' || strftime(run_timestamp, '%Y%m%d%H%M%S') AS row_key,
           task_name, model_name, strftime(run_timestamp, '%Y%m%d%H%M%S') AS run_timestamp,
           CAST(round_even(training_time_seconds, 2) AS VARCHAR) AS training_time_seconds,
           CAST(round_even(evaluation_score, 4) AS VARCHAR) AS evaluation_score, score_type, model_path
    FROM puts""",
)
def registry_record(spark, sf_dir):
    puts = event_puts(spark, sf_dir)
    named = puts.withColumn("row_key", views.make_row_key(F.col("row_key"), F.col("model_name"), F.col("run_timestamp")))
    return views.as_text_cells(named)
