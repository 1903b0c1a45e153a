"""Views of a run registry: an append-only log of puts, one row per put.

Any frame with the columns of ``staylens.sources.registry.PUT_SCHEMA`` will do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.operators.ranking import ranked

KEY, VERSION, BUCKET = "row_key", "put_seq", "bucket"

# Score types for which a smaller score is the better one.
LOWER_IS_BETTER = ["ClusterDistance"]


def make_row_key(task: Column, model: Column, run_timestamp: Column) -> Column:
    """``<task>_<model in lower case>_<yyyyMMddHHmmss>``."""
    return F.concat_ws("_", task, F.lower(model), F.date_format(run_timestamp, "yyyyMMddHHmmss"))


def latest(puts: DataFrame, key: str = KEY, version: str = VERSION) -> DataFrame:
    """One row per key with the last value put into each cell.

    A put changes the cells it carries and leaves the others. Each cell is a
    ``max_by`` that combines on the map side, so a key with very many puts costs no
    more than any other; a window per key would sort all its puts in one task.
    """
    cells = [c for c in puts.columns if c not in (key, version)]
    carried = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(version))).alias(c) for c in cells]
    return puts.groupBy(key).agg(*carried, F.max(version).alias(version))


def keys(registry: DataFrame, limit: int | None = 100, key: str = KEY) -> DataFrame:
    """Row keys in byte order, the first ``limit`` ones (``None``: all)."""
    ordered = registry.select(key).distinct().orderBy(key)
    return ordered if limit is None else ordered.limit(limit)


def lookup(puts: DataFrame, wanted: DataFrame, key: str = KEY) -> DataFrame:
    """The latest row of every wanted key, nulls for keys that are not there.

    The log is merged first: that combines on the map side, so a key with very many puts
    is one row per task in the shuffle, and the join meets each key once.
    """
    return wanted.select(key).distinct().join(latest(puts), key, "left")


def key_bucket(key: Column, buckets: int) -> Column:
    """The folder of a row key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets).cast("long"))


def in_folders_of(puts: DataFrame, wanted: DataFrame, buckets: int, key: str = KEY) -> DataFrame:
    """The puts in the folders that hold a wanted key.

    There are at most ``buckets`` different folders, so they are broadcast, and the scan opens only those.
    """
    folders = wanted.select(key_bucket(F.col(key), buckets).alias(BUCKET)).distinct()
    return puts.join(F.broadcast(folders), BUCKET, "left_semi")


def get(puts: DataFrame, row_keys: Sequence[str], key: str = KEY) -> DataFrame:
    """Point lookup of a handful of keys; the key filter reaches the Parquet scan."""
    return latest(puts.where(F.col(key).isin(list(row_keys))))


def signed_score(score_type: str = "score_type", score: str = "evaluation_score") -> Column:
    """The score, negated where a smaller one is better, so that more is better; NaN is no score."""
    value = F.nanvl(F.col(score), F.lit(None).cast("double"))
    return F.when(F.col(score_type).isin(LOWER_IS_BETTER), -value).otherwise(value)


def leaderboard(registry: DataFrame) -> DataFrame:
    """Runs with their ``rank`` among runs of the same score type, best first.

    Scores of different types do not compare; runs without a type are ranked among
    themselves. Runs without a score are not ranked.
    """
    rated = registry.withColumn("_better", signed_score())
    return ranked(rated, ["score_type"], "_better").drop("_better")


def best_runs(registry: DataFrame, per: Sequence[str] = ("task_name", "score_type")) -> DataFrame:
    """The best run of each task and score type; equal scores go to the higher row key."""
    scored = registry.where(signed_score().isNotNull())
    order = F.struct(signed_score().alias("s"), F.col(KEY).alias("k"))
    run = F.struct(*[c for c in scored.columns if c not in per])
    return scored.groupBy(*per).agg(F.max_by(run, order).alias("run")).select(*per, "run.*")


def as_text_cells(registry: DataFrame) -> DataFrame:
    """The registry as text: score to 4 places, time to 2 (half even), details as JSON."""
    return registry.select(
        KEY,
        "task_name",
        "model_name",
        F.date_format("run_timestamp", "yyyyMMddHHmmss").alias("run_timestamp"),
        F.bround("training_time_seconds", 2).cast("string").alias("training_time_seconds"),
        F.bround("evaluation_score", 4).cast("string").alias("evaluation_score"),
        "score_type",
        "model_path",
        *([F.to_json("details").alias("details")] if "details" in registry.columns else []),
    )
