"""Mixing sources to target weights by systematic sampling; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from staylens.llm.base import query, table

WORD = r"[^\x20\x09-\x0D]+"


def mix_sources(
    docs: DataFrame,
    *,
    weights: Sequence[float] = (5, 2, 1),
    most_copies: int = 3,
    seed: int = 7,
    salts: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    Sources in code point order (null last) get ``weights`` in turn. They share 100 % of all
    words by weight; a target stops at ``most_copies`` times its source's size and the excess
    goes to the others by weight. A row's expected copies are target / source_size. Within a
    source the rows are lined up by size class, salt, size and id; the running sum of expected
    copies plus one random offset is cut at the integers, and a row gets one copy for each
    integer its stretch crosses. Neighbours in the line are of like size, so the words taken
    stay within about one size class of the target, and no row gets more than ``most_copies``.

    The running sum is taken in two steps, so that no task holds a source: rows are numbered
    within (source, size class, salt); the counts of these groups, at most 70 * ``salts`` a
    source, are summed up to give each group's start.

    Null text has size 0; null ids use salt 0 and come first; repeated rows count each; an empty
    table gives an empty result. Sources with no words have target 0 and no copies. Of further
    columns, those named like the added ones or starting with ``_mix_`` are replaced or dropped.
    """
    own = ["size", "source_size", "target", "copies"]
    kept = [c for c in docs.columns if c not in own and not c.startswith("_mix_")]
    salt = F.coalesce(F.conv(F.substring(F.md5(F.col(id_col).cast("string")), 1, 6), 16, 10).cast("long") % salts, F.lit(0))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in kept],
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.col(source_col).isNull().alias("_mix_no_source"),
        F.coalesce(F.col(source_col), F.lit("")).alias("_mix_source"),
        salt.alias("_mix_salt"),
    ).withColumn("_mix_class", F.floor(F.log1p(F.col("size").cast("double")) * 6))
    source = ["_mix_no_source", "_mix_source"]
    group = [*source, "_mix_class", "_mix_salt"]

    groups = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_mix_rows"), F.sum("size").alias("_mix_words"))
    line = Window.partitionBy(*source).orderBy("_mix_class", "_mix_salt")
    starts = groups.withColumn("_mix_start", F.sum("_mix_rows").over(line) - F.col("_mix_rows"))
    targets = source_targets(groups.groupBy(*source).agg(F.sum("_mix_words").alias("source_size")), source, weights, most_copies)
    starts = starts.join(targets, source).select(*group, "_mix_start", "source_size", "target")

    place = F.row_number().over(Window.partitionBy(*group).orderBy("size", id_col)).cast("long")
    name = F.concat(F.lit(f"{seed}:"), F.col("_mix_no_source").cast("string"), F.lit(":"), F.col("_mix_source"))
    offset = F.conv(F.substring(F.md5(name), 1, 4), 16, 10).cast("double") / 65536
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))

    def crossed(rank: Column) -> Column:
        return F.floor(rank.cast("double") * F.col("_mix_rate") + F.col("_mix_offset"))

    return (
        rows.withColumn("_mix_place", place)
        .join(starts, group)
        .withColumns({"_mix_rate": rate, "_mix_offset": offset, "_mix_rank": F.col("_mix_start") + F.col("_mix_place")})
        .withColumn("copies", F.least(crossed(F.col("_mix_rank")) - crossed(F.col("_mix_rank") - 1), F.lit(most_copies)))
        .select(*[F.col(f"`{c}`") for c in kept], *own)
    )


def source_targets(sizes: DataFrame, source: Sequence[str], weights: Sequence[float], most_copies: int) -> DataFrame:
    """``sizes`` (one row a source: keys, ``source_size``) with ``target``.

    Sources fill up in order of cap / weight. When those before a source are full, the level of
    the rest is what is left over the weights left; a source whose cap lies below its level is full.
    """
    place = F.row_number().over(Window.orderBy(*source)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    fill = Window.orderBy(F.col("_mix_cap") / F.col("_mix_weight"), *source)
    before, onward = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    rest = F.sum("source_size").over(Window.partitionBy(F.lit(1))) - F.coalesce(F.sum("_mix_cap").over(before), F.lit(0))
    open_ = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sizes.withColumns({"_mix_weight": weight, "_mix_cap": F.col("source_size") * most_copies})
        .withColumn("_mix_level", rest.cast("double") / F.sum("_mix_weight").over(onward))
        .withColumn("_mix_full", F.col("_mix_cap") <= F.col("_mix_level") * F.col("_mix_weight"))
        .withColumn("_mix_last", F.max(F.when(~F.col("_mix_full"), F.col("_mix_level"))).over(open_))
        .withColumn("target", F.when(F.col("_mix_full"), F.col("_mix_cap").cast("double")).otherwise(F.col("_mix_last") * F.col("_mix_weight")))
        .select(*source, "source_size", "target")
    )


ORACLE = f"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         source IS NULL AS no_source, coalesce(source, '') AS src,
         coalesce(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 6))::BIGINT % 64, 0) AS salt
  FROM documents
), r AS (
  SELECT *, row_number() OVER (PARTITION BY no_source, src ORDER BY CAST(floor(ln(1 + size::DOUBLE) * 6) AS BIGINT), salt, size, doc_id NULLS FIRST) AS rank
  FROM d
), s AS (
  SELECT no_source, src, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL
), w AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY no_source, src) - 1) % 3]::DOUBLE AS weight, 3 * source_size AS cap FROM s
), l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) - coalesce(sum(cap) OVER (ORDER BY cap / weight, no_source, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, no_source, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT no_source, src, source_size,
         CASE WHEN cap <= level * weight THEN cap::DOUBLE
              ELSE (SELECT max(level) FROM l WHERE NOT cap <= level * weight) * weight END AS target,
         ('0x' || substr(md5('7:' || CASE WHEN no_source THEN 'true' ELSE 'false' END || ':' || src), 1, 4))::INT / 65536.0::DOUBLE AS u
  FROM l
), c AS (
  SELECT doc_id, size, source_size, target, rank, u,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
  FROM r JOIN t USING (no_source, src)
)
SELECT doc_id, size, source_size, target,
       (least(floor(rank * rate + u) - floor((rank - 1) * rate + u), 3) * size)::BIGINT AS taken
FROM c
"""


@query("op3_mix_sources", ORACLE)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
