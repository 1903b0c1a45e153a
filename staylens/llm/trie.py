"""Prefix trie of conversations: identical ones collapse to one weighted sequence before prefixes are formed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import MOST_HOT, query, staged, table
from staylens.operators.joins import keyed_join
from staylens.operators.ranking import running_totals

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_IDS = 512
NODE = ["depth", "n1", "n2"]


def numbered_turns(
    conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, pos, k1, k2, words): turns in order, each as two 64-bit hashes of role and text, with its words.

    Order: turn (null first), then role, then the hashes; a null role or text is empty; rows
    without id belong to no conversation and are left out; repeated rows are turns of their own.
    Positions are running counts over sorted ranges, so a conversation of any length spans tasks.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        role.alias("role"),
        *[F.xxhash64(F.lit(lane), role, text).alias(f"k{lane}") for lane in (1, 2)],
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        F.lit(1).alias("one"),
    )
    placed = running_totals(turns, ["turn", "role", "k1", "k2"], ["one"], ["conv_id"])
    return staged(placed.select("conv_id", (F.col("before_one") + 1).alias("pos"), "k1", "k2", "words"), "turns")


def shared_heads(numbered: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``head`` turns (at most ``most``) come from the conversation ``base``.

    Both are expressions over ``conv_id``; a base may serve a bounded number of conversations. If it
    has fewer turns all are taken, if there is no such conversation none. Gives the ids, and the rebuilt turns (conv_id, depth, k1, k2, words).
    """
    sizes = numbered.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = sizes.withColumns({"base": base, "head": head})
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("head", F.coalesce("base_n", F.lit(0)))
    convs = staged(convs.join(bases, "base", "left").select("conv_id", "n", "base", "head", taken.alias("taken")), "conversations")
    starts = numbered.where(F.col("pos") <= most).select(F.col("conv_id").alias("base"), F.col("pos").alias("depth"), "k1", "k2", "words")
    heads = convs.where("taken > 0").join(starts, "base").where("depth <= taken").select("conv_id", "depth", "k1", "k2", "words")
    own = keyed_join(numbered, convs.where("n > head").select("conv_id", "n", "head", "taken"), ["conv_id"], "n", MOST_HOT)
    own = own.where("pos > head").select("conv_id", F.expr("pos - head + taken").alias("depth"), "k1", "k2", "words")
    return convs.select("conv_id"), staged(heads.unionByName(own), "rebuilt")


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """Each turn with the key of the prefix it ends (n1, n2), that of its parent (p1, p2), and the words before it.

    A key is the exclusive or of 128-bit hashes of (depth, turn): unlike a chain of hashes it is
    a running total, so that long conversations need not meet in one task.
    """
    lanes = {f"h{lane}": F.xxhash64(F.lit(lane), "depth", "k1", "k2") for lane in (1, 2)}
    running = running_totals(rebuilt.withColumns(lanes), "depth", ["words"], ["conv_id"], xors=list(lanes))
    keys = [F.expr(f"before_h{i} ^ h{i}").alias(f"n{i}") for i in (1, 2)] + [F.col(f"before_h{i}").alias(f"p{i}") for i in (1, 2)]
    return staged(running.select("conv_id", "depth", "words", F.col("before_words").alias("before"), *keys), "prefixes")


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 (``ends_sha256``) of the ascending decimal ids, comma-joined, of each sequence.

    Ids are sorted over ranges that also cut a hot sequence; each task joins what it has into
    chunks, and only chunks of a sequence are hashed one after another, as the digest demands.
    """
    spark, size = ends.sparkSession, CHUNK_IDS

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "first", "ids"]
        key, held = None, []

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, (*key, held[0], ",".join(map(str, held))), strict=True))])

        for batch in batches:
            for *now, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (now != key or len(held) >= size):
                    yield row()
                    held = []
                key = now
                held.append(conv)
        if held:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*NODE, "ends_sha256"]
        key, running = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, (*key, running.hexdigest()), strict=True))])

        for batch in batches:
            for *now, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    if key is not None:
                        yield row()
                    key, running = now, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(ids.encode())
        if key is not None:
            yield row()

    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = ends.select(*NODE, "conv_id").repartitionByRange(ranges, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    parts = placed.mapInArrow(chunks, "depth long, n1 long, n2 long, first long, ids string")
    dealt = parts.repartition(ranges, *NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
    return dealt.mapInArrow(digests, "depth long, n1 long, n2 long, ends_sha256 string")


def prefix_trie(convs: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """One row per distinct prefix (node) of the conversations in ``convs`` (conv_id; those without turns end at the root).

    ``rebuilt`` has their turns (conv_id, depth from 1, k1, k2, words). Gives conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256; without conversations no node.

    Identical conversations become one sequence with a weight, known by its smallest id. A sequence is a leaf
    unless it is a proper prefix of another. A node belongs to the sequence with the smallest id among those
    through it: such nodes are the tail of that sequence from some depth on, so sums over a subtree, counting
    each node once, come from running word sums of sequences alone, in one aggregate per node.
    """
    turns = prefixes(rebuilt)
    last = turns.groupBy("conv_id").agg(F.max_by(F.struct("depth", "n1", "n2", (F.col("before") + F.col("words")).alias("total")), "depth").alias("end"))
    zero = {c: F.coalesce(F.col(f"end.{c}").cast("long"), F.lit(0).cast("long")) for c in (*NODE, "total")}
    ends = staged(convs.join(last, "conv_id", "left").withColumns(zero).drop("end"), "ends")
    sequences = staged(
        ends.groupBy(F.col("depth").alias("length"), "n1", "n2").agg(
            F.count("*").alias("weight"), F.min("conv_id").alias("key"), F.max("total").alias("total")
        ),
        "sequences",
    )
    kept = sequences.where("length > 0").select(F.col("key").alias("conv_id"), "length", "weight", "total")
    paths = keyed_join(turns, kept, ["conv_id"], "length", MOST_HOT).withColumnRenamed("conv_id", "key")
    none = [F.lit(0).cast("long").alias(c) for c in ("depth", "words", "before", "n1", "n2", "p1", "p2")]
    paths = staged(paths.unionByName(sequences.select("key", "length", "weight", "total", *none)), "paths")

    inner = paths.where("depth < length").select(F.col("depth").alias("length"), "n1", "n2").distinct()
    leaves = sequences.join(inner, ["length", "n1", "n2"], "left_anti").select("key", F.lit(1).alias("leaf"))
    owners = paths.groupBy(*NODE).agg(F.min("key").alias("key"), F.max("before").alias("before"))
    owned = owners.groupBy("key").agg(F.min("depth").alias("from_depth"), F.min("before").alias("from_before"))
    facts = sequences.select("key", (F.col("length") + 1).alias("rows")).join(owned, "key", "left").join(leaves, "key", "left")
    marked = keyed_join(paths, staged(facts, "sequence-facts"), ["key"], "rows", MOST_HOT)

    owns_child = F.expr("coalesce(from_depth <= depth + 1 AND depth < length, false)").cast("long")
    once = F.when(F.col("from_depth").isNotNull(), F.col("total") - F.greatest("before", "from_before"))
    nodes = staged(
        marked.groupBy(*NODE, "p1", "p2").agg(
            F.min("key").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.sum(owns_child).alias("n_children"),
            F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
            (F.sum(F.col("weight") * (F.col("total") - F.col("before"))) - F.coalesce(F.sum(once), F.lit(0))).alias("saved_tokens"),
        ),
        "nodes",
    )
    parents = nodes.where("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_rows")
    )
    below = keyed_join(nodes.where("depth > 0"), staged(parents, "parents"), ["depth", "p1", "p2"], "_rows", MOST_HOT).drop("_rows")
    root = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    nothing = hashlib.sha256().hexdigest()
    whole = below.unionByName(root).join(ends_digest(ends), NODE, "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")
    )


GROUP, HEADS = 20, 4

ORACLE = f"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS words
  FROM conversations WHERE conv_id IS NOT NULL
),
own AS (
  SELECT conv_id, list(struct_pack(k := k, words := words) ORDER BY pos) AS turns,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
           lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
             lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)), 4294967295) % {HEADS} AS h
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % {GROUP}
),
keyed AS (SELECT conv_id, list_transform(turns, lambda t: t.k) AS path, list_transform(turns, lambda t: t.words) AS words FROM rebuilt),
steps AS (SELECT conv_id, path, words, unnest(range(0, len(path) + 1)) AS depth FROM keyed),
nodes AS MATERIALIZED (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(any_value(words[depth]), 0) AS last_words,
         sha256(coalesce(string_agg(CASE WHEN len(path) = depth THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM steps GROUP BY path[1:depth], depth
),
children AS (SELECT node[1:depth - 1] AS node, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS MATERIALIZED (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (node)),
above AS (
  SELECT node[1:up] AS node, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * last_words) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM counted) GROUP BY 1
)
SELECT c.conv_id, CAST(c.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(c.n_convs AS BIGINT) AS n_convs,
       CAST(c.n_children AS BIGINT) AS n_children, CAST(a.n_leaves AS BIGINT) AS n_leaves, CAST(a.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN above a ON a.node = c.node LEFT JOIN counted p ON c.depth > 0 AND p.node = c.node[1:c.depth - 1]
"""


@query("op12_prefix_trie", ORACLE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    convs, rebuilt = shared_heads(numbered_turns(table(spark, sf_dir, "conversations")), base, head, HEADS - 1)
    return prefix_trie(convs, rebuilt)
