"""Vectors in packed blocks, and pairing query blocks with candidate blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = "block long, dim int, ids binary, data binary, extra binary"


def valid_vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of doubles) for each length in a batch of (id, vector).

    Rows whose id or vector is null, or whose vector is empty or holds null or non-finite components, are left out.
    """
    ids, lists = batch.column(0), batch.column(1)
    n = batch.num_rows
    at = np.asarray(lists.offsets, dtype=np.int64)
    values = lists.values
    flat = np.asarray(values.cast(pa.float64()).fill_null(np.nan)) if len(values) else np.zeros(0)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    size = at[1:] - at[:-1]
    ok = (bad[at[1:]] == bad[at[:-1]]) & (size > 0)
    for column in (ids, lists):
        if column.null_count:
            ok &= np.asarray(column.is_valid())
    keys = np.asarray(ids.fill_null(0), dtype=np.int64) if n else np.zeros(0, np.int64)
    for dim in np.unique(size[ok]).tolist():
        rows = np.flatnonzero(ok & (size == dim))
        yield keys[rows], flat[at[rows][:, None] + np.arange(dim)]


def packed(
    vectors: DataFrame,
    per_block: int,
    id_col: str,
    vector_col: str,
    prepare: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, bytes]],
) -> DataFrame:
    """Blocks of up to ``per_block`` vectors of one length, each made within a task, without a shuffle.

    ``prepare(matrix)`` gives the order of rows in the block, the matrix to store and further bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 32

        def emit(ids: np.ndarray, matrix: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            order, stored, extra = prepare(matrix)
            number += 1
            row = [[number], [matrix.shape[1]], [ids[order].astype("<i8").tobytes()], [stored.astype("<f8").tobytes()], [extra]]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["block", "dim", "ids", "data", "extra"])

        for batch in batches:
            for ids, matrix in valid_vectors(batch):
                parts = waiting.setdefault(matrix.shape[1], [])
                parts.append((ids, matrix))
                if sum(len(i) for i, _ in parts) >= per_block:
                    ids, matrix = (np.concatenate(x) for x in zip(*parts, strict=True))
                    full = len(ids) // per_block * per_block
                    for k in range(0, full, per_block):
                        yield emit(ids[k : k + per_block], matrix[k : k + per_block])
                    waiting[matrix.shape[1]] = [(ids[full:], matrix[full:])] if full < len(ids) else []
        for parts in waiting.values():
            if parts:
                yield emit(*(np.concatenate(x) for x in zip(*parts, strict=True)))

    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col)).mapInArrow(run, BLOCK)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["data"], "<f8").reshape(len(ids), -1)


def search_blocks(queries: DataFrame, candidates: DataFrame, k: int, search: Callable[[dict, dict], Iterator[tuple]], score: str) -> DataFrame:
    """The ``k`` best of all candidates for each query: (query_id, rank, vec_id, score), ties to the smaller vec_id.

    A stated query set against all rows, in blocks: every query block meets every candidate block
    of its length once. Candidate blocks are dealt to as many seats as the shuffle has partitions and
    go there once; the few query blocks are copied to every seat. ``search(query_block, candidate_block)``
    yields (query ids, vec ids, scores) of each pair's best; they are merged with a limit before the shuffle. Nothing goes to the driver.
    """
    groups = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = {side: [F.col(c).alias(f"{side}_{c}") for c in ("ids", "data", "extra")] for side in "qc"}
    left = queries.select("dim", *sides["q"], F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("seat"))
    right = candidates.select("dim", *sides["c"], F.pmod(F.xxhash64("block"), F.lit(groups)).alias("seat"))
    pairs = left.join(right, ["seat", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                halves = ({c[2:]: v for c, v in row.items() if c.startswith(side)} for side in ("q_", "c_"))
                for query, vec, value in search(*halves):
                    yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(vec), pa.array(value)], ["query_id", "vec_id", "score"])

    found = pairs.drop("seat", "dim").mapInArrow(run, f"query_id long, vec_id long, score {score}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
