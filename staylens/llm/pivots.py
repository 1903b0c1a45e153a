"""Exact top-k inner products by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.llm.base import query, table
from staylens.llm.vectors import packed, search_blocks, unpacked

CANDIDATES, QUERIES = 4096, 512


def choose_pivots(vectors: DataFrame, pivots: int, sample: int, id_col: str, vector_col: str) -> dict[int, np.ndarray]:
    """For each vector length, pivots far from each other, out of ``sample`` rows with the smallest hashed ids.

    Pivots decide how much is skipped, never what is found; a length without pivots is searched in full.
    """
    rows = (
        vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull())
        .select(F.xxhash64(id_col).alias("h"), id_col, F.col(vector_col).cast("array<double>").alias("v"))
        .orderBy("h", id_col)
        .limit(sample)
        .collect()
    )
    by_dim: dict[int, list] = {}
    for row in rows:
        if row["v"] and all(x is not None and np.isfinite(x) for x in row["v"]):
            by_dim.setdefault(len(row["v"]), []).append(row["v"])
    chosen = {}
    for dim, values in by_dim.items():
        points = np.floor(1024 * np.array(values))
        picked, far = [0], np.linalg.norm(points - points[0], axis=1)
        while len(picked) < pivots and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(points - points[picked[-1]], axis=1))
        chosen[dim] = points[picked]
    return chosen


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(points - p, axis=1) for p in pivots], axis=1)


def top_k(queries: DataFrame, candidates: DataFrame, k: int, *, pivots: int = 32, sample: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` highest integer inner products: (query_id, rank, vec_id, score).

    Components x count as floor(1024 * x). A block of candidates carries its table of distances
    to the pivots. For a query, the largest difference |d(q, p) - d(v, p)| over the pivots bounds
    d(q, v) from below and so q.v = (|q|^2 + |v|^2 - d^2) / 2 from above. Candidates are evaluated in order
    of that bound, and the search ends once the k-th score found is above the next bound; equal
    bounds are still evaluated, so ties go to the smaller vec_id exactly.

    Null, empty or non-finite vectors and null ids take no part; a query never finds rows of its
    own vec_id; repeated rows are found each; vectors of different lengths do not meet; either
    table empty gives an empty result; further columns are ignored.
    """
    table_of = choose_pivots(candidates, pivots, sample, id_col, vector_col)

    def prepare(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        points = np.floor(1024 * matrix)
        known = table_of.get(points.shape[1])
        extra = b"" if known is None else distances(points, known).astype("<f8").tobytes()
        return np.arange(len(points)), points, extra

    def search(q: dict, c: dict) -> Iterator[tuple]:
        (q_ids, q_points), (c_ids, c_points) = unpacked(q), unpacked(c)
        tabled = bool(q["extra"]) and bool(c["extra"])
        c_square = (c_points * c_points).sum(1)
        if tabled:
            q_table = np.frombuffer(q["extra"], "<f8").reshape(len(q_ids), -1)
            c_table = np.ascontiguousarray(np.frombuffer(c["extra"], "<f8").reshape(len(c_ids), -1).T)
        for i, point in enumerate(q_points):
            square = point @ point
            if tabled:
                low = np.zeros(len(c_ids))
                for p in range(len(c_table)):
                    np.maximum(low, np.abs(c_table[p] - q_table[i, p]), out=low)
                low = np.maximum(low - 1e-6 * (1 + low), 0)  # the distances are rounded
                bound = (square + c_square - low * low) / 2 * (1 + 1e-12) + 1e-6
            else:
                bound = np.full(len(c_ids), np.inf)
            order = np.argsort(-bound)
            order = order[c_ids[order] != q_ids[i]]
            best_ids, best, step, at = np.zeros(0, np.int64), np.zeros(0), 64, 0
            while at < len(order) and not (len(best) == k and bound[order[at]] < best[-1]):
                some = order[at : at + step]
                ids, score = np.append(best_ids, c_ids[some]), np.append(best, c_points[some] @ point)
                keep = np.lexsort((ids, -score))[:k]
                best_ids, best = ids[keep], score[keep]
                at, step = at + step, step * 2
            yield np.full(len(best_ids), q_ids[i]), best_ids, best.astype(np.int64)

    blocks = packed(candidates, CANDIDATES, id_col, vector_col, prepare)
    return search_blocks(packed(queries, QUERIES, id_col, vector_col, prepare), blocks, k, search, "long")


@query(
    "op2_exact_top_k",
    """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings WHERE embedding IS NOT NULL
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY rank <= 10
""",
)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)
