"""Approximate nearest neighbours: low-dimensional stable projections, kd-trees and a chi-square stopping test."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from staylens.llm.base import query, table
from staylens.llm.texts import gather
from staylens.llm.vectors import packed, search_blocks, unpacked

CANDIDATES, QUERIES, LEAF = 8192, 512, 32
PROJECTED = 8
RATIO = 1.6


def projection(dim: int, seed: int) -> np.ndarray:
    """Gaussian (2-stable) directions for vectors of ``dim`` components and one more."""
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, PROJECTED))


def leaves_of(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """kd-tree by median cuts of the widest axis: rows in leaf order, and where each leaf starts (with the end)."""
    order, starts, todo = [], [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        spread = np.ptp(points[rows], axis=0) if len(rows) else np.zeros(1)
        if len(rows) <= LEAF or not spread.max() > 0:
            starts.append(len(rows))
            order.append(rows)
            continue
        axis, half = int(spread.argmax()), len(rows) // 2
        rows = rows[np.argpartition(points[rows, axis], half)]
        todo += [rows[half:], rows[:half]]
    return np.concatenate(order), np.concatenate(([0], np.cumsum(starts)))


def chi_square_cdf(x: np.ndarray) -> np.ndarray:
    """Distribution function for ``PROJECTED`` (an even number of) degrees of freedom."""
    half = np.minimum(x / 2, 700)
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(PROJECTED // 2))


def build_index(vectors: DataFrame, *, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Every vector in blocks of up to ``CANDIDATES``, each with the kd-tree of its projections.

    Largest inner product becomes nearest distance by one more component, sqrt(M^2 - |v|^2) with M
    the longest vector of the block. The rows of a block lie in leaf order; the tree is kept as
    leaf starts and the leaves' boxes of projected values.
    """

    def prepare(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        square = (matrix * matrix).sum(1)
        most = square.max()
        longer = np.hstack((matrix, np.sqrt(np.maximum(most - square, 0))[:, None]))
        points = longer @ projection(matrix.shape[1], seed)
        order, at = leaves_of(points)
        low, high = (f.reduceat(points[order], at[:-1], axis=0) for f in (np.minimum, np.maximum))
        return order, matrix[order], np.concatenate(([most, len(at) - 1], at, low.ravel(), high.ravel())).astype("<f8").tobytes()

    return packed(vectors, CANDIDATES, id_col, vector_col, prepare)


def nearest(queries: DataFrame, index: DataFrame, k: int, *, stop: float = 0.9, ratio: float = RATIO, seed: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Each query's ``k`` largest inner products found: (query_id, rank, vec_id, score in doubles).

    In every block the leaves are visited in order of their projected distance from the query and their
    vectors verified. A neighbour at distance d is projected to within r with probability
    chi2(r^2 / d^2), so the search of a block ends when that is at least ``stop`` for the next leaf's r
    and d the k-th distance found divided by ``ratio``: each vector nearer than that has been seen with at least that
    probability. With a ratio of 1 all true neighbours are held to it, and nearly every leaf is visited.

    Null, empty, zero or non-finite vectors and null ids take no part; a query never finds rows of
    its own vec_id; repeated rows are found each; vectors of different lengths do not meet;
    either table empty gives an empty result; further columns are ignored.
    """

    def as_is(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, bytes]:
        return np.arange(len(matrix)), matrix, b""

    def search(q: dict, c: dict) -> Iterator[tuple]:
        (q_ids, q_points), (c_ids, c_points) = unpacked(q), unpacked(c)
        extra = np.frombuffer(c["extra"], "<f8")
        most, leaves = extra[0], int(extra[1])
        at = extra[2 : 3 + leaves].astype(np.int64)
        size, every = np.diff(at), np.arange(len(c_ids))
        low, high = extra[3 + leaves :].reshape(2, leaves, PROJECTED)
        live, zero = (c_points != 0).any(1), ~(q_points != 0).any(1)
        placed = np.hstack((q_points, np.zeros((len(q_points), 1)))) @ projection(q_points.shape[1], seed)
        for i in np.flatnonzero(~zero):
            gap = np.maximum(np.maximum(low - placed[i], placed[i] - high), 0)
            far = (gap * gap).sum(1)
            visit = np.argsort(far, kind="stable")
            square = q_points[i] @ q_points[i]
            best_ids, best, step, seen = np.zeros(0, np.int64), np.zeros(0), 16, 0
            while seen < leaves:
                if len(best) == k:
                    d = max(square + most - 2 * best[-1], 0)
                    if d == 0 and far[visit[seen]] > 0 or d > 0 and chi_square_cdf(ratio * ratio * far[visit[seen]] / d) >= stop:
                        break
                some = visit[seen : seen + step]
                rows = gather(every, at[some], size[some])
                score = c_points[rows] @ q_points[i]
                good = live[rows] & (c_ids[rows] != q_ids[i])
                if len(best) == k:
                    good &= score >= best[-1]
                ids, score = np.append(best_ids, c_ids[rows[good]]), np.append(best, score[good])
                keep = np.lexsort((ids, -score))[:k]
                best_ids, best, seen = ids[keep], score[keep], seen + step
            yield np.full(len(best_ids), q_ids[i]), best_ids, best

    return search_blocks(packed(queries, QUERIES, id_col, vector_col, as_is), index, k, search, "double")


@query("op5_nearest")
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors.where("vec_id % 20 = 0"), build_index(vectors), 20)
