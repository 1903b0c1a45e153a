"""Product codes of integer vectors; k-means rounds skip distances by adaptive lower bounds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from staylens.llm.base import dropped, query, staged, table
from staylens.operators.joins import keyed_join

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
PER_BLOCK = 1024
FIRST_BOUNDS, LEAST_BOUNDS = 16, 2
PAIRS = 1 << 16
LARGEST = 1 << 27  # beyond, summed squared distances may not fit 64 bits


@dataclass(frozen=True)
class Bounds:
    """What is known of the parts of a block in one position: ``own`` is the nearest entry, ``near`` the next closest
    ones, ``low`` their lower bounds in ascending order, ``outer`` a lower bound for all entries left."""

    own: np.ndarray
    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries."""
    largest = max(int(np.abs(rows).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if largest * largest * 4 * rows.shape[1] < 1 << 53:  # every intermediate is an exact double
        a, b = rows.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((rows - entry) ** 2).sum(1) for entry in entries], axis=1)


def below(squared: np.ndarray) -> np.ndarray:
    """Lower bounds of the square roots."""
    return np.maximum(np.sqrt(squared.astype(np.float64)) * (1 - 1e-12), 0)


def stored(low: np.ndarray) -> np.ndarray:
    """Rounded down to single precision."""
    small = low.astype(np.float32)
    return np.where(small > low, np.nextafter(small, np.float32(-np.inf)), small)


def nearest(rows: np.ndarray, entries: np.ndarray, b: int) -> Bounds:
    """Every distance; ties go to the lower entry. Lists the ``b`` next closest entries."""
    d = distances(rows, entries)
    own = d.argmin(1)
    at = np.arange(len(rows))
    d[at, own] = np.iinfo(np.int64).max
    b = min(b, len(entries) - 1)
    if b < len(entries) - 1:
        near = np.argpartition(d, b, axis=1)[:, : b + 1]
    else:
        near = np.broadcast_to(np.arange(len(entries)), d.shape)
    near = np.take_along_axis(near, np.take_along_axis(d, near, 1).argsort(1, kind="stable"), 1)
    low = below(np.take_along_axis(d, near, 1))
    if b < len(entries) - 1:
        outer = low[:, b]
    else:
        outer = np.full(len(rows), np.inf)
    return Bounds(own, near[:, :b], low[:, :b], outer)


def renewed(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, old: Bounds, b: int) -> tuple[Bounds, np.ndarray]:
    """The nearest entries after entry e has moved by at most ``moved[e]``, and how many listed entries each row needed (one more than it has: all entries).

    A bound falls by its entry's move, the outer one by the largest move. An entry counts only if its
    bound, and with the order every bound after it, does not exceed the distance to the row's own
    entry: those are compared by exact integer distances. Where the outer bound does not, all entries are.
    """
    low = np.maximum(old.low - moved[old.near], 0)
    outer = np.maximum(old.outer - moved.max(initial=0), 0)
    if low.shape[1] > b:
        outer = np.minimum(outer, low[:, b:].min(1))
    near, low = old.near[:, :b].copy(), low[:, :b]
    ordered = np.minimum.accumulate(np.concatenate((low, outer[:, None]), 1)[:, ::-1], 1)[:, ::-1]
    own = old.own.copy()
    exact = ((rows - entries[own]) ** 2).sum(1)
    reach = np.sqrt(exact.astype(np.float64)) * (1 + 1e-12)
    need = (ordered <= reach[:, None]).sum(1)
    low = low.copy()

    some = np.flatnonzero((need > 0) & (need <= low.shape[1]))
    step = max(1, PAIRS // max(1, low.shape[1]))
    for k in range(0, len(some), step):
        r = some[k : k + step]
        asked = np.arange(low.shape[1]) < need[r, None]
        which, column = np.nonzero(asked)
        d = np.full(asked.shape, np.iinfo(np.int64).max)
        d[which, column] = ((rows[r[which]] - entries[near[r[which], column]]) ** 2).sum(1)
        closest = d.min(1)
        # The lowest entry among the closest listed ones.
        first = np.where(d == closest[:, None], near[r], len(entries)).argmin(1)
        at = np.arange(len(r))
        other = near[r, first]
        swap = (closest < exact[r]) | ((closest == exact[r]) & (other < own[r]))
        near[r[swap], first[swap]] = own[r][swap]
        d[at[swap], first[swap]] = exact[r][swap]
        own[r[swap]] = other[swap]
        verified = np.where(asked, below(np.where(asked, d, 0)), low[r])
        order = verified.argsort(1, kind="stable")
        near[r] = np.take_along_axis(near[r], order, 1)
        low[r] = np.take_along_axis(verified, order, 1)
    every = np.flatnonzero(need > low.shape[1])
    if len(every):
        fresh = nearest(rows[every], entries, low.shape[1])
        own[every], near[every], low[every], outer[every] = fresh.own, fresh.near, fresh.low, fresh.outer
    return Bounds(own, near, low, outer), need


def finite(vector: Column) -> Column:
    """Whether a vector has components, all of them finite."""
    plain = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & plain, F.lit(False))


def blocks(vectors: DataFrame, dim: int) -> DataFrame:
    """Blocks of up to ``PER_BLOCK`` rows (ids, labels, ints), each made within a task, without a shuffle."""
    label = vectors.schema["label"].dataType
    schema = T.StructType(
        [
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("labels", T.ArrayType(label)),
            T.StructField("ints", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PER_BLOCK):
                part = batch.slice(at, PER_BLOCK)
                flat = part.column(2).flatten().to_numpy(zero_copy_only=False)
                ints = np.floor(flat * SCALE)
                if len(ints) and np.abs(ints).max() > LARGEST:
                    raise ValueError(f"components beyond {LARGEST // SCALE} give distances beyond 64 bits")
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(i).cast(arrow.field(i).type.value_type)).cast(arrow.field(i).type)
                    for i in (0, 1)
                ]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([ints.astype("<i4").tobytes()], pa.binary())], names=arrow.names)

    return vectors.where(F.size("vector") == dim).select("id", "label", F.col("vector").cast("array<double>")).mapInArrow(run, schema)


def assigned(state: DataFrame, entries: np.ndarray, moved: np.ndarray | None, b: int) -> DataFrame:
    """Every block with its nearest entries and bounds, and one row a task with its sums.

    ``sums`` holds, for part and entry, the components' sums and the number of parts; then, for a
    later round, how many parts needed 0, 1, ... listed entries.
    """
    parts, size, dim = entries.shape
    shared = state.sparkSession.sparkContext.broadcast((entries, moved))
    keep = [f for f in state.schema.fields if f.name in ("ids", "labels", "ints")]
    bounds = [T.StructField(c, T.BinaryType()) for c in ("own", "near", "low", "outer")]
    schema = T.StructType([*keep, *bounds, T.StructField("listed", T.IntegerType()), T.StructField("sums", T.ArrayType(T.LongType()))])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, moved = shared.value
        sums = np.zeros((parts, size, dim + 1), np.int64)
        needs = np.zeros(ENTRIES + 1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                cells = {c: row.column(c)[0].as_py() for c in row.schema.names if c not in ("ids", "labels")}
                rows = np.frombuffer(cells["ints"], "<i4").reshape(-1, parts, dim).astype(np.int64)
                n, found = len(rows), []
                for p in range(parts):
                    if moved is None:
                        found.append(nearest(rows[:, p], entries[p], b))
                    else:
                        width = cells["listed"]
                        old = Bounds(
                            np.frombuffer(cells["own"], np.uint8).reshape(parts, n)[p].astype(np.int64),
                            np.frombuffer(cells["near"], np.uint8).reshape(parts, n, width)[p].astype(np.int64),
                            np.frombuffer(cells["low"], "<f4").reshape(parts, n, width)[p].astype(np.float64),
                            np.frombuffer(cells["outer"], "<f4").reshape(parts, n)[p].astype(np.float64),
                        )
                        bound, need = renewed(rows[:, p], entries[p], moved[p], old, b)
                        needs[: need.max() + 1] += np.bincount(need)
                        found.append(bound)
                    own = found[p].own
                    place = own[:, None] * dim + np.arange(dim)
                    # Sums of at most a block of 28-bit numbers are exact doubles.
                    sums[p, :, :dim] += np.bincount(place.ravel(), rows[:, p].ravel(), size * dim).astype(np.int64).reshape(size, dim)
                    sums[p, :, dim] += np.bincount(own, minlength=size)
                binary = [
                    np.stack([f.own for f in found]).astype(np.uint8),
                    np.stack([f.near for f in found]).astype(np.uint8),
                    stored(np.stack([f.low for f in found])),
                    stored(np.stack([f.outer for f in found])),
                ]
                out = [row.column(c) for c in names] + [pa.array([x.tobytes()], pa.binary()) for x in binary]
                out += [pa.array([found[0].near.shape[1]], pa.int32()), pa.nulls(1, arrow.field("sums").type)]
                yield pa.RecordBatch.from_arrays(out, schema=arrow)
        empty = [pa.nulls(1, f.type) for f in arrow][:-1]
        total = np.concatenate((sums.ravel(), needs)).tolist()
        yield pa.RecordBatch.from_arrays([*empty, pa.array([total], arrow.field("sums").type)], schema=arrow)

    return state.mapInArrow(run, schema)


def totals(state: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Component sums, counts and needs over all tasks: as many numbers as the codebooks have, whatever the data."""
    parts, size, dim = shape
    rows = state.where("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("n")).collect()
    flat = np.zeros(parts * size * (dim + 1) + ENTRIES + 1, np.int64)
    for pos, n in rows:
        flat[pos] = n
    sums = flat[: -(ENTRIES + 1)].reshape(parts, size, dim + 1)
    return sums[..., :dim], sums[..., dim], flat[-(ENTRIES + 1) :]


def adapted(needs: np.ndarray, b: int) -> int:
    """The fewest listed entries that would have been enough for 99 % of the parts for which the list was; never more than before."""
    enough = needs[: b + 1]
    if not enough.sum():
        return b
    quantile = int(np.searchsorted(np.cumsum(enough), 0.99 * enough.sum()))
    return min(b, max(LEAST_BOUNDS, quantile))


def vector_codes(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) per kept vector, and the codebooks (part, entry, component).

    Components x become floor(1024 x); vectors are cut into ``parts`` equal parts. The codebooks start as the
    parts of the vectors with the ``entries`` (at most 256) smallest ids, null last, equal ids by components, and
    move to the floored means of their parts in each round; entries without parts stay. Ties go to the lower entry.

    Vectors that are null, empty, or hold null or non-finite components take no part, nor do those of another
    length than the one with the smallest id; that length must be divisible. Repeated rows count each; a null id or
    label is a value. Components beyond 131,072 end the job, as errors would not fit. Without vectors the result is empty.

    A round reads what the round before wrote: per part its entry, the closest other entries with lower bounds, and one
    bound for the rest. Bounds fall by how far entries moved; only entries whose bound is not beyond the
    distance to the own entry are compared, exactly. The list starts at 16 entries, not a quarter of all, as it
    is written each round, and shrinks to what the parts needed. A round's table is deleted once the next is written.
    """
    if not 0 < entries <= ENTRIES:
        raise ValueError(f"entries must be in 1 .. {ENTRIES}")
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector")).where(finite(F.col("vector")))
    wide = kept.select("id", F.col("vector").cast("array<double>").alias("vector"))
    first = wide.orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).select(F.size("vector")).collect()
    label = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", kept.schema["label"].dataType)])
    result = T.StructType([*label.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], result), np.zeros((parts, 0, 0), np.int64)
    length = first[0][0]
    if length % parts:
        raise ValueError(f"vectors of {length} components do not cut into {parts} equal parts")
    dim = length // parts
    seeds = wide.where(F.size("vector") == length).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    book = np.floor(np.array([r["vector"] for r in seeds]) * SCALE).astype(np.int64).reshape(-1, parts, dim).transpose(1, 0, 2)

    state, moved, b = staged(blocks(kept, length), "vector-blocks"), None, FIRST_BOUNDS
    for turn in range(rounds + 1):
        written = staged(assigned(state, book, moved, b), "vector-bounds")
        dropped(state)
        state = written.where("sums IS NULL")
        if turn == rounds:
            break
        sums, counts, needs = totals(written, book.shape)
        b = b if moved is None else adapted(needs, b)
        old, book = book, np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], book)
        moved = np.sqrt(((book - old) ** 2).sum(2).astype(np.float64)) * (1 + 1e-12)
    shared = vectors.sparkSession.sparkContext.broadcast(book)
    arrow = to_arrow_schema(result)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = shared.value
        at = np.arange(parts)
        for batch in batches:
            for i in range(batch.num_rows):
                ints = np.frombuffer(batch.column("ints")[i].as_py(), "<i4").reshape(-1, parts, dim).astype(np.int64)
                own = np.frombuffer(batch.column("own")[i].as_py(), np.uint8).reshape(parts, -1).T
                error = ((ints - book[at, own]) ** 2).sum((1, 2))
                code = [bytes(c).hex() for c in np.ascontiguousarray(own)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[i].values, batch.column("labels")[i].values, pa.array(code, pa.string()), pa.array(error)], schema=arrow
                )

    return state.select("ids", "labels", "ints", "own").mapInArrow(rows_of, result), book


def codebooks_digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def _oracle() -> str:
    dims = range(1, 65)
    size = 64 // PARTS
    steps = [
        f"""kept AS (SELECT vec_id, label, embedding FROM embeddings WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        ranked AS (SELECT *, row_number() OVER (ORDER BY vec_id, embedding) AS r FROM kept),
        ints AS MATERIALIZED (SELECT r, vec_id, label, part, list_transform(embedding[part * {size} + 1:part * {size} + {size}],
              lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM ranked, range({PARTS}) t(part)),
        book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM ints WHERE r <= {ENTRIES})"""
    ]
    terms = " + ".join(f"(i.v[{k}] - b.v[{k}]) * (i.v[{k}] - b.v[{k}])" for k in dims if k <= size)
    for n in range(ROUNDS + 1):
        steps.append(
            f"""own{n} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
              SELECT i.r, i.part, b.entry, {terms} AS d FROM ints i JOIN book{n} b ON i.part = b.part) GROUP BY r, part)"""
        )
        if n < ROUNDS:
            means = ", ".join(f"CAST(sum(v[{k}]) // count(*) - CASE WHEN sum(v[{k}]) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT)" for k in dims if k <= size)
            steps.append(
                f"""book{n + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, b.v) AS v FROM book{n} b LEFT JOIN (
                  SELECT part, entry, [{means}] AS v FROM own{n} JOIN ints USING (r, part) GROUP BY part, entry) m USING (part, entry))"""
            )
    return f"""WITH {", ".join(steps)},
    codes AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
      FROM own{ROUNDS} JOIN ints USING (r, part) GROUP BY r, vec_id, label)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
      (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS}) AS codebooks_sha256 FROM codes"""


ORACLE = _oracle()


@query("op13_vector_codes", ORACLE)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, book = vector_codes(table(spark, sf_dir, "embeddings"))
    rows = staged(codes.withColumnRenamed("id", "vec_id"), "vector-codes")
    sums = staged(rows.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")), "label-errors")
    joined = keyed_join(rows, sums, ["label"], "_rows")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(codebooks_digest(book)).alias("codebooks_sha256"))
