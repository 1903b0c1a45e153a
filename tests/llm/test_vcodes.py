"""op13: codes by bounds against plain k-means over all distances."""

from __future__ import annotations

import math

import numpy as np
import pytest

from staylens.llm import vcodes

NAMES = "vec_id long, embedding array<double>, label string, code int, error int, ids int"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and len(r[1]) and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    ints = np.array([[math.floor(1024 * x) for x in r[1]] for r in kept]).reshape(len(kept), parts, -1)
    book = ints[:entries].transpose(1, 0, 2).copy()

    def own():
        d = ((ints[:, :, None, :] - book[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        a, _ = own()
        for p in range(parts):
            for e in set(a[:, p]):
                inside = ints[a[:, p] == e, p]
                book[p, e] = inside.sum(0) // len(inside)
    a, d = own()
    found = [(r[0], r[2], "".join(f"{x:02x}" for x in a[i]), int(d[i].sum())) for i, r in enumerate(kept)]
    return found, vcodes.codebooks_digest(book)


def same(spark, rows, **settings):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], NAMES).repartition(3)
    codes, book = vcodes.vector_codes(df, **settings)
    expected, digest = plain_codes(rows, **settings)
    assert sorted(map(str, (tuple(r) for r in codes.collect()))) == sorted(map(str, expected))
    assert vcodes.codebooks_digest(book) == digest


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_clustered_vectors(spark, monkeypatch, spread):
    """Clusters, equal vectors, and more vectors than a block holds."""
    monkeypatch.setattr(vcodes, "PER_BLOCK", 100)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 8))
    vectors = centres[rng.integers(0, 12, 900)] + spread * rng.normal(size=(900, 8))
    vectors[200:260] = vectors[3]
    same(spark, [(int(i), v.tolist(), f"l{i % 3}") for i, v in enumerate(vectors)], entries=32)


def test_ties_small_grids_and_large_numbers(spark):
    """Points of a grid tie with several entries; numbers beyond exact doubles take the integer way."""
    grid = [(i, [float(i % 3), float(i // 3 % 3), float(i // 9 % 3), float(i % 2)], None) for i in range(81)]
    same(spark, grid, parts=2, entries=9)
    wide = [(i, [100_000.0 * math.sin(7 * i), -90_000.0 * math.cos(i), i / 3, 1e-9], "a") for i in range(60)]
    same(spark, wide, parts=1, entries=7)


def test_rows_that_take_no_part(spark):
    rows = [
        (None, [0.5, 1.0], "a"),
        (1, None, "a"),
        (2, [], None),
        (3, [0.1, None], "a"),
        (4, [math.nan, 0.0], "a"),
        (5, [math.inf, 0.0], "b"),
        (6, [-0.25, 0.75], None),
        (6, [-0.25, 0.75], None),
        (7, [0.0, -0.0], "b"),
    ]
    same(spark, rows, parts=2, entries=4)


def test_no_vectors_and_wrong_lengths(spark):
    empty = spark.createDataFrame([(1, None, "a", 1, 2, 3)], NAMES)
    codes, book = vcodes.vector_codes(empty)
    assert codes.columns == ["id", "label", "code", "error"] and codes.count() == 0 and book.size == 0
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], "a", 1, 2, 3)], NAMES)
    with pytest.raises(ValueError, match="equal parts"):
        vcodes.vector_codes(odd)
    mixed = spark.createDataFrame([(1, [1.0, 2.0], "a", 1, 2, 3), (2, [1.0], "a", 1, 2, 3)], NAMES)
    assert [r["id"] for r in vcodes.vector_codes(mixed, parts=2)[0].collect()] == [1]


def test_bounds_skip_distances_and_hold(monkeypatch):
    """Each bound stays below the true distance, most rows need no full search, and the list shrinks to what is needed."""
    rng = np.random.default_rng(2)
    rows = rng.integers(-600, 600, (2_000, 16))
    rows[:1_500] = rows[rng.integers(1_500, 2_000, 1_500)] + rng.integers(-20, 20, (1_500, 16))
    entries = rows[1_500:1_564].copy()
    bounds = vcodes.nearest(rows, entries, 16)
    for _ in range(3):
        moved_to = entries + rng.integers(-8, 8, entries.shape)
        moved = np.sqrt(((moved_to - entries) ** 2).sum(1)) * (1 + 1e-12)
        entries = moved_to
        bounds, need = vcodes.renewed(rows, entries, moved, bounds, 16)
        true = np.sqrt(vcodes.distances(rows, entries).astype(float))
        assert (bounds.own == true.argmin(1)).all()
        assert (bounds.low <= np.take_along_axis(true, bounds.near, 1) + 1e-9).all()
        rest = true.copy()
        np.put_along_axis(rest, bounds.near, np.inf, 1)
        rest[np.arange(len(rows)), bounds.own] = np.inf
        assert (bounds.outer <= rest.min(1) + 1e-9).all()
        assert (need > 16).mean() < 0.3
    assert vcodes.adapted(np.array([50, 40, 9, 1, 0, 3]), 4) == 2
    assert vcodes.adapted(np.zeros(5, int), 4) == 4
