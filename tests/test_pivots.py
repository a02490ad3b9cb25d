"""Nearest vectors by pivots against all pairs."""

import tracemalloc

import numpy as np
import pytest

from quillon.operators import pivots, vectors

SCHEMA = "name bigint, vector array<double>"


def brute(queries, vectors, k):
    """Rounded cosines of all pairs, in the order of the operator."""
    found = []
    for q, a in queries:
        near = []
        for v, b in vectors:
            if v != q:
                a1, b1 = np.array(a) / np.linalg.norm(a), np.array(b) / np.linalg.norm(b)
                near.append((-round(float(a1 @ b1), 6), v))
        found += [(q, v, -s, i + 1) for i, (s, v) in enumerate(sorted(near)[:k])]
    return sorted(found)


def rows(df):
    return sorted((r["term"], r["neighbour"], r["similarity"], r["rank"]) for r in df.collect())


def same(found, wanted):
    assert [(r[0], r[1], r[3]) for r in found] == [(r[0], r[1], r[3]) for r in wanted]
    assert np.allclose([r[2] for r in found], [r[2] for r in wanted], atol=2e-6)


def clustered(n, centres, size=16, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, size))
    return [(i, (middle[i % centres] + rng.normal(size=size) * 0.05).tolist()) for i in range(n)]


@pytest.mark.parametrize("shape", ["clustered", "scattered", "hot"])
def test_equals_all_pairs(frame, shape):
    if shape == "scattered":
        data = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(2).normal(size=(300, 8)))]
    else:
        data = clustered(300, 12)
    if shape == "hot":
        # A third of the rows are one vector, and there are scaled and opposite ones.
        data += [(1000 + i, data[0][1]) for i in range(150)]
        data += [(2000, [2 * x for x in data[0][1]]), (2001, [-x for x in data[0][1]])]
    df = frame(data, SCHEMA)
    same(rows(pivots.nearest_by_pivots(df, df, 3, cell_rows=40)), brute(data, data, 3))


def test_cells_are_skipped(frame):
    data = clustered(400, 20)
    df = frame(data, SCHEMA)
    visited, all_pairs = pivots.visits(df, df, 3, cell_rows=50)
    assert all_pairs >= 400 * 20 and visited < all_pairs / 4


def test_unusable_vectors_few_rows_and_other_columns(frame):
    data = [(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 0.0]), (7, [1.0, 1.0]), (None, [1.0, 1.0]), (8, [])]
    wide = [(*row, 1, "x") for row in data]
    df = frame(wide, SCHEMA + ", cell int, pivot string")
    good = [data[0], data[6]]
    same(rows(pivots.nearest_by_pivots(df, df, 3)), brute(good, good, 3))
    none = frame([], SCHEMA)
    assert rows(pivots.nearest_by_pivots(df, none)) == []
    assert rows(pivots.nearest_by_pivots(none, df)) == []


def test_other_queries_and_text_names(frame):
    data = [(f"w{i}", v) for i, v in clustered(100, 5)]
    asked = [("new", data[3][1]), ("w7", data[7][1])]
    schema = "name string, vector array<double>"
    found = pivots.nearest_by_pivots(frame(asked, schema), frame(data, schema), 4, pivots=7, cell_rows=9)
    same(rows(found), brute(asked, data, 4))


def test_memory_of_a_block_does_not_grow_with_its_pairs():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(4096, 4)), rng.normal(size=(4096, 4))
    whole = vectors._best_of(np.arange(50), a[:50], np.arange(4096), b, 3)
    tracemalloc.start()
    found = vectors._nearest_of(np.arange(4096), a, np.arange(4096), b, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and len(found) == 3 * 4096
    assert found.head(150).equals(whole)
    none = vectors._nearest_of(np.arange(0), a[:0], np.arange(4096), b, 3)
    assert list(none.columns) == list(whole.columns) and not len(none)


@pytest.mark.parametrize("slab_rows", [1, 60, 10_000])
def test_vectors_are_not_sent_with_every_visit(frame, monkeypatch, slab_rows):
    sizes, stored = {}, pivots.stored

    def kept(df, name):
        out = stored(df, name)
        sizes[name] = out.count() if "vector" in out.columns else 0
        return out

    monkeypatch.setattr(pivots, "stored", kept)
    monkeypatch.setattr(pivots, "SLAB_ROWS", slab_rows)
    data = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(5).normal(size=(200, 8)))]
    df = frame(data, SCHEMA)
    same(rows(pivots.nearest_by_pivots(df, df, 3, cell_rows=20)), brute(data, data, 3))
    assert max(sizes.values()) == 200
