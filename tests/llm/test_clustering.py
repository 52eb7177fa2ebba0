"""Centroid clustering against brute force, and its order, boxes and edge cases."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from millrace.llm import clustering
from millrace.llm.clustering import candidates, cluster, hilbert_keys, nearest

SCHEMA = "vec_id long, embedding array<float>, key string, cluster_no string, whole string, total string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x", "x") for i, v in rows], SCHEMA)


def by_force(rows, k, rounds, scale, dims, seed="2:"):
    """(id, cluster, distance) of every vector, and the centroids."""
    kept = [
        (i, [math.floor(scale * float(np.float32(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    hashed = lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest(), np.array(r[1], np.int32).tobytes())
    centres = [v for _, v in sorted(kept, key=hashed)[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    place = lambda v: min((square(v, c), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        held = [place(v)[1] for _, v in kept]
        for n in range(len(centres)):
            own = [v for (_, v), h in zip(kept, held) if h == n]
            if own:
                centres[n] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, place(v)[1], place(v)[0]) for i, v in kept), key=str), centres


def test_hilbert_curve_visits_every_cell_by_single_steps():
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = [k.tobytes() for k in hilbert_keys(cells, bits)]
        order = cells[sorted(range(len(keys)), key=keys.__getitem__)]
        assert len(set(keys)) == len(cells)
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_candidates_hold_every_nearest_centroid_and_few_others():
    random = np.random.default_rng(3)
    centres = random.integers(-300, 300, (20, 4))
    few = 0
    for _ in range(50):
        whole = random.integers(-300, 300, 4) + random.integers(-15, 15, (30, 4))
        some = candidates(whole.min(axis=0), whole.max(axis=0), centres)
        every, square = nearest(whole.astype(np.int32), centres, np.arange(20))
        assert set(every.tolist()) <= set(some.tolist())
        again, same = nearest(whole.astype(np.int32), centres, some)
        assert (again == every).all() and (same == square).all()
        few += len(some) < 10
    assert few > 40


def test_distances_are_exact_beyond_doubles():
    whole = np.array([[(1 << 26) - 1, 3], [-(1 << 26), 1]], np.int32)
    centres = np.array([[-(1 << 26), 2], [-(1 << 26) + 1, 2]], np.int64)
    at, square = nearest(whole, centres, np.arange(2))
    want = [min(((int(a) - int(c)) ** 2 + (int(b) - int(d)) ** 2, n) for n, (c, d) in enumerate(centres)) for a, b in whole]
    assert list(zip(square.tolist(), at.tolist())) == want


@pytest.mark.parametrize("block", [7, 256])
def test_against_brute_force(spark, block):
    random = np.random.default_rng(5)
    middle = random.normal(0, 1, (6, 8))
    rows = [(i, (middle[i % 6] + random.normal(0, 0.05, 8)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # one vector held by a third of all rows
    rows += [
        (2000, None), (2001, [1.0] * 7), (2002, [1.0] * 7 + [None]), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8),
        (2005, []), (2006, [0.0] * 8), (2006, [0.0] * 8), (2006, [0.5] * 8), (None, [0.25] * 8), (None, None),
    ]
    found = cluster(vectors(spark, rows), centroids=9, rounds=4, scale=100, dimensions=8, block=block).collect()
    want, centres = by_force(rows, 9, 4, 100, 8)
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in found), key=str) == want
    for r in found:
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        assert r["inertia"] == sum(d for _, _, d in want)
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 5.0])]
    found = cluster(vectors(spark, rows), dimensions=2).collect()
    assert sorted((r["vec_id"], r["distance"]) for r in found) == [(1, 0), (2, 0)]
    assert {r["cluster"] for r in found} == {0, 1}
    for none in ([], [(1, None)], [(1, [1.0])]):
        df = cluster(vectors(spark, none), dimensions=2)
        assert df.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
        assert df.count() == 0


def test_a_component_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        cluster(vectors(spark, [(1, [1e30, 0.0])]), dimensions=2).collect()


def test_ids_may_be_text(spark):
    df = spark.createDataFrame([("a", [0.0, 1.0]), ("b", [2.0, 2.0])], "name string, place array<double>")
    found = cluster(df, "name", "place", dimensions=2)
    assert found.dtypes[0] == ("name", "string") and found.count() == 2


def test_blocks_with_one_candidate_are_not_read(spark, monkeypatch):
    """Their stored sums are what their vectors would give."""
    whole = np.array([[1, 2], [3, 5]], np.int32)
    import pyarrow as pa

    cell = lambda a: pa.array([a.tobytes()], pa.binary())
    batch = pa.RecordBatch.from_arrays(
        [cell(np.empty(0, np.int32)), cell(whole.min(0)), cell(whole.max(0)), cell(whole.sum(0, dtype=np.int64)), pa.array([2], pa.int64())],
        ["whole", "low", "high", "total", "members"],
    )
    (out,) = clustering._totals(np.array([[0, 0], [900, 900]]))(iter([batch]))
    assert list(zip(*(c.to_pylist() for c in out.columns))) == [(0, 0, 4), (0, 1, 7), (0, 2, 2)]
