"""Exact top-k search against brute force, its bounds, and its edge cases."""

from __future__ import annotations

import math

import numpy as np
import pytest
from millrace.llm.inner_product import Search, _ends, bounds, products, top_products

SCHEMA = "vec_id long, embedding array<float>, id string, score string, block string, shard string, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *"xxxxx") for i, v in rows], SCHEMA)


def by_force(rows, asked, k, scale=1024):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(scale * float(np.float32(x))) for x in v]
    rows = [(i, whole(v)) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, w in [(i, whole(v)) for i, v in asked if i is not None and usable(v)]:
        best = sorted((-sum(a * b for a, b in zip(w, v)), i) for i, v in rows if i != q)[:k]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(df):
    return sorted((r["query_id"], r["rank"], r["id"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("block, shard, query_block", [(4, 16, 3), (5, 40, 64), (256, 8192, 512)])
def test_against_brute_force(spark, block, shard, query_block):
    random = np.random.default_rng(11)
    rows = [(i, random.normal(0, 1, 6).astype(np.float32).tolist()) for i in range(220)]
    rows += [(300 + i, [1.0, 1.0, 1.0, 0.0, 0.0, 0.0]) for i in range(90)]  # ties, and a very common vector
    rows += [
        (500, None), (501, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (502, [float("nan")] * 6), (503, [float("-inf")] * 6),
        (504, []), (505, [3.0]), (506, [0.0] * 6), (507, [0.1] * 9), (None, [9.0] * 6), (508, [0.2] * 6), (508, [0.2] * 6),
    ]
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0 and r[0] < 500] + rows[-11:-2]
    df = vectors(spark, rows)
    got = found(top_products(df, vectors(spark, asked), k=7, block=block, shard=shard, query_block=query_block))
    assert got == by_force(rows, asked, 7)


def test_repeated_queries_have_ranks_of_their_own(spark):
    rows = [(i, [float(i), 1.0]) for i in range(6)]
    got = found(top_products(vectors(spark, rows), vectors(spark, [rows[2], rows[2]]), k=2))
    assert got == sorted(by_force(rows, [rows[2]], 2) * 2)


def test_few_candidates_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 4.0])]
    assert found(top_products(vectors(spark, rows), vectors(spark, rows))) == by_force(rows, rows, 10)
    for df, asked in (([], rows), (rows, []), ([], []), (rows[:1], rows[:1])):
        assert found(top_products(vectors(spark, df), vectors(spark, asked))) == []


def test_bounds_hold_and_prune():
    random = np.random.default_rng(1)
    middle = random.integers(-500, 500, (8, 5))
    whole = np.concatenate([m + random.integers(-20, 20, (32, 5)) for m in middle]).astype(np.int32)
    queries = random.integers(-400, 400, (20, 5)).astype(np.int32)
    high, low = _ends(whole, 32)
    bound, score = bounds(queries, high, low), products(queries, whole)
    for b in range(8):
        assert (score[:, b * 32 : (b + 1) * 32] <= bound[:, b : b + 1]).all()

    class Held:
        pass

    docs, asked = Held(), Held()
    docs.ids, docs.whole, docs.high, docs.low = np.arange(len(whole)), whole, high, low
    asked.ids, asked.whole = np.full(20, -1), queries
    search = Search(asked, 10, np.full(20, np.iinfo(np.int64).min))
    search.run(docs, 32)
    assert search.compared < score.size / 2
    for i in range(20):
        assert search.ids[i].tolist() == sorted(range(len(whole)), key=lambda j: (-score[i, j], j))[:10]  # noqa: B023


def test_products_are_exact_beyond_doubles_and_refuse_what_no_long_holds():
    a, b = np.array([[(1 << 30) + 1, 5]], np.int32), np.array([[(1 << 30) - 1, 7]], np.int32)
    assert products(a, b)[0, 0] == ((1 << 30) + 1) * ((1 << 30) - 1) + 35
    with pytest.raises(ValueError, match="do not fit"):
        products(np.full((1, 9), (1 << 31) - 1, np.int64), np.full((1, 9), (1 << 31) - 1, np.int64))


def test_a_component_too_large_is_an_error(spark):
    rows = [(1, [1e30]), (2, [1.0])]
    with pytest.raises(Exception, match="beyond"):
        top_products(vectors(spark, rows), vectors(spark, rows)).collect()
