"""Exact, near-duplicate and line dedup against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from millrace.llm import setsketch
from millrace.llm.common import Scratch
from millrace.llm.exact_dedup import exact_dedup, merge_counters
from millrace.llm.graph import connected_components
from millrace.llm.line_dedup import _points, _shared_keys, drop_repeated_lines, near_lines, segment_keys, within
from millrace.llm.queries import QUERIES
from millrace.llm.setsketch import estimate, forest, merged, near_duplicates, registers, set_links

from .support import components, documents, documents_of, edge_rows, edit_distance

# -- exact -----------------------------------------------------------------------------


def test_exact_edges(spark):
    rows = edge_rows()
    got = exact_dedup(documents(spark, rows)).collect()
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for doc, text in rows:
        groups.setdefault(normal(text), []).append(doc)
    want = []
    for doc, text in rows:
        ids = groups[normal(text)]
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(normal(text).encode()).hexdigest()
        want.append((doc, keep, len(ids), doc == keep, digest))
    order = lambda r: (r[4], r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=order) == sorted(want, key=order)


def test_exact_with_every_digest_hot_or_none(spark):
    rows = [(i, f"text {i % 7}") for i in range(700)] + [(1000 + i, "hot") for i in range(400)]
    results = [
        {tuple(r) for r in exact_dedup(documents(spark, rows), hot_share=share, counters=n).collect()}
        for share, n in ((0.9, 5), (0.2, 50), (1 / 512, 2047))
    ]
    assert results[0] == results[1] == results[2] and len(results[0]) == 1100


def test_exact_empty(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


def test_misra_gries_error_is_bounded():
    random.seed(1)
    stream = [random.choice("abc") if random.random() < 0.6 else str(random.random()) for _ in range(6000)]
    held = pd.Series(dtype="int64")
    for at in range(0, len(stream), 500):
        held = merge_counters(held, pd.Series(stream[at : at + 500]).value_counts(), 20)
    assert len(held) <= 20
    for item in "abc":
        true = stream.count(item)
        assert true - len(stream) / 21 <= held[item] <= true


# -- near-duplicates -------------------------------------------------------------------


def test_near_duplicates_query(spark, sf_dir):
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op1_near_duplicates"](spark, sf_dir).collect()}
    assert got == components(documents_of(spark, sf_dir), 3, 85)


def test_near_duplicates_edges(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    rows = list(dict.fromkeys(rows))
    got = near_duplicates(documents(spark, rows + [(None, rows[0][1])])).collect()
    named = {r[0]: tuple(r)[1:] for r in got if r[0] is not None}
    assert named == components(rows, 5, 80)
    assert [tuple(r)[2:] for r in got if r[0] is None] == [(None, True)]
    assert near_duplicates(documents(spark, [])).collect() == []


def test_near_duplicates_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK_MEMBERS", 8)
    monkeypatch.setattr(setsketch, "BUCKET_BLOCK", 8)
    random.seed(4)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for doc in range(60):
        words = list(base)
        for _ in range(random.randint(0, 4)):
            words[random.randrange(60)] = f"x{random.randrange(10**6)}"
        rows.append((doc, " ".join(words)))
    got = {r[0]: tuple(r)[1:] for r in near_duplicates(documents(spark, rows), shingle_words=3, threshold=85).collect()}
    assert got == components(rows, 3, 85)


def test_set_links_are_exact():
    random.seed(5)
    sets = [np.unique(np.array(random.sample(range(60), random.randint(1, 55)), np.uint64)) for _ in range(80)]
    linked = lambda a, b: 100 * len({*a} & {*b}) >= 60 * len({*a} | {*b})
    edges = set_links(sets, 60)
    assert all(linked(sets[i], sets[j]) for i, j in edges)
    by_edges = forest_groups(len(sets), edges)
    by_force = forest_groups(len(sets), [(i, j) for i in range(80) for j in range(i) if linked(sets[i], sets[j])])
    assert by_edges == by_force


def forest_groups(n, edges):
    group = list(range(n))
    for i, j in edges:
        a, b = group[i], group[j]
        group = [min(a, b) if g in (a, b) else g for g in group]
    return group


def test_forest_reaches_all():
    assert len(forest(5, lambda i, others: np.ones(len(others), bool))) == 4
    assert forest(3, lambda i, others: np.zeros(len(others), bool)) == []


def test_sketches_merge_and_estimate():
    random = np.random.default_rng(2)
    pool = random.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[500:2400]
    sketch = registers([a, b, np.union1d(a, b)])
    assert (merged(sketch[0], sketch[1]) == sketch[2]).all()
    greater, smaller = (sketch[0] > sketch[1]).sum(), (sketch[0] < sketch[1]).sum()
    true = 1500 / 2400
    assert abs(estimate(np.array([greater]), np.array([smaller]), [2000], [1900])[0] - true) < 0.2


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    found = connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "t")
    assert {r["node"]: r["component"] for r in found.collect()} == {
        **{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)},
    }


# -- lines -----------------------------------------------------------------------------


def lines_by_force(rows, edits=2, min_chars=20):
    place = lambda o: (o[0] is None, o[0] or 0, o[1])
    occurs = {}
    for doc, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            occurs.setdefault(line, []).append((doc, n))
    first = {line: min(map(place, o)) for line, o in occurs.items()}
    near = {line: [] for line in occurs}
    lines = [line for line in occurs if len(line) >= min_chars]
    for i, a in enumerate(lines):
        for b in lines[:i]:
            if abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits:
                near[a].append(b)
                near[b].append(a)
    out = []
    for line, o in occurs.items():
        for p in o:
            if len(line) < min_chars:
                out.append((*p, None, None, True))
            else:
                early = any(first[other] < first[line] for other in near[line])
                out.append((*p, len(o), len(near[line]), place(p) == first[line] and not early))
    return sorted(out, key=str)


def test_near_lines_by_force(spark):
    random.seed(6)
    letters = "abcdeé "
    pool = ["".join(random.choices(letters, k=random.randint(18, 40))) for _ in range(12)]

    def touched(line):
        line = list(line)
        for _ in range(random.randint(0, 3)):
            line[random.randrange(len(line))] = random.choice(letters + "xyz")
            if random.random() < 0.4:
                del line[random.randrange(len(line))]
        return "".join(line)

    rows = [(i, "\n".join(touched(random.choice(pool)) for _ in range(random.randint(1, 5)))) for i in range(40)]
    rows += [(None, rows[3][1]), (90, None), (91, ""), (92, "short\n\nshort")]
    got = near_lines(documents(spark, rows), short_exact=False).select("id", "line_no", "copies", "links", "kept").collect()
    assert sorted(map(tuple, got), key=str) == lines_by_force(rows)


def test_lines_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr("millrace.llm.line_dedup.BLOCK_LINES", 4)
    rows = [(i, "the same beginning of a line, then number " + f"{i:03d}" + " and the same end") for i in range(30)]
    got = near_lines(documents(spark, rows), short_exact=False).select("id", "line_no", "copies", "links", "kept").collect()
    assert sorted(map(tuple, got), key=str) == lines_by_force(rows)


def test_drop_repeated_lines(spark):
    line = "a line that is long enough to count as one"
    rows = [
        (2, f"{line}\nown text of the second document"), (1, f"first\n{line}\nlast"), (3, line),
        (4, None), (5, ""), (None, f"{line}!\nbrief"), (1, f"first\n{line}\nlast"),
    ]
    df = documents(spark, rows)
    got = drop_repeated_lines(df)
    assert got.columns == df.columns
    assert sorted((tuple(r)[:2] for r in got.collect()), key=str) == sorted(
        [
            (2, "own text of the second document"), (1, f"first\n{line}\nlast"), (1, f"first\n{line}\nlast"),
            (4, None), (5, ""), (None, "brief"),
        ], key=str,
    )
    assert drop_repeated_lines(documents(spark, [])).collect() == []


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance_and_keys(edits):
    random.seed(edits)
    lines = []
    for _ in range(40):
        base = "".join(random.choices("abcé ", k=random.randint(20, 60)))
        lines.append(base)
        for _ in range(3):
            other = list(base)
            for _ in range(random.randint(0, edits + 1)):
                at = random.randrange(len(other))
                other[at : at + random.randint(0, 1)] = random.choice(["", "z", "a"])
            lines.append("".join(other))
    points, sizes = _points(lines)
    begin = np.cumsum(sizes) - sizes
    a, b = np.triu_indices(len(lines), 1)
    close = np.abs(sizes[a] - sizes[b]) <= edits
    a, b = a[close], b[close]
    want = np.array([edit_distance(lines[i], lines[j]) <= edits for i, j in zip(a, b)])
    assert (within(points, begin, sizes, a, b, edits) == want).all() and want.any()
    keys = segment_keys(points, sizes, edits)
    assert all(set(keys[i]) & set(keys[j]) for i, j in zip(a[want], b[want]))


def test_shared_keys_across_batches():
    import pyarrow as pa

    random.seed(8)
    rows = sorted((random.randrange(30), random.randrange(4)) for _ in range(150))
    want = sorted({r for r in rows if len({n for k, n in rows if k == r[0]}) > 1})
    for size in (1, 2, 7, 200):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at : at + size])], ["key", "node"])
            for at in range(0, len(rows), size)
        ]
        got = [tuple(r.values()) for b in _shared_keys(iter(batches)) for r in b.to_pylist()]
        assert got == want
