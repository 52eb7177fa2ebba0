"""Small tables with every awkward case, and the brute-force versions of operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use inside, to show that columns of the input never meet them.
CLASHES = [
    "id", "key", "node", "unit", "group", "digest", "rules", "length", "members", "component", "text_key", "hit", "c0", "c1",
    "__scan_id", "__scan_hit", "__text", "__gone",
]

PROSE = (
    "the quick brown fox jumps over the lazy dog while a patient crow watches from the old"
    " fence and counts every leap that the fox makes before the evening light is gone from"
    " the quiet field where nobody has walked since the early days of spring this year"
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(doc_id, text)`` rows with extra columns whose names operators use inside."""
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("x" for _ in CLASHES)) for r in rows], schema)


def edge_rows() -> list[tuple]:
    long_text = " ".join(f"word{i % 977}" for i in range(30_000))
    return [
        (1, PROSE), (2, PROSE), (3, PROSE.upper()), (4, None), (5, ""), (6, " \n\t "), (7, "one"),
        (7, "one"), (8, "one  two"), (None, PROSE), (None, None), (9, long_text), (10, long_text + " end"),
        (11, PROSE.replace("fox", "cat")), (12, "a b"), (13, "a  b\n"), (14, "12 34 !!"), (15, "é" * 5000),
    ]


def shingle_set(text: str | None, size: int) -> frozenset:
    data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def components(rows: list[tuple], size: int, threshold: int) -> dict:
    """doc_id -> (set size, smallest id reachable, kept), for distinct ids."""
    sets = [shingle_set(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for j, shared in Counter(j for x in s for j in holders[x]).items():
            if 100 * shared >= threshold * (len(s) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc), doc)
    return {
        doc: (len(sets[i]), least[root(i)], least[root(i)] == doc) for i, (doc, _) in enumerate(rows)
    }


def edit_distance(a: str, b: str) -> int:
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def documents_of(spark: SparkSession, sf_dir: str) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
