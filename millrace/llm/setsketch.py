"""Near-duplicate documents by SetSketch.

A sketch holds, per register, the smallest of the set's exponential variates on an
exponentially spaced, truncated scale, so sketches of parts merge by maximum and equal
registers are as likely as shared elements. Bands of register values gather candidates;
inside a bucket the similarity of two sketches is estimated by maximum likelihood from
the registers that are greater, smaller and equal together; what may reach the threshold
joins a cluster, and inside clusters every link is decided on the full shingle sets.

No stage emits pairs: a bucket or cluster gives at most one edge per member and block
pair (a spanning forest), which is all that components need. Large ones are cut into
blocks, and each pair of blocks is a unit of work of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    TEXT_BATCH_BYTES,
    Scratch,
    column,
    give_back_memory,
    grouped,
    prepare_workers,
    small_side,
    table,
    text_or_empty,
    with_sizes,
)
from .graph import connected_components
from .shingles import shingle_sets

#: Registers, registers per band, base and rate of the scale.
REGISTERS, BAND = 128, 4
BASE, RATE = 1.001, 20.0
LARGEST = 65_535
#: How far below the threshold an estimate may lie: over five standard deviations.
MARGIN = 0.2
#: Members of a block; a unit of work holds two blocks at most.
BLOCK_MEMBERS, BLOCK_SHINGLES = 2048, 2_000_000
BUCKET_BLOCK = 4096


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240305)
    return (
        random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32) | np.uint32(1),
        random.integers(0, 1 << 32, REGISTERS, dtype=np.uint32),
    )


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """Sketches of non-empty sets, one row each."""
    factor, shift = _multipliers()
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    low, high = flat.astype(np.uint32), (flat >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(sizes) - sizes
    least = np.empty((len(sets), REGISTERS), np.uint32)
    for i in range(REGISTERS):
        value = low * factor[i] + (high ^ shift[i])
        value ^= value >> np.uint32(16)
        value *= np.uint32(0x7FEB352D)
        value ^= value >> np.uint32(15)
        least[:, i] = np.minimum.reduceat(value, starts) if len(sets) else 0
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    scaled = np.floor(1.0 - np.log(exponential) / np.log(BASE))
    return np.clip(scaled, 0, LARGEST).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def estimate(greater, smaller, n_a, n_b) -> np.ndarray:
    """Most likely Jaccard similarity, given how many registers of the first sketch are
    greater and smaller than the second's, and the sizes of the sets."""
    n_a, n_b = np.asarray(n_a, float), np.asarray(n_b, float)
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = REGISTERS - greater - smaller
    scale = (BASE - 1) / BASE

    def log_likelihood(j):
        p = -np.log1p(-np.clip(u - v * j, 0, 1) * scale) / np.log(BASE)
        q = -np.log1p(-np.clip(v - u * j, 0, 1) * scale) / np.log(BASE)
        tiny = 1e-12
        return (
            greater * np.log(p + tiny) + smaller * np.log(q + tiny)
            + equal * np.log(np.maximum(1 - p - q, tiny))
        )

    low = np.zeros_like(u)
    high = np.minimum(n_a, n_b) / np.maximum(n_a, n_b)
    for _ in range(24):  # the likelihood has one maximum
        a, b = low + (high - low) / 3, high - (high - low) / 3
        up = log_likelihood(a) < log_likelihood(b)
        low, high = np.where(up, a, low), np.where(up, high, b)
    return (low + high) / 2


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, sketch = [], [], []
            for texts in grouped((t.as_py() for t in batch.column("text")), 500_000):
                sets = shingle_sets(texts, size)
                full = [s for s in sets if len(s)]
                rows = iter(registers(full))
                for s in sets:
                    n.append(len(s))
                    digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sketch.append(next(rows).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), pa.array(sketch, pa.binary())],
                ["id", "text_key", "n_shingles", "digest", "sketch"],
            )
        give_back_memory()

    return run


# -- units of work ---------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole units from batches sorted by ``unit``; only the last unit of a
    batch is held back, and units are of bounded size."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        units = batch.column("unit").to_numpy(zero_copy_only=False)
        if not len(units):
            continue
        cut = int(np.flatnonzero(units != units[-1])[-1]) + 1 if units[0] != units[-1] else 0
        if held and held[-1].column("unit")[-1].as_py() != units[0]:
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _units(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    units = rows.column("unit").to_numpy()
    starts = np.flatnonzero(np.concatenate(([True], units[1:] != units[:-1])))
    return starts, np.append(starts[1:], len(units))


def forest(n: int, linked) -> list[tuple[int, int]]:
    """Edges of a spanning forest; ``linked(i, others)`` says which others i links to."""
    edges, waiting = [], np.arange(n)
    while len(waiting):
        queue, waiting = [int(waiting[0])], waiting[1:]
        while queue and len(waiting):
            i = queue.pop()
            hit = linked(i, waiting)
            found = waiting[hit]
            waiting = waiting[~hit]
            edges += [(i, int(j)) for j in found]
            queue += found.tolist()
    return edges


def _close_sketches(threshold: int):
    """Edges between bucket members whose estimate may reach the threshold."""
    least = threshold / 100 - MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            node = rows.column("node").to_numpy()
            n = rows.column("n_shingles").to_numpy().astype(float)
            sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint16)
            sketch = sketch.reshape(len(node), REGISTERS)

            def close(a, b):
                ok = np.minimum(n[a], n[b]) * 100 >= threshold * np.maximum(n[a], n[b])
                same = (sketch[a] == sketch[b]).sum(axis=-1)
                ok &= same >= least * REGISTERS - 2
                at = np.flatnonzero(ok)
                x, y = sketch[a if np.ndim(a) == 0 else a[at]], sketch[b[at]]
                greater = (x > y).sum(axis=-1)
                smaller = REGISTERS - same[at] - greater
                one = n[a] if np.ndim(a) == 0 else n[a[at]]
                ok[at] = estimate(greater, smaller, one, n[b[at]]) >= least
                return ok

            starts, stops = _units(rows)
            pairs = starts[stops - starts == 2]  # most buckets; all of them at once
            hit = close(pairs, pairs + 1) if len(pairs) else np.empty(0, bool)
            u, v = [node[pairs[hit]]], [node[pairs[hit] + 1]]
            for a, b in zip(starts.tolist(), stops.tolist()):
                if b - a > 2:
                    edges = forest(b - a, lambda i, others: close(a + i, a + others))
                    if edges:
                        ends = a + np.array(edges)
                        u.append(node[ends[:, 0]])
                        v.append(node[ends[:, 1]])
            u, v = np.concatenate(u), np.concatenate(v)
            if not len(u):
                continue
            edges = np.unique(np.stack((np.minimum(u, v), np.maximum(u, v)), axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(edges[:, 0]), pa.array(edges[:, 1])], ["u", "v"])

    return run


def _linked_sets(size: int, threshold: int):
    """Edges between cluster members whose full shingle sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            u, v = [], []
            starts, stops = _units(rows)
            for start, stop in zip(starts.tolist(), stops.tolist()):
                unit = rows.slice(start, stop - start)
                node = unit.column("node").to_numpy()
                sets = shingle_sets(unit.column("text").to_pylist(), size)
                for i, j in set_links(sets, threshold):
                    u.append(node[i])
                    v.append(node[j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"]
            )

    return run


def set_links(sets: list[np.ndarray], threshold: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets, decided exactly."""
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    if len(sets) == 2:
        shared = len(np.intersect1d(*sets, assume_unique=True))
        return [(0, 1)] if 100 * shared >= threshold * (n.sum() - shared) and n.all() else []
    _, number, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = often[number] > 1  # the rest adds to sizes only
    owner = np.repeat(np.arange(len(sets)), n)[common]
    number = number[common]
    bounds = np.searchsorted(owner, np.arange(len(sets) + 1))
    mark = np.zeros(len(often), bool)
    state = {"members": None, "flat": number, "owner": owner}

    def linked(i: int, others: np.ndarray) -> np.ndarray:
        # Members already reached are left out, now and then, of what is looked through.
        if state["members"] is None or len(others) * 2 < state["members"]:
            keep = np.isin(state["owner"], others)
            state.update(members=len(others), flat=state["flat"][keep], owner=state["owner"][keep])
        own = number[bounds[i] : bounds[i + 1]]
        mark[own] = True
        shared = np.bincount(state["owner"], weights=mark[state["flat"]], minlength=len(sets))
        mark[own] = False
        shared = shared[others].astype(np.int64)
        return (100 * shared >= threshold * (n[i] + n[others] - shared)) & (n[i] > 0)

    return forest(len(sets), linked)


def in_blocks(members: DataFrame, blocks) -> DataFrame:
    """Deal the members of each group out to pairs of blocks; ``unit`` names a pair."""
    own = F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - F.lit(1)))
    dealt = members.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", other)
    return dealt.withColumn(
        "unit",
        F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other")),
    ).drop("own", "other", "blocks")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    threshold: int = 80,
    with_key: bool = False,
) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id``, ``kept``; ``with_key``
    also ``text_key``, xxhash64 of the text, which tells rows that repeat an id apart.

    Two documents are linked if 100 * shared shingles >= ``threshold`` * all their
    shingles; components are what links reach, and are named by their smallest id. A
    NULL, empty or wordless text has no shingles and no links. Rows that repeat an id
    are judged by their own text each; sets that have the same smallest id count as
    linked. A row with a NULL id links nothing, has a NULL component and is kept. An
    empty table gives an empty result. Other columns are not looked at; ids must be
    whole numbers.
    """
    spark = df.sparkSession
    prepare_workers(spark, TEXT_BATCH_BYTES)
    scratch = Scratch(spark, "near-duplicates")
    text = text_or_empty(text_col)
    rows = df.select(
        column(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text")
    )
    sketches = scratch.save(
        rows.mapInArrow(
            _sketches(shingle_words),
            "id long, text_key long, n_shingles long, digest binary, sketch binary",
        ),
        "sketches",
    )
    named = sketches.filter("id IS NOT NULL AND n_shingles > 0")
    # Equal sets are one class, known by its smallest id.
    classes = scratch.save(
        named.groupBy("digest", "n_shingles").agg(
            F.min(F.struct("id", "text_key")).alias("least"), F.any_value("sketch").alias("sketch")
        ).select("digest", "n_shingles", F.col("least.id").alias("node"), F.col("least.text_key"), "sketch"),
        "classes",
    )
    bands = F.explode(
        F.array(*[
            F.xxhash64(F.lit(i), F.substring("sketch", 1 + 2 * BAND * i, 2 * BAND))
            for i in range(REGISTERS // BAND)
        ])
    )
    met = classes.select("node", "n_shingles", bands.alias("group"))
    sizes = met.groupBy("group").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    sizes = scratch.save(sizes, "sizes")
    # Joined from a stored copy: a hot bucket's members are split by AQE, or not shuffled.
    met = scratch.save(met.join(small_side(sizes, scratch.path("sizes")), "group"), "met")
    sketch_of = classes.select("node", "n_shingles", "sketch")
    units = in_blocks(
        met.join(small_side(sketch_of, scratch.path("classes")), ["node", "n_shingles"]),
        F.ceil(F.col("members") / BUCKET_BLOCK),
    )
    close = _by_unit(units.select("unit", "node", "n_shingles", "sketch")).mapInArrow(
        _close_sketches(threshold), "u long, v long"
    )
    clusters = connected_components(close, scratch, "close")
    clustered = classes.select("node", "n_shingles", "text_key").join(clusters, "node")
    clustered = scratch.save(clustered.withColumnRenamed("component", "group"), "clustered")
    members = with_sizes(
        clustered, "group", scratch, "weights", members=F.count(F.lit(1)), weight=F.sum("n_shingles")
    )
    members = scratch.save(members, "members")
    texts = rows.join(
        small_side(members, scratch.path("members")),
        (F.col("id") == F.col("node")) & (rows["text_key"] == members["text_key"]),
    )
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK_MEMBERS), F.ceil(F.col("weight") / BLOCK_SHINGLES))
    links = _by_unit(in_blocks(texts, blocks).select("unit", "node", "text")).mapInArrow(
        _linked_sets(shingle_words, threshold), "u long, v long"
    )
    components = connected_components(links, scratch, "links")
    node_of = classes.select("digest", "n_shingles", "node")
    found = (
        sketches.select("id", sketches["text_key"], "digest", "n_shingles")
        .join(node_of, ["digest", "n_shingles"], "left")
        .join(components, "node", "left")
        .select(
            "id",
            "n_shingles",
            "text_key",
            F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component_id"),
        )
    )
    result = found.select(
        F.col("id").alias(id_col),
        "n_shingles",
        "component_id",
        (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"),
        *(["text_key"] if with_key else []),
    )
    scratch.drop("met", "sizes", "clustered", "weights", "members")
    return result


def _by_unit(units: DataFrame) -> DataFrame:
    return units.repartition("unit").sortWithinPartitions("unit")


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, threshold=85)
