"""Centroid clustering over Hilbert-ordered blocks with zone maps.

Vectors, as integers, are put in the order of a Hilbert curve and cut into blocks, so that
a block holds vectors that lie close to each other. A block's zone map is its smallest
box, and the sum of its vectors. A centroid whose distance to the box is above another
centroid's distance to the box's farthest corner cannot be nearest to any vector inside;
the others are the block's candidates. Vectors are compared with candidates only, exactly;
a block with one candidate gives its stored sum without a look at its vectors.

Centroids are few (a parameter), so they travel with each round's tasks and are renewed
in the driver from one total per centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column, prepare_workers, table
from .fixed_point import EXACT, doubles, floored, slabs

CENTROIDS, ROUNDS, SCALE, DIMENSIONS = 40, 5, 256, 64
SEED = "2:"
#: Vectors of a block, and bits of each component in its place on the curve.
BLOCK_VECTORS, BITS = 256, 4
#: Integers up to this give squared distances that fit a long, up to 256 components.
LIMIT = 1 << 26


# -- order and blocks ------------------------------------------------------------------


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points of a grid, as bytes that sort alike.

    ``points`` has a row per point and whole numbers below ``2 ** bits``. The axes are
    turned into the curve's digits for all points side by side.
    """
    axes = points.T.astype(np.uint32)
    d = len(axes)
    bit = 1 << (bits - 1)
    while bit > 1:
        below = np.uint32(bit - 1)
        for i in range(d):
            flip = (axes[i] & bit) != 0
            swap = np.where(flip, np.uint32(0), (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(flip, below, swap)
            axes[i] ^= swap
        bit >>= 1
    axes = np.bitwise_xor.accumulate(axes, axis=0)
    turn = np.zeros(axes.shape[1], np.uint32)
    bit = 1 << (bits - 1)
    while bit > 1:
        turn ^= np.where((axes[-1] & bit) != 0, np.uint32(bit - 1), np.uint32(0))
        bit >>= 1
    axes ^= turn
    digits = [(axes >> b) & 1 for b in reversed(range(bits))]
    return np.packbits(np.concatenate(digits).T.astype(np.uint8), axis=1)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(cells: pa.Array | pa.ChunkedArray, dtype=np.int32) -> np.ndarray:
    data = [c.as_buffer() for c in cells]
    return np.stack([np.frombuffer(b, dtype) for b in data]) if data else np.empty((0, 0), dtype)


def _whole_numbers(scale: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, _ = floored(batch.column("vector"), scale, LIMIT)
            whole = _binary(values.astype(np.int32).reshape(-1, dimensions))
            yield pa.RecordBatch.from_arrays([batch.column("id"), whole], ["id", "whole"])

    return run


def _ranges(dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                whole = _matrix(batch.column("whole"))
                low = whole.min(axis=0) if low is None else np.minimum(low, whole.min(axis=0))
                high = whole.max(axis=0) if high is None else np.maximum(high, whole.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(low), pa.array(high)], ["axis", "low", "high"]
            )

    return run


def _keyed(low: np.ndarray, high: np.ndarray, bits: int):
    width = np.maximum(1, high.astype(np.int64) - low + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = ((_matrix(batch.column("whole")).astype(np.int64) - low) << bits) // width
                key = _binary(hilbert_keys(cells, bits))
                yield pa.RecordBatch.from_arrays([*batch.columns, key], [*batch.schema.names, "key"])

    return run


def _blocks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slabs(batches, size):
            whole = _matrix(rows.column("whole"))
            ids = rows.column("id").combine_chunks()
            cells = (whole, whole.min(axis=0), whole.max(axis=0), whole.sum(axis=0, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    *[pa.array([c.tobytes()], pa.binary()) for c in cells],
                    pa.array([len(ids)], pa.int64()),
                ],
                ["ids", "whole", "low", "high", "total", "members"],
            )

    return run


# -- assignment ------------------------------------------------------------------------


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Centroids that may be nearest to a vector in the box, ties included."""
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(low - centroids), np.abs(high - centroids))
    return np.flatnonzero((gap * gap).sum(axis=1) <= (far * far).sum(axis=1).min())


def nearest(whole: np.ndarray, centroids: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of ``some`` centroids (numbers in rising order) and its squared distance,
    exactly; ties go to the smaller number."""
    chosen = centroids[some]
    largest = max(int(np.abs(whole).max(initial=0)), int(np.abs(chosen).max(initial=0)))
    if whole.shape[1] * (2 * largest) ** 2 < EXACT:
        x, c = whole.astype(np.float64), chosen.astype(np.float64)
        square = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    else:
        x = whole.astype(np.int64)
        square = np.stack([((x - c) ** 2).sum(axis=1) for c in chosen], axis=1)
    at = square.argmin(axis=1)
    return some[at].astype(np.int32), square[np.arange(len(at)), at].astype(np.int64)


def _totals(centroids: np.ndarray):
    """Per task and centroid: sums of its vectors' components, and their number last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.shape
        sums = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            low, high = (_matrix(batch.column(c)).astype(np.int64) for c in ("low", "high"))
            for i in range(batch.num_rows):
                some = candidates(low[i], high[i], centroids)
                if len(some) == 1:
                    sums[some[0], :d] += np.frombuffer(batch.column("total")[i].as_buffer(), np.int64)
                    sums[some[0], d] += batch.column("members")[i].as_py()
                    continue
                whole = np.frombuffer(batch.column("whole")[i].as_buffer(), np.int32).reshape(-1, d)
                cluster, _ = nearest(whole, centroids, some)
                order = np.argsort(cluster, kind="stable")
                told, first = np.unique(cluster[order], return_index=True)
                sums[told, :d] += np.add.reduceat(whole[order].astype(np.int64), first, axis=0)
                sums[told, d] += np.diff([*first, len(order)])
        told = np.flatnonzero(sums[:, d])
        columns = [np.repeat(told, d + 1).astype(np.int32), np.tile(np.arange(d + 1, dtype=np.int32), len(told)), sums[told].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cluster", "axis", "total"])

    return run


def _assigned(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = centroids.shape[1]
        for batch in batches:
            low, high = (_matrix(batch.column(c)).astype(np.int64) for c in ("low", "high"))
            for i in range(batch.num_rows):
                some = candidates(low[i], high[i], centroids)
                whole = np.frombuffer(batch.column("whole")[i].as_buffer(), np.int32).reshape(-1, d)
                cluster, square = nearest(whole, centroids, some)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids").slice(i, 1).flatten(), pa.array(cluster), pa.array(square)],
                    ["id", "cluster", "distance"],
                )

    return run


# -- operator --------------------------------------------------------------------------


def build_blocks(df: DataFrame, scratch: Scratch, dimensions: int, scale: int, block: int = BLOCK_VECTORS) -> DataFrame:
    """``id, vector`` rows of ``df`` as stored blocks in Hilbert order, with zone maps.

    The curve is cut into tasks by ranges of place and row number, so that any number of
    equal vectors is spread over tasks too. Also stores the rows as ``whole``.
    """
    kind = df.schema["id"].dataType.simpleString()
    whole = df.mapInArrow(_whole_numbers(scale, dimensions), f"id {kind}, whole binary")
    whole = scratch.save(whole.withColumn("row", F.monotonically_increasing_id()), "whole")
    ends = whole.select("whole").mapInArrow(_ranges(dimensions), "axis int, low int, high int")
    ends = ends.groupBy("axis").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    ends = sorted(ends)
    low, high = (np.array([e[c] for e in ends], np.int64) for c in ("low", "high"))
    keyed = whole.mapInArrow(_keyed(low, high, BITS), f"id {kind}, whole binary, row long, key binary")
    ordered = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row").select("id", "whole")
    schema = f"ids array<{kind}>, whole binary, low binary, high binary, total binary, members long"
    return scratch.save(ordered.mapInArrow(_blocks(block), schema), "blocks")


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    centroids: int = CENTROIDS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    dimensions: int = DIMENSIONS,
    seed: str = SEED,
    block: int = BLOCK_VECTORS,
) -> DataFrame:
    """One row per vector: its id, ``cluster``, ``distance`` (squared), ``cluster_inertia``
    and ``inertia`` (distances summed), and ``centroid_sha256`` of the final centroid.

    Components are taken times ``scale`` and floored. Centroids start as the vectors with
    the smallest SHA-256 of ``seed`` and id; each round moves every centroid that has
    vectors to their floored mean. Ties go to the smaller number. Vectors that are NULL,
    of another length than ``dimensions`` or with a component that is NULL or not finite
    take no part; a component beyond 2**26 after scaling is an error. Repeated ids are
    vectors each; equal hashes start in the order of their components' bytes. Rows with a
    NULL id are clustered, and start a centroid only after all others. With fewer vectors
    than ``centroids`` each starts one. An empty table gives an empty result. Other columns
    are not looked at.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    scratch = Scratch(spark, "clustering")
    fitting = df.filter(F.size(column(vector_col)) == dimensions)
    blocks = build_blocks(doubles(fitting, id_col, vector_col), scratch, dimensions, scale, block)
    hashed = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    first = spark.read.parquet(scratch.path("whole")).orderBy(hashed.asc_nulls_last(), "whole").limit(centroids)
    places = [np.frombuffer(r["whole"], np.int32) for r in first.select("whole").collect()]
    at = np.array(places, np.int64).reshape(-1, dimensions)
    zoned = blocks.select("whole", "low", "high", "total", "members")
    for _ in range(rounds if len(at) else 0):
        totals = zoned.mapInArrow(_totals(at), "cluster int, axis int, total long")
        moved = at.copy()
        sums = {(r[0], r[1]): r[2] for r in totals.groupBy("cluster", "axis").agg(F.sum("total")).collect()}
        for (c, axis), total in sums.items():
            if axis < dimensions:
                moved[c, axis] = total // sums[c, dimensions]
        if (moved == at).all():
            break  # further rounds would change nothing
        at = moved
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    near = blocks.select("ids", "whole", "low", "high").mapInArrow(
        _assigned(at), f"id {kind}, cluster int, distance long"
    )
    near = scratch.save(near, "assigned")
    inertia = {r[0]: r[1] for r in near.groupBy("cluster").agg(F.sum("distance")).collect()}
    told = [
        (c, total, sum(inertia.values()), hashlib.sha256(",".join(map(str, at[c].tolist())).encode()).hexdigest())
        for c, total in sorted(inertia.items())
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    centres = spark.createDataFrame(told, schema)  # a row per centroid at most
    scratch.drop("whole", "blocks")
    return near.join(F.broadcast(centres), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql_round(n: int) -> str:
    """``a{n}``: every vector's nearest centroid of ``c{n}``; ``c{n+1}``: the moved ones."""
    square = "list_sum(list_transform(range(1, 65), lambda i: (v.q[i] - c.q[i]) * (v.q[i] - c.q[i])))"
    return f"""a{n} AS MATERIALIZED (
  SELECT r, (best % 64)::INTEGER AS cluster, (best // 64)::BIGINT AS distance FROM (
    SELECT v.r, min({square}::HUGEINT * 64 + c.c) AS best FROM v, c{n} AS c GROUP BY v.r)),
c{n + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.q, c.q) AS q FROM c{n} AS c LEFT JOIN (
    SELECT cluster, list(x ORDER BY i) AS q FROM (
      SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
        SELECT a.cluster, i, sum(v.q[i]) AS s, count(*) AS n
        FROM v JOIN a{n} AS a USING (r), range(1, 65) AS t(i) GROUP BY 1, 2))
    GROUP BY cluster) AS m ON m.cluster = c.c)"""


ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = {DIMENSIONS}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('{SEED}' || vec_id) NULLS LAST, q) - 1 AS c, q FROM v
  ORDER BY sha256('{SEED}' || vec_id) NULLS LAST, q LIMIT {CENTROIDS}),
{", ".join(_sql_round(n) for n in range(ROUNDS + 1))}
SELECT vec_id, cluster, distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
       (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(c{ROUNDS}.q, 'string_agg', ',')) AS centroid_sha256
FROM v JOIN a{ROUNDS} USING (r) JOIN c{ROUNDS} ON c{ROUNDS}.c = cluster
"""
