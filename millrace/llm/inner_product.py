"""Exact top-k search by inner product, block at a time.

A vector is a document, its components are the weights of its terms. Documents are cut
into blocks by ranges of their ids. A block is a forward index: its documents' components,
and per term the largest and the smallest weight that occurs in it (the smallest serves a
query's negative weights). The sum of a query's weights times these maxima bounds every
score in the block. Per query, blocks are scored in the order of their bounds until the
next bound falls below the k-th best score held.

Blocks next to each other make a shard, a row of the index table, with the shard's own
maxima. A block of queries visits its shards in the order of their bounds too, in rounds
of growing size: what a round has found prunes the next ones, and shards that no query of
the block can gain from are not visited. Pruning never drops a document whose score
equals the k-th, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import settings
from .common import Scratch, prepare_workers, small_side, table
from .fixed_point import EXACT, doubles, floored, slabs

NEIGHBOURS, SCALE = 10, 1024
#: Documents of a block and of a shard; queries that travel together.
BLOCK_DOCUMENTS, SHARD_DOCUMENTS, QUERY_BLOCK = 256, 8192, 512
#: A round visits so many times the shards of all rounds before it.
GROWTH = 3
#: Components up to this are stored.
LIMIT = (1 << 31) - 1

#: Pairs of a shard and a block of queries in one Arrow batch, which both are parts of.
VISITS_TOGETHER = 4
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_FIELDS = "ids array<long>, whole binary, width int, high binary, low binary"


# -- index -----------------------------------------------------------------------------


def _padded(vectors: pa.Array, scale: int) -> np.ndarray:
    """A row per vector; a component that a vector does not have weighs nothing."""
    values, sizes = floored(vectors, scale, LIMIT)
    width = int(sizes.max(initial=0))
    out = np.zeros((len(sizes), width), np.int32)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _ends(whole: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest weight per block and term; none beyond the vectors' end."""
    starts = np.arange(0, len(whole), block)
    if not whole.shape[1]:
        return (np.empty((len(starts), 0), np.int32),) * 2
    return np.maximum.reduceat(whole, starts, axis=0), np.minimum.reduceat(whole, starts, axis=0)


def _packed(scale: int, rows: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slabs(batches, rows):
            whole = _padded(some.column("vector").combine_chunks(), scale)
            high, low = _ends(whole, block)
            ids = some.column("id").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([whole.tobytes()], pa.binary()),
                    pa.array([whole.shape[1]], pa.int32()),
                    pa.array([high.tobytes()], pa.binary()),
                    pa.array([low.tobytes()], pa.binary()),
                ],
                ["ids", "whole", "width", "high", "low"],
            )

    return run


class Rows:
    """One stored row: vectors, their ids, and the weights' ends by block."""

    def __init__(self, batch: pa.RecordBatch, at: int, prefix: str = ""):
        cell = lambda name: batch.column(prefix + name)[at]
        self.ids = cell("ids").values.to_numpy()
        self.width = cell("width").as_py()
        shaped = lambda name: np.frombuffer(cell(name).as_buffer(), np.int32)
        self.whole = shaped("whole").reshape(len(self.ids), self.width)
        self.high, self.low = (
            shaped(name).reshape(-1, self.width) if self.width else np.zeros((1, 0), np.int32) for name in ("high", "low")
        )


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b.T`` of integers, exactly, over the columns both have."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    largest = lambda m: int(np.abs(m.astype(np.int64)).max(initial=0))
    bound = width * largest(a) * largest(b)
    if bound >= 1 << 62:
        raise ValueError("scores of these vectors do not fit a long")
    kind = np.float64 if bound < EXACT else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Per query and block, what no score in the block is above. A vector shorter than
    the widest of its shard weighs 0 beyond its end, which the ends include."""
    return products(np.maximum(queries, 0), high) + products(np.minimum(queries, 0), low)


# -- search ----------------------------------------------------------------------------


class Search:
    """The best ``k`` documents of every query of a block, so far."""

    def __init__(self, queries: Rows, k: int, floor: np.ndarray):
        n = len(queries.ids)
        self.queries, self.k, self.floor = queries, k, floor
        self.score = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.held = np.zeros(n, np.int64)
        self.compared = 0

    def least(self) -> np.ndarray:
        """A document below this score is not among the query's best."""
        return np.maximum(self.floor, np.where(self.held >= self.k, self.score[:, -1], self.floor))

    def offer(self, rows: np.ndarray, ids: np.ndarray, whole: np.ndarray) -> None:
        """Documents for the queries ``rows``; ties go to the smaller id."""
        score = products(self.queries.whole[rows], whole)
        self.compared += score.size
        fine = (score >= self.least()[rows][:, None]) & (ids[None] != self.queries.ids[rows][:, None])
        some = fine.any(axis=1)
        rows, score, fine = rows[some], score[some], fine[some]
        if not len(rows):
            return
        self.held[rows] += fine.sum(axis=1)
        none = np.iinfo(np.int64)
        all_score = np.concatenate((self.score[rows], np.where(fine, score, none.min)), axis=1)
        all_ids = np.concatenate((self.ids[rows], np.where(fine, ids[None], none.max)), axis=1)
        # -min is itself: turn the order round by complement instead
        first = np.lexsort((all_ids, ~all_score), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(all_score, first, axis=1)
        self.ids[rows] = np.take_along_axis(all_ids, first, axis=1)

    def run(self, shard: Rows, block: int) -> None:
        """Blocks in the order of each query's bounds, until the next one's is too low."""
        bound = bounds(self.queries.whole, shard.high, shard.low)
        order = np.argsort(-bound, axis=1, kind="stable")
        for turn in range(bound.shape[1]):
            at = order[:, turn]
            open_ = np.take_along_axis(bound, at[:, None], axis=1)[:, 0] >= self.least()
            if not open_.any():
                break  # the bounds that follow are lower still
            for b in np.unique(at[open_]):
                rows = np.flatnonzero(open_ & (at == b))
                inside = slice(b * block, (b + 1) * block)
                self.offer(rows, shard.ids[inside], shard.whole[inside])

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of queries in the block, ids and scores of documents."""
        there = np.arange(self.k) < np.minimum(self.held, self.k)[:, None]
        return np.nonzero(there)[0].astype(np.int32), self.ids[there], self.score[there]


def _shard_bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (block of queries, shard): the highest bound of any of the queries."""
    for batch in batches:
        best = []
        for i in range(batch.num_rows):
            queries, shard = Rows(batch, i, "q_"), Rows(batch, i)
            best.append(int(bounds(queries.whole, shard.high.max(axis=0)[None], shard.low.min(axis=0)[None]).max()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("block"), batch.column("shard"), pa.array(best, pa.int64())], ["block", "shard", "bound"]
        )


def _visits(k: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                queries, shard = Rows(batch, i, "q_"), Rows(batch, i)
                floor = np.full(len(queries.ids), np.iinfo(np.int64).min)
                for place, least in zip(*(batch.column("floors")[i].values.field(f) for f in ("place", "least"))) if batch.column("floors")[i].is_valid else ():
                    floor[place.as_py()] = least.as_py()
                search = Search(queries, k, floor)
                search.run(shard, block)
                place, ids, score = search.found()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(place), batch.column("block")[i].as_py())), *map(pa.array, (place, ids, score))],
                    ["block", "place", "id", "score"],
                )

    return run


# -- operator --------------------------------------------------------------------------


def build_index(vectors: DataFrame, scratch: Scratch, name: str, scale: int, rows: int, block: int) -> DataFrame:
    """``id, vector`` rows as stored shards of about ``rows`` vectors, in ranges of ids."""
    order = vectors.withColumn("row", F.monotonically_increasing_id())
    stored = scratch.save(order, f"{name}-rows")  # the number of a row is the same in every attempt
    parts = max(1, -(-stored.count() // rows))
    ranged = stored.repartitionByRange(parts, "id", "row").sortWithinPartitions("id", "row")
    packed = ranged.select("id", "vector").mapInArrow(_packed(scale, rows, block), _FIELDS)
    numbered = packed.withColumns({"part": F.spark_partition_id(), "shard": F.monotonically_increasing_id()})
    return scratch.save(numbered, name)


def top_products(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    scale: int = SCALE,
    block: int = BLOCK_DOCUMENTS,
    shard: int = SHARD_DOCUMENTS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` rows of ``df`` with the largest inner
    product with each query, without those of the query's own id.

    Components are taken times ``scale`` and floored; scores are exact. Vectors that are
    NULL or hold a component that is NULL or not finite take no part, nor do rows with a
    NULL id; a component that a shorter vector lacks weighs nothing. A component beyond
    2**31 after scaling is an error, as is a score that may not fit a long. Ties go to the
    smaller id; rows that repeat an id are candidates each, and queries each, with ranks
    of their own. Fewer candidates give fewer rows; empty tables an empty result. Other
    columns are not looked at.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    scratch = Scratch(spark, "inner-product")
    usable = lambda rows: doubles(rows, id_col, vector_col).select(F.col("id").cast("long"), "vector").filter("id IS NOT NULL")
    index = build_index(usable(df), scratch, "index", scale, shard, block)
    asked = build_index(usable(queries), scratch, "queries", scale, query_block, query_block)
    renamed = [F.col(c).alias(f"q_{c}") for c in asked.columns if c != "shard"]
    asked = asked.select(F.col("shard").alias("block"), *renamed)
    query_parts = asked.agg(F.max("q_part")).first()[0]
    small = small_side(asked, scratch.path("queries"))

    # Every shard meets every block of queries, but for this with its ends only.
    number = F.explode(F.sequence(F.lit(0), F.lit(query_parts or 0))).alias("q_part")
    none = [F.lit(b"").alias("whole"), F.array().cast("array<long>").alias("ids")]
    ends = index.select("shard", "width", "high", "low", *none, number)
    with settings(spark, {_BATCH_ROWS: VISITS_TOGETHER}):
        pairs = ends.join(small, "q_part").mapInArrow(_shard_bounds, "block long, shard long, bound long")
        turns = Window.partitionBy("block").orderBy(F.desc("bound"), "shard")
        pairs = scratch.save(pairs.withColumn("turn", F.row_number().over(turns)), "pairs")
    last = pairs.agg(F.max("turn")).first()[0] or 0

    best = Window.partitionBy("block", "place").orderBy(F.desc("score"), "id")
    found, done, number = None, 0, 0
    while done < last or found is None:
        upto = max(1, done * (GROWTH + 1))
        visits = pairs.filter((F.col("turn") > done) & (F.col("turn") <= upto))
        if found is None:
            floors = pairs.select("block").distinct().withColumns(
                {"floors": F.lit(None).cast("array<struct<place:int,least:long>>"), "least": F.lit(None).cast("long")}
            )
        else:
            floors = _floors(found, asked, k)
        # A shard is visited if some query of the block lacks a score its bound is below.
        visits = visits.join(floors, "block").filter(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
        with settings(spark, {_BATCH_ROWS: VISITS_TOGETHER}):
            met = visits.join(small, "block").join(index, "shard")
            new = met.mapInArrow(_visits(k, block), "block long, place int, id long, score long")
            all_ = new if found is None else found.unionByName(new)
            all_ = all_.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).drop("rank")
            found = scratch.save(all_, f"found-{number}")
        done, number = upto, number + 1
    names = asked.select("block", F.posexplode("q_ids").alias("place", "query_id"))
    return (
        found.withColumn("rank", F.row_number().over(best))
        .join(small_side(names, scratch.path("queries")), ["block", "place"])
        .select("query_id", "rank", "id", "score")
    )


def _floors(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Per block of queries: ``floors``, the k-th score of each query that holds ``k``, and
    ``least`` of them, NULL if some query holds fewer."""
    held = found.groupBy("block", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    full = held.filter(F.col("n") >= k).groupBy("block").agg(
        F.collect_list(F.struct("place", "least")).alias("floors"),
        F.count(F.lit(1)).alias("full"),
        F.min("least").alias("least"),
    )
    sizes = asked.select("block", F.size("q_ids").alias("queries"))
    return sizes.join(full, "block", "left").select(
        "block", "floors", F.when(F.col("full") == F.col("queries"), F.col("least")).alias("least")
    )


def op13_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    found = top_products(embeddings, embeddings.filter("vec_id % 100 = 0"))
    return found.withColumnRenamed("id", "vec_id")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         coalesce(list_sum(list_transform(range(1, least(len(q.e), len(v.e)) + 1), lambda i: q.e[i] * v.e[i])), 0)::BIGINT AS score
  FROM v AS q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""
