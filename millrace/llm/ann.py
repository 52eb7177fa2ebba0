"""Nearest neighbours with vantage-point trees, one per shard.

A coarse vantage-point tree, grown from a bounded sample, cuts space into cells; the
vectors of a cell are dealt to shards of bounded size. Each shard is one row of an index
table, holding its own tree in flat arrays. Every query is searched in its own cell first;
the distance of the worst neighbour held then tells, by the triangle inequality, which
other cells it has to travel to. A shard meets its queries in units of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..runtime import settings
from .common import Scratch, column, prepare_workers, table

SHARD_VECTORS = 4096
LEAF_VECTORS = 64
#: The coarse tree has about this many cells at most, and is grown from a sample of about
#: this many vectors (at most twice as many); all vectors are indexed and measured.
MAX_CELLS, SAMPLE_VECTORS = 256, 4096
#: Queries that go down a tree together, and about as many as one task takes to a shard.
QUERY_BLOCK, UNIT_QUERIES = 1024, 65_536
#: Relative rounding error that pruning allows for.
SLACK = 1e-12
#: Pruning factor: 1 is exact; a subtree is skipped if factor * its lower bound is
#: above the distance of the worst neighbour held.
FACTOR = 1.0
NEIGHBOURS = 10


@dataclass
class Tree:
    """Vectors in tree order. Node i has its vantage point at ``start[i]`` (leaves: none),
    its points in ``start[i]:stop[i]``, and children ``inner[i]`` and ``outer[i]``; the
    distances of their points to the vantage point lie within the four bounds."""

    ids: np.ndarray
    vectors: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    bounds: np.ndarray

    def to_bytes(self) -> bytes:
        parts = [self.ids, self.vectors.ravel(), self.start, self.stop, self.inner, self.outer, self.bounds.ravel()]
        return arrays_to_bytes(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        p = arrays_from_bytes(data)
        return cls(p[0], p[1].reshape(len(p[0]), -1).astype(float), *p[2:6], p[6].reshape(-1, 4))


def arrays_to_bytes(arrays: list[np.ndarray]) -> bytes:
    out = pa.BufferOutputStream()
    batch = pa.record_batch([pa.array([a]) for a in arrays], names=[str(i) for i in range(len(arrays))])
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def arrays_from_bytes(data: bytes) -> list[np.ndarray]:
    batch = pa.ipc.open_stream(data).read_next_batch()
    return [c.values.to_numpy(zero_copy_only=False) for c in batch.columns]


def distances(points: np.ndarray, query: np.ndarray) -> np.ndarray:
    difference = points - query
    return np.sqrt(np.einsum("...i,...i->...", difference, difference))


def build_tree(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_VECTORS) -> Tree:
    """Splits at the median distance; equal distances may fall on both sides, which the
    closed bounds allow for."""
    order = np.argsort(ids, kind="stable")
    kept, vectors = vectors, vectors.astype(float)
    nodes = []

    def grow(lo: int, hi: int) -> int:
        at = len(nodes)
        nodes.append([lo, hi, -1, -1, 0.0, 0.0, 0.0, 0.0])
        if hi - lo > leaf:
            # a point far from another point of the node tells points apart well
            far = np.argmax(distances(vectors[order[lo:hi]], vectors[order[lo]]))
            order[[lo, lo + far]] = order[[lo + far, lo]]
            rest = order[lo + 1 : hi]
            d = distances(vectors[rest], vectors[order[lo]])
            half = len(rest) // 2
            split = np.argpartition(d, half)
            order[lo + 1 : hi], d = rest[split], d[split]
            nodes[at][4:] = [d[:half].min(), d[:half].max(), d[half:].min(), d[half:].max()]
            nodes[at][2] = grow(lo + 1, lo + 1 + half)
            nodes[at][3] = grow(lo + 1 + half, hi)
        return at

    if len(ids):
        grow(0, len(ids))
    table_ = np.array(nodes, float).reshape(-1, 8)
    as_int = lambda c: table_[:, c].astype(np.int64)
    return Tree(ids[order], kept[order], as_int(0), as_int(1), as_int(2), as_int(3), table_[:, 4:])


class Cells:
    """The coarse tree: cells are its leaves. The first point of every node, leaves included,
    is one that the vectors of all cells are measured by."""

    def __init__(self, sample: np.ndarray, cells: int):
        leaf = max(2, -(-len(sample) // cells))
        tree = build_tree(np.arange(len(sample)), sample, leaf)
        self.inner, self.outer, self.radius = tree.inner, tree.outer, tree.bounds[:, 1]
        self.points = tree.vectors[tree.start].astype(float) if len(sample) else sample
        leaves = self.inner < 0
        self.count = max(1, int(leaves.sum()))
        self.cell_of_node = np.maximum(np.cumsum(leaves) - 1, 0) if len(leaves) else np.zeros(1, np.int64)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        """The cell of each vector."""
        at = np.zeros(len(vectors), np.int64)
        for node in np.flatnonzero(self.inner >= 0).tolist():  # parents come before children
            rows = np.flatnonzero(at == node)
            near = distances(vectors[rows], self.points[node]) <= self.radius[node]
            at[rows] = np.where(near, self.inner[node], self.outer[node])
        return self.cell_of_node[at]

    def ends(self, vectors: np.ndarray) -> tuple[list[float], list[float]]:
        """Least and greatest distance of vectors to each point."""
        far = [distances(vectors, point) for point in self.points]
        return [float(d.min()) for d in far], [float(d.max()) for d in far]

    def gaps(self, queries: np.ndarray, ends: dict[int, tuple[list[float], list[float]]]):
        """For each cell that has vectors, how far away from each query they are at least."""
        far = [distances(queries, point) for point in self.points]
        for cell, (low, high) in ends.items():
            gap = np.zeros(len(queries))
            for d, lo, hi in zip(far, low, high):
                gap = np.fmax(gap, np.maximum(lo - d, d - hi) - SLACK * (d + hi))
            yield cell, gap


class Search:
    """All queries of a block go down a tree together, each with its own bound: ``bound``
    is what it knows from elsewhere; neighbours beyond that are not looked for."""

    def __init__(
        self, tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float,
        bound: np.ndarray | None = None,
    ):
        self.tree, self.query_ids, self.queries, self.k, self.factor = tree, query_ids, queries, k, factor
        n = len(query_ids)
        self.bound = np.full(n, np.inf) if bound is None else bound * (1 + SLACK)
        self.best = np.full((n, k), np.inf)
        self.best_id = np.full((n, k), np.iinfo(np.int64).max)
        self.best_at = np.zeros((n, k), np.int64)
        self.compared = 0

    def _offer(self, rows: np.ndarray, lo: int, hi: int) -> None:
        """Points ``lo:hi`` for the queries ``rows``; ties go to the smaller id."""
        step = max(1, 2_000_000 // max(1, (hi - lo) * self.queries.shape[1]))
        ids = self.tree.ids[lo:hi]
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            d = distances(self.tree.vectors[None, lo:hi], self.queries[some][:, None])
            d[ids[None] == self.query_ids[some][:, None]] = np.inf
            self.compared += d.size
            all_d = np.concatenate((self.best[some], d), axis=1)
            all_id = np.concatenate((self.best_id[some], np.broadcast_to(ids, d.shape)), axis=1)
            all_id[np.isinf(all_d)] = np.iinfo(np.int64).max
            all_at = np.concatenate((self.best_at[some], np.broadcast_to(np.arange(lo, hi), d.shape)), axis=1)
            first = np.lexsort((all_id, all_d), axis=1)[:, : self.k]
            self.best[some] = np.take_along_axis(all_d, first, axis=1)
            self.best_id[some] = np.take_along_axis(all_id, first, axis=1)
            self.best_at[some] = np.take_along_axis(all_at, first, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, neighbour ids and distances, summed component by component."""
        hit = np.isfinite(self.best) & (self.best <= self.bound[:, None])
        row = np.nonzero(hit)[0]
        square = (self.tree.vectors[self.best_at[hit]] - self.queries[row]) ** 2
        score = np.sqrt(np.cumsum(square, axis=1)[:, -1]) if len(row) else np.empty(0)
        return self.query_ids[row], self.best_id[hit], score

    def run(self, node: int = 0, rows: np.ndarray | None = None) -> None:
        tree = self.tree
        if not len(tree.ids):
            return
        rows = np.arange(len(self.query_ids)) if rows is None else rows
        if tree.inner[node] < 0:
            self._offer(rows, tree.start[node], tree.stop[node])
            return
        vantage = tree.start[node]
        self._offer(rows, vantage, vantage + 1)
        d = distances(self.queries[rows], tree.vectors[vantage])
        in_lo, in_hi, out_lo, out_hi = tree.bounds[node]
        gap_in = np.maximum(0, np.maximum(in_lo - d, d - in_hi))
        gap_out = np.maximum(0, np.maximum(out_lo - d, d - out_hi))
        inner_first = gap_in <= gap_out
        for child, gap, chosen in (
            (tree.inner[node], gap_in, inner_first), (tree.outer[node], gap_out, ~inner_first),
            (tree.outer[node], gap_out, inner_first), (tree.inner[node], gap_in, ~inner_first),
        ):
            # a hair of slack, so that rounding never prunes a tie
            most = np.minimum(self.best[rows, -1], self.bound[rows])
            near = chosen & ((gap - SLACK * (most + d)) * self.factor <= most)
            if near.any():
                self.run(child, rows[near])


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``vector`` of the vectors that take part: floats stay floats, any other
    numbers become doubles."""
    kind = df.select(column(vector_col)).schema[0].dataType
    floats = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    vector = column(vector_col).cast("array<float>" if floats else "array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return df.select(column(id_col).cast("long").alias("id"), vector.alias("vector")).filter(
        F.col("id").isNotNull()
        & F.col("vector").isNotNull()
        & F.forall("vector", fine)
        & F.exists("vector", lambda x: x != 0)
    )


def _matrix(column_: pa.Array) -> np.ndarray:
    n = len(column_)
    return column_.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                if held and held[0].column(key)[0].as_py() != keys[lo]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _placed(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = cells.of(_matrix(batch.column("vector")).astype(float))
                yield batch.append_column("cell", pa.array(found, pa.int32()))

    return run


def _place(vectors: DataFrame, cells: Cells) -> DataFrame:
    """Vectors with their ``cell``, and a number to deal them out by. Rows that repeat an
    id, or are equal, get numbers of their own; so the result must be stored to be used."""
    numbered_ = vectors.withColumn("deal", F.xxhash64(F.monotonically_increasing_id()))
    schema = T.StructType([*numbered_.schema, T.StructField("cell", T.IntegerType())])
    return numbered_.mapInArrow(_placed(cells), schema)


def _trees(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_key(batches, "part"):
            vectors = _matrix(rows.column("vector").combine_chunks())
            cell = rows.column("cell")[0].as_py()
            low, high = cells.ends(vectors.astype(float))
            tree = build_tree(rows.column("id").to_numpy(), vectors).to_bytes()
            yield pa.RecordBatch.from_arrays(
                [rows.column("part").slice(0, 1).combine_chunks(), pa.array([cell], pa.int32()),
                 pa.array([tree], pa.binary()), pa.array([low], pa.list_(pa.float64())),
                 pa.array([high], pa.list_(pa.float64()))],
                ["part", "cell", "packed", "low", "high"],
            )

    return run


INDEX = "part int, cell int, packed binary, low array<double>, high array<double>"


@dataclass
class Index:
    """Trees of all vectors, a row per shard, and what is known of each cell that has any:
    its first shard, its number of shards, and the ends of its distances (see ``Cells``)."""

    trees: DataFrame
    cells: Cells
    shards: dict[int, tuple[int, int]]
    ends: dict[int, tuple[list[float], list[float]]]


def build_index(vectors: DataFrame, cells: Cells, path: str, shard: int) -> Index:
    """Write the trees of stored, placed vectors to ``path``."""
    spark = vectors.sparkSession
    # No more rows than cells come back.
    counts = {r["cell"]: r["count"] for r in vectors.groupBy("cell").count().collect()}
    shards, first = {}, 0
    for cell in sorted(counts):
        shards[cell] = first, -(-counts[cell] // shard)
        first += shards[cell][1]
    known = spark.createDataFrame([(c, *s) for c, s in shards.items()], "cell int, first int, shards int")
    dealt = vectors.join(F.broadcast(known), "cell").withColumn(
        "part", (F.col("first") + F.pmod("deal", "shards")).cast("int")
    )
    dealt = dealt.select("part", "cell", "id", "vector")
    index = dealt.repartition("part").sortWithinPartitions("part", "id").mapInArrow(_trees(cells), INDEX)
    index.write.mode("overwrite").parquet(path)
    trees = spark.read.schema(INDEX).parquet(path)
    # As many rows as cells times points come back; both are bounded by the coarse tree.
    told = trees.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("point", "end"))
    told = told.groupBy("cell", "point").agg(F.min("end.low").alias("low"), F.max("end.high").alias("high"))
    ends = {cell: ([], []) for cell in shards}
    for r in sorted(told.collect(), key=lambda r: r["point"]):
        ends[r["cell"]][0].append(r["low"])
        ends[r["cell"]][1].append(r["high"])
    return Index(trees, cells, shards, ends)


_ASKED = "cell int, first int, shards int, chunk int, packed binary"


def _asks(index: Index, own: bool, factor: float):
    """Queries by the cells they go to: their ``own``, or the others that may hold a nearer
    neighbour than the worst one found there."""
    cells, shards, ends = index.cells, index.shards, index.ends

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, home, chunk = (batch.column(c).to_numpy() for c in ("id", "cell", "chunk"))
            bound = batch.column("bound").to_numpy()
            vectors = _matrix(batch.column("vector"))
            if own:
                chosen = ((int(c), home == c) for c in np.unique(home) if c in shards)
            else:
                gaps = cells.gaps(vectors.astype(float), ends)
                chosen = ((c, (home != c) & (gap * factor <= bound * (1 + SLACK))) for c, gap in gaps)
            for cell, goes in chosen:
                for number in np.unique(chunk[goes]).tolist():
                    rows = np.flatnonzero(goes & (chunk == number))
                    packed = arrays_to_bytes([ids[rows], vectors[rows].ravel(), bound[rows]])
                    yield pa.RecordBatch.from_pydict(
                        {"cell": pa.array([cell], pa.int32()), "first": pa.array([shards[cell][0]], pa.int32()),
                         "shards": pa.array([shards[cell][1]], pa.int32()),
                         "chunk": pa.array([number], pa.int32()), "packed": pa.array([packed], pa.binary())}
                    )

    return run


def _search(k: int, factor: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, size = None, [], 0

        def searched() -> Iterator[pa.RecordBatch]:
            if held:
                ids, vectors, bound = (np.concatenate(p) for p in zip(*held))
                queries = vectors.reshape(len(ids), -1).astype(float)
                for at in range(0, len(ids), QUERY_BLOCK):
                    some = slice(at, at + QUERY_BLOCK)
                    search = Search(tree, ids[some], queries[some], k, factor, bound[some])
                    search.run()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in search.found()], ["query_id", "id", "score"]
                    )

        for batch in batches:
            for is_query, packed in zip(batch.column("is_query"), batch.column("packed")):
                if is_query.as_py():
                    held.append(arrays_from_bytes(packed.as_py()))
                    size += len(held[-1][0])
                if held and (size >= QUERY_BLOCK or not is_query.as_py()):
                    yield from searched()
                    held, size = [], 0
                if not is_query.as_py():
                    tree = Tree.from_bytes(packed.as_py())
        yield from searched()

    return run


def _found(index: Index, queries: DataFrame, k: int, own: bool, factor: float) -> DataFrame:
    """What the queries find in the cells they go to. A unit is a shard and a chunk of the
    queries: the shard's tree comes first, then queries as they arrive."""
    asks = queries.mapInArrow(_asks(index, own, factor), _ASKED)
    met = asks.select("cell", "chunk").distinct()
    trees = index.trees.select("part", "cell", "packed").join(met, "cell")
    to_shards = F.explode(F.sequence("first", F.col("first") + F.col("shards") - 1))
    units = trees.select("part", "chunk", F.lit(False).alias("is_query"), "packed").unionByName(
        asks.select(to_shards.alias("part"), "chunk", F.lit(True).alias("is_query"), "packed")
    )
    return (
        units.repartition("part", "chunk")
        .sortWithinPartitions("part", "chunk", "is_query")
        .mapInArrow(_search(k, factor), "query_id long, id long, score double")
    )


def nearest(
    df: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = NEIGHBOURS,
    factor: float = FACTOR,
    shard: int = SHARD_VECTORS,
    block: int = UNIT_QUERIES,
) -> DataFrame:
    """``query_id, rank, id, score``: the ``k`` nearest of every query in ``df``, by
    Euclidean distance in double precision, without the query's own id.

    Vectors that are NULL, zero or hold a NULL or a number that is not finite take no
    part, nor do rows with a NULL id. Fewer candidates give fewer rows; ties go to the
    smaller id, and rows that repeat an id are candidates each. Vectors of
    different lengths, among those that take part, are an error. Empty tables give an empty
    result. With ``factor`` 1 the result is exact; a larger one skips more. ``shard`` is the
    number of vectors of a tree, ``block`` the number of queries that a task takes to it.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    scratch = Scratch(spark, "nearest")
    vectors, asked = usable(df, id_col, vector_col), usable(queries, id_col, vector_col)
    length = F.size("vector")
    told = [v.agg(F.count(F.lit(1)), F.min(length), F.max(length)).first() for v in (vectors, asked)]
    lengths = {n for _, *ends in told for n in ends if n is not None}
    if len(lengths) > 1:
        raise ValueError(f"vectors have different lengths, from {min(lengths)} to {max(lengths)}")
    cells = _coarse(vectors, told[0][0], shard)
    placed = scratch.save(_place(vectors, cells), "vectors")
    index = build_index(placed, cells, scratch.path("index"), shard)
    scratch.drop("vectors")
    chunks = max(1, -(-told[1][0] // block))
    chunk = F.pmod("deal", F.lit(chunks)).cast("int").alias("chunk")
    asked = scratch.save(_place(asked, cells).select("id", "vector", "cell", chunk), "queries")
    order = Window.partitionBy("query_id").orderBy("score", "id")
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": QUERY_BLOCK}):
        unbound = asked.withColumn("bound", F.lit(float("inf")))
        near = scratch.save(_found(index, unbound, k, True, factor), "near")
        worst = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") == k)
        worst = worst.select(F.col("query_id").alias("id"), F.col("score").alias("bound"))
        bound = asked.join(worst, "id", "left").select(
            *asked.columns, F.coalesce("bound", F.lit(float("inf"))).alias("bound")
        )
        bound = scratch.save(bound, "bound")
        far = scratch.save(_found(index, bound, k, False, factor), "far")
    return (
        near.unionByName(far)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _coarse(vectors: DataFrame, count: int, shard: int) -> Cells:
    """Cells for about one shard each, as far as ``MAX_CELLS`` allows. The result of an exact
    search does not depend on the sample."""
    cells = min(MAX_CELLS, max(1, -(-count // shard)))
    if cells == 1:
        return Cells(np.empty((0, 0)), 1)
    one_in = max(1, count // SAMPLE_VECTORS)
    some = vectors.filter(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(one_in)) == 0)
    rows = some.select("vector").limit(2 * SAMPLE_VECTORS).collect()
    return Cells(np.array([r["vector"] for r in rows], float), min(cells, max(1, len(rows))))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    found = nearest(embeddings, embeddings.filter("vec_id % 100 = 0"))
    return found.withColumnRenamed("id", "vec_id")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - v.e[i]) * (q.e[i] - v.e[i])))) AS score
  FROM v AS q, v WHERE q.vec_id % 100 = 0 AND q.vec_id <> v.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""
