"""Near-equal lines by a segment-partition edit join.

If two lines are within ``edits`` edits and one is cut into ``edits + 1`` segments, some
segment occurs in the other untouched, close to its own place. Every line is indexed by
its segments and probes, for each length it can be near to, the substrings that may equal
a segment there. Lines that meet under no key are done; those that meet are compared by a
banded bit-parallel edit distance, many pairs side by side.

No stage emits pairs: a comparison adds to a line's number of links, or tells that an
earlier line is near it. Hot keys are cut into blocks, one pair of blocks per unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    TEXT_BATCH_BYTES,
    Scratch,
    column,
    give_back_memory,
    grouped,
    numbered,
    prepare_workers,
    small_side,
    table,
    text_or_empty,
    with_sizes,
)
from .shingles import mixed

EDITS = 2
#: Shorter lines have no edits to spare: few would make most of them equal.
MIN_CHARS = 20
BLOCK_LINES = 512
#: Code points of one side that are compared together.
COMPARED_TOGETHER = 2_000_000

_U = np.uint64
_M = 0x9E3779B97F4A7C15 | 1


# -- keys ------------------------------------------------------------------------------


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(segment, length difference, shift) of every substring to look at. Difference 0
    and shift 0 is the line's own segment, which is also what the index holds."""
    out = []
    for longer in range(edits + 1):
        for i in range(edits + 1):
            low = max(-i, longer - (edits - i))
            high = min(i, longer + (edits - i))
            out += [(i, longer, shift) for shift in range(low, high + 1)]
    return out


def segment_keys(points: np.ndarray, sizes: np.ndarray, edits: int) -> np.ndarray:
    """Keys of all lines, one row per line; ``points`` holds their code points in turn.

    A key is a hash of segment number, indexed length and content. Substrings that do
    not exist get a key of their own.
    """
    n = len(points)
    powers = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, _U(_M)), out=powers[1:])
    # hash(a..b) = sums[b] - sums[a] * M ** (b - a), with sums rolled from the left
    inverse = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, _U(pow(_M, -1, 1 << 64))), out=inverse[1:])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(points.astype(np.uint64) + _U(1)) * powers[:-1], out=sums[1:])
    begin = np.cumsum(sizes) - sizes
    keys = np.empty((len(sizes), len(probes(edits))), np.uint64)
    for k, (i, longer, shift) in enumerate(probes(edits)):
        length = sizes - longer
        each, rest = length // (edits + 1), length % (edits + 1)
        # the last `rest` segments are one longer
        plain = edits + 1 - rest
        start = i * each + np.maximum(0, i - plain)
        width = each + (i >= plain)
        at = start + shift
        fine = (length >= edits + 1) & (at >= 0) & (at + width <= sizes)
        a = np.where(fine, begin + at, 0)
        b = np.where(fine, a + width, 0)
        content = (sums[b] - sums[a]) * inverse[a]
        key = mixed(mixed(content) + length.astype(np.uint64) * _U(_M) + _U(i * 7919 + 1))
        alone = mixed(np.arange(len(sizes), dtype=np.uint64) + _U(k << 40) + sums[begin + sizes])
        keys[:, k] = np.where(fine, key, alone)
    return keys


def _points(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    return np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32), sizes


def _line_keys(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, first = np.unique(batch.column("node").to_numpy(), return_index=True)
            lines = batch.column("line").take(pa.array(first))
            at = 0
            for group in grouped(t.as_py() for t in lines):
                keys = segment_keys(*_points(group), edits)
                own = np.repeat(nodes[at : at + len(group)], keys.shape[1])
                at += len(group)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(own)], ["key", "node"]
                )
        give_back_memory()

    return run


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of keys that two different lines have, from rows sorted by key and node. Only
    the last row of a batch is held back."""
    last = np.empty((0, 2), np.int64)
    told = False  # whether that row has been given out
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([batch.column(c).to_numpy() for c in ("key", "node")], axis=1)
        rows = np.concatenate((last, rows))
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:] != rows[:-1]).any(axis=1)
        rows = rows[fresh]
        same = rows[1:, 0] == rows[:-1, 0]
        shared = np.zeros(len(rows), bool)
        shared[1:] |= same
        shared[:-1] |= same
        alone = len(rows) == 1  # then the held row came again, and stays as it was
        if told:
            shared[0] = False
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[shared, 0]), pa.array(rows[shared, 1])], ["key", "node"]
        )
        last, told = rows[-1:], bool(shared[-1]) or (told and alone)


# -- comparison ------------------------------------------------------------------------


def within(points: np.ndarray, begin: np.ndarray, sizes: np.ndarray, a, b, edits: int) -> np.ndarray:
    """Which of the pairs of lines ``a[i], b[i]`` are within ``edits`` edits.

    A column of the edit matrix is two words of vertical differences, kept for the band
    of rows around the diagonal; bit 63 is the band's lowest row. Cells outside the band
    cannot be part of a path of so few edits.
    """
    longer = sizes[a] >= sizes[b]
    a, b = np.where(longer, a, b), np.where(longer, b, a)
    out = np.zeros(len(a), bool)
    order = np.argsort(sizes[a], kind="stable")
    at = 0
    while at < len(order):
        # pairs of about equal lengths, as many as fit
        some = order[at : at + max(1, COMPARED_TOGETHER // int(sizes[a[order[at]]] + 1))]
        fit = int(np.searchsorted(sizes[a[some]], 2 * sizes[a[some[0]]] + 64, "right"))
        some = some[: max(1, fit)]
        out[some] = _within(points, begin, sizes, a[some], b[some], edits)
        at += len(some)
    return out


def _columns(points, begin, sizes, rows, before: int, height: int) -> np.ndarray:
    place = np.arange(-before, height - before)[:, None]
    inside = (place >= 0) & (place < sizes[rows][None])
    index = np.where(inside, begin[rows][None] + place, 0)
    return np.where(inside, points[index], np.uint32(0xFFFFFFFF))


def _within(points, begin, sizes, a, b, edits: int) -> np.ndarray:
    one, zero, top = _U(1), _U(0), _U(1 << 63)
    len_a, len_b = sizes[a], sizes[b]
    height = int(len_b.max())
    text = _columns(points, begin, sizes, b, 0, height)
    pattern = _columns(points, begin, sizes, a, edits, height + 2 * edits + 1)
    up = np.full(len(a), _U((1 << 64) - (1 << (63 - edits))))
    down = np.zeros(len(a), np.uint64)
    distance = np.full(len(a), edits, np.int64)
    turn = len_a - edits  # first column whose band ends below the pattern's last row
    for i in range(height):
        match = np.zeros(len(a), np.uint64)
        for k in range(2 * edits + 1):
            match |= (pattern[i + 2 * edits - k] == text[i]).astype(np.uint64) << _U(63 - k)
        diagonal = (((match & up) + up) ^ up) | match | down
        plus = down | ~(diagonal | up)
        minus = diagonal & up
        sloped = i < turn
        bit = one << np.clip(62 - (i - turn), 0, 62).astype(np.uint64)
        step = np.where(
            sloped,
            (diagonal & top) == zero,
            ((plus & bit) != zero).astype(np.int64) - ((minus & bit) != zero),
        )
        distance += np.where(i < len_b, step, 0)
        shifted = diagonal >> one
        up = minus | ~(shifted | plus)
        down = shifted & plus
    return distance <= edits


def _compare(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .setsketch import _runs, _units

        for rows in _runs(batches):
            lines = rows.column("line").to_pylist()
            points, sizes = _points(lines)
            begin = np.cumsum(sizes) - sizes
            keys = segment_keys(points, sizes, edits).view(np.int64)
            unit_key = rows.column("key").to_numpy()
            own = rows.column("own").to_numpy()
            cross = rows.column("cross").to_numpy(zero_copy_only=False)
            order = list(zip(*(rows.column(c).to_pylist() for c in ("no_id", "first_id", "first_line", "first_key"))))
            rank = np.empty(len(order), np.int64)
            rank[sorted(range(len(order)), key=lambda r: tuple(-1 if x is None else x for x in order[r]))] = np.arange(len(order))
            starts, stops = _units(rows)
            for a, b in _pairs(starts, stops):
                ok = np.abs(sizes[a] - sizes[b]) <= edits
                ok &= ~cross[a] | (own[a] != own[b])
                a, b = a[ok], b[ok]
                # a pair is counted where its smallest common key is
                same = keys[a][:, :, None] == keys[b][:, None, :]
                least = np.where(same.any(axis=2), keys[a], np.iinfo(np.int64).max).min(axis=1)
                ok = least == unit_key[a]
                a, b = a[ok], b[ok]
                if not len(a):
                    continue
                hit = within(points, begin, sizes, a, b, edits)
                a, b = a[hit], b[hit]
                links = np.bincount(np.concatenate((a, b)), minlength=len(lines))
                later = np.where(rank[a] > rank[b], a, b)
                preceded = np.bincount(later, minlength=len(lines)) > 0
                told = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("digest").combine_chunks().take(pa.array(told)), pa.array(links[told].astype(np.int64)), pa.array(preceded[told])],
                    ["digest", "links", "preceded"],
                )

    return run


def _pairs(starts: np.ndarray, stops: np.ndarray, together: int = 100_000):
    """Index pairs of the rows of each unit: all units of two rows at once, then rows of
    larger ones against those before them, some rows at a time."""
    two = starts[stops - starts == 2]
    for at in range(0, len(two), together):
        yield two[at : at + together], two[at : at + together] + 1
    held, size = [], 0
    for start, stop in zip(starts.tolist(), stops.tolist()):
        if stop - start > 2:
            for row in range(start + 1, stop):
                held.append((row, start))
                size += row - start
                if size >= together:
                    yield _spread(held)
                    held, size = [], 0
    if held:
        yield _spread(held)


def _spread(held: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    row, start = np.array(held).T
    n = row - start
    a = np.repeat(row, n)
    return a, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)


# -- operator --------------------------------------------------------------------------


def _lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    line = F.posexplode(F.split(text, "\n")).alias("line_no", "line")
    return df.select(column(id_col).alias("id"), F.xxhash64(text).alias("key"), line)


def _says_something(line) -> Column:
    return F.regexp_like(line, F.lit(r"[^\s\p{Z}]"))


def near_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    short_exact: bool = True,
) -> DataFrame:
    """One row per line of every text: ``id``, ``key`` (of the text), ``line_no`` from 0,
    ``copies`` (times its text occurs), ``links`` (other line texts within ``edits``
    edits) and ``kept``.

    Of equal lines the first stays: that of the smallest id (of any type that has an
    order), NULL ids last, then of the smallest line number. It goes too if a line within ``edits`` edits occurs earlier.
    Lines of fewer than ``min_chars`` code points are near to nothing. They are counted and
    judged by their exact repeats, but blank ones, which part paragraphs, stay; without
    ``short_exact`` all of them stay, with NULL counts. Rows that are equal
    in id and text share their lines' fate. A NULL text is one empty line. An empty table
    gives an empty result. Other columns are not looked at.
    """
    spark = df.sparkSession
    prepare_workers(spark, TEXT_BATCH_BYTES)
    scratch = Scratch(spark, "lines")
    lines = _lines(df, id_col, text_col).withColumns(
        {"node": F.xxhash64("line"), "digest": F.unhex(F.md5("line"))}
    )
    is_long = F.char_length("line") >= min_chars
    long_lines = lines.filter(is_long)
    found = long_lines.select("line", "node").mapInArrow(_line_keys(edits), "key long, node long")
    shared = found.repartition("key").sortWithinPartitions("key", "node").mapInArrow(
        _shared_keys, "key long, node long"
    )
    shared = scratch.save(shared, "shared")
    nodes = scratch.save(shared.select("node").distinct(), "nodes")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "line_no", "key")
    first = scratch.save(
        (lines if short_exact else long_lines).groupBy("digest").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("copies")),
        "first",
    )
    texts = (
        long_lines.join(small_side(nodes, scratch.path("nodes")), "node")
        .groupBy("digest", "node")
        .agg(F.any_value("line").alias("line"), F.min(place).alias("least"))
    )
    texts = scratch.save(texts, "texts")
    met = with_sizes(shared, "key", scratch, "sizes", members=F.count(F.lit(1)))
    met = met.withColumn("blocks", F.ceil(F.col("members") / BLOCK_LINES)).withColumn(
        "own", F.pmod(F.xxhash64(F.lit(7), "node"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - F.lit(1)))
    units = met.withColumn("other", other).select(
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        "key", "node", "own", (F.col("own") != F.col("other")).alias("cross"),
    )
    units = units.join(small_side(texts, scratch.path("texts")), "node").select(
        "unit", "key", "own", "cross", "digest", "line", F.col("least.no_id"),
        F.col("least.id").alias("first_id"), F.col("least.line_no").alias("first_line"),
        F.col("least.key").alias("first_key"),
    )
    links = (
        units.repartition("unit")
        .sortWithinPartitions("unit")
        .mapInArrow(_compare(edits), "digest binary, links long, preceded boolean")
        .groupBy("digest")
        .agg(F.sum("links").alias("links"), F.max("preceded").alias("preceded"))
    )
    links = scratch.save(links, "links")
    scratch.drop("shared", "nodes", "texts", "sizes")
    judged = scratch.save(first.join(small_side(links, scratch.path("links")), "digest", "left"), "judged")
    places = lines.select(
        "id", "key", "line_no",
        (F.col("digest") if short_exact else F.when(is_long, F.col("digest"))).alias("digest"),
        (~is_long & ~_says_something("line")).alias("blank"),
    )
    is_first = F.col("id").eqNullSafe(F.col("least.id")) & (F.col("line_no") == F.col("least.line_no")) & (F.col("key") == F.col("least.key"))
    # From a stored copy, so that AQE can split a line that most documents have.
    return places.join(small_side(judged, scratch.path("judged")), "digest", "left").select(
        "id",
        "key",
        "line_no",
        "copies",
        F.when(F.col("copies").isNotNull(), F.coalesce("links", F.lit(0).cast("long"))).alias("links"),
        (F.col("copies").isNull() | F.col("blank") | (is_first & ~F.coalesce("preceded", F.lit(False)))).alias("kept"),
    )


def drop_repeated_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    short_exact: bool = True,
) -> DataFrame:
    """``df`` without the lines that ``near_lines`` does not keep. A document that loses
    all of its lines, or all but blank ones, goes; every other row, and every other
    column, stays."""
    scratch = Scratch(df.sparkSession, "repeated-lines")
    gone = (
        near_lines(df, id_col, text_col, edits, min_chars, short_exact)
        .filter(~F.col("kept"))
        .groupBy("id", "key")
        .agg(F.collect_set("line_no").alias("gone"))
    )
    gone = scratch.save(gone, "gone")
    gone = small_side(gone, scratch.path("gone")).alias("gone")
    own_id, own_text = (f"c{df.columns.index(c)}" for c in (id_col, text_col))
    plain, text = numbered(df), text_or_empty(own_text)
    joined = plain.withColumn("key", F.xxhash64(text)).alias("rows").join(
        gone,
        F.col(f"rows.{own_id}").eqNullSafe(F.col("gone.id")) & (F.col("rows.key") == F.col("gone.key")),
        "left",
    ).select(*[F.col(f"rows.{c}") for c in plain.columns], F.col("gone.gone").alias("gone"))
    left = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains(F.col("gone"), i))
    changed = F.col("gone").isNotNull()
    rest = F.when(changed, F.array_join("left", "\n")).otherwise(F.col(own_text))
    return (
        joined.withColumn("left", F.when(changed, left))
        .filter(~changed | F.exists("left", _says_something))
        .select(*[(rest if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)])
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_lines(table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "doc_id").drop("key")
