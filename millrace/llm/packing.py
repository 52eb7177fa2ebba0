"""Best-fit packing after Martello-Toth dominance reduction.

Bin packing needs only how many pieces there are of each length, and lengths are at
most the capacity, so the plan is made from a histogram of bounded size however many
documents there are. Numbering the pieces of a length and placing each one by the plan
is Spark's work: no task holds all pieces of a length.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import (
    TEXT_BATCH_BYTES,
    Scratch,
    column,
    give_back_memory,
    grouped,
    prepare_workers,
    table,
    text_or_empty,
)
from .merges import LONGEST, from_tokenizer_file
from .shingles import mixed

CAPACITY = 2048
SEPARATOR = 0
#: Pieces of one length that one task numbers.
NUMBERED_TOGETHER = 50_000
#: Words a worker's cache may hold before it starts anew.
CACHE_ENTRIES = 150_000
#: Characters that are encoded together.
TOGETHER = 250_000

Pattern = tuple[tuple[int, int], ...]


# -- plan ------------------------------------------------------------------------------


class Lengths:
    """Counts by length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.order = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.order.pop(bisect_left(self.order, length))

    def largest_up_to(self, length: int) -> int:
        at = bisect_left(self.order, length + 1)
        return self.order[at - 1] if at else 0

    def two_smallest(self) -> tuple[int, int]:
        a = self.order[0]
        if self.counts[a] > 1:
            return a, a
        return a, self.order[1] if len(self.order) > 1 else 1 << 62


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], dict]:
    """Fix bins that some best solution holds; returns them and the counts left.

    With ``j`` the longest piece in question and ``k`` the longest that fits beside it:
    ``{j}`` dominates if nothing fits; ``{j, k}`` dominates if it fills the bin, or if
    no third piece could fit beside ``j`` and the shortest. Either way any solution can
    be changed to hold that bin without needing more bins. Removals can make more
    pieces reducible, so passes repeat until one changes nothing.
    """
    left, fixed, changed = Lengths(counts), [], True
    while changed:
        changed = False
        for j in reversed(left.order.copy()):
            while (n := left.counts.get(j, 0)) > 0:
                left.take(j, 1)
                k = left.largest_up_to(capacity - j)
                pair = k and (j + k == capacity or j + sum(left.two_smallest()) > capacity)
                partners = left.counts.get(k, 0)
                # put the one back, then take all that the same argument covers
                if k and not pair:
                    _put(left, j)
                    break
                if not k:
                    m, pattern = n, ((j, 1),)
                    _take_if(left, j, n - 1)
                elif k == j:
                    m, pattern = n // 2, ((j, 2),)
                    _take_if(left, j, 2 * m - 1)
                else:
                    m, pattern = min(n, partners), ((j, 1), (k, 1))
                    _take_if(left, j, m - 1)
                    left.take(k, m)
                fixed.append((pattern, m))
                changed = True
    return fixed, left.counts


def _take_if(left: Lengths, length: int, n: int) -> None:
    if n:
        left.take(length, n)


def _put(left: Lengths, length: int) -> None:
    if length not in left.counts:
        left.order.insert(bisect_left(left.order, length), length)
    left.counts[length] = left.counts.get(length, 0) + 1


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing. Bins with the same content are one entry and a number, so a
    length adds at most three entries however many pieces have it."""
    room: dict[int, list[tuple[Pattern, int]]] = {capacity: []}
    rooms: list[int] = []  # residual sizes with bins, in order

    def add(residual: int, pattern: Pattern, bins: int) -> None:
        if bins:
            if not room.setdefault(residual, []):
                rooms.insert(bisect_left(rooms, residual), residual)
            room[residual].append((pattern, bins))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                residual = rooms[at]
                pattern, bins = room[residual].pop()
                if not room[residual]:
                    rooms.pop(at)
            else:
                residual, pattern, bins = capacity, (), n
            each = residual // length
            full, rest = divmod(n, each)
            if full >= bins:
                full, rest = bins, 0
            add(residual - each * length, (*pattern, (length, each)), full)
            if rest:
                add(residual - rest * length, (*pattern, (length, rest)), 1)
            unused = bins - full - (rest > 0)
            if pattern:
                add(residual, pattern, unused)
            n -= full * each + rest
    return [entry for entries in room.values() for entry in entries]


def segments(plan: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, last number, per sequence, first sequence, offset)."""
    rows, numbered, sequence = [], {}, 0
    for pattern, bins in plan:
        offset = 0
        for length, each in pattern:
            start = numbered.get(length, 0)
            numbered[length] = start + each * bins
            rows.append((length, start, start + each * bins - 1, each, sequence, offset))
            offset += each * length
        sequence += bins
    return rows


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    fixed, left = reduce_instance(counts, capacity)
    return fixed + best_fit(left, capacity)


# -- tokens ----------------------------------------------------------------------------


class WordTable:
    """Ids of words of up to 16 bytes. A word's bytes are its key, so no two words share an
    entry; slots are filled as in ``PairMerger``."""

    def __init__(self, entries: int):
        self._empty(max(10, (2 * entries).bit_length()))
        self.ids, self.begin, self.count = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.keys, self.at = np.zeros((2, 1 << bits), "<u8"), np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys[0] + mixed(keys[1])) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each word's entry, or -1."""
        slot, todo = self._slots(keys), np.arange(keys.shape[1])
        out = np.full(len(todo), -1, np.int32)
        while len(todo):
            at = self.at[slot]
            same = (self.keys[0][slot] == keys[0][todo]) & (self.keys[1][slot] == keys[1][todo]) & (at >= 0)
            out[todo[same]] = at[same]
            on = ~same & (at >= 0)
            todo, slot = todo[on], (slot[on] + 1) & (len(self.at) - 1)
        return out

    def add(self, keys: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Enter different words that are not held yet."""
        number = len(self.count) + np.arange(keys.shape[1], dtype=np.int32)
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(counts) - counts))
        self.count = np.concatenate((self.count, counts))
        self.ids = np.concatenate((self.ids, ids.astype("<u4")))
        if 2 * len(self.count) > len(self.at):
            held = self.at >= 0
            number = np.concatenate((self.at[held], number))
            keys = np.concatenate((self.keys[:, held], keys), axis=1)
            self._empty((2 * len(self.count)).bit_length())
        slot, todo = self._slots(keys), np.arange(keys.shape[1])
        while len(todo):
            _, first = np.unique(slot, return_index=True)
            first = first[self.at[slot[first]] < 0]
            self.at[slot[first]] = number[todo[first]]
            self.keys[:, slot[first]] = keys[:, todo[first]]
            left = np.ones(len(todo), bool)
            left[first] = False
            todo, slot = todo[left], (slot[left] + 1) & (len(self.at) - 1)


class WordEncoder:
    """Ids of a tokenizer that drops white space and never merges across it, as bytes
    (little-endian, four per id), remembering those of words.

    A chunk between spaces that is letters of Latin-1 followed by ASCII punctuation is its
    lower-case word and its punctuation, merged many at a time by the file's own merge
    table. Short ones are cut and looked up in arrays, without a string each. Any other chunk
    goes to the tokenizer as it is.
    """

    PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
    #: Kinds of bytes: between chunks, letter, punctuation, any other.
    BETWEEN, LETTER, MARK, OTHER = range(4)
    LONGEST_WORD = 16

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.entries = entries
        self.merger, self.first, self.last = from_tokenizer_file(path)
        self.kinds, self.lower = np.full(256, self.OTHER, np.uint8), np.arange(256, dtype=np.uint8)
        for byte in range(33, 127):
            if not chr(byte).isdigit():
                self.kinds[byte] = self.LETTER if chr(byte).isalpha() else self.MARK
            self.lower[byte] = ord(chr(byte).lower())
        self.kinds[list(b" \n")] = self.BETWEEN
        self.forget()

    def forget(self) -> None:
        self.table = WordTable(self.entries)
        self.chunks: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        parts, words, other = [], {}, []
        for chunk in chunks:
            plain = self.PLAIN.fullmatch(chunk)
            if plain and len(chunk) <= LONGEST // 2:
                word = plain[1].lower()
                parts.append((chunk, word, plain[2]))
                words[word] = words[plain[2]] = b""
            else:
                other.append(chunk)
        words.pop("", None)
        ids, counts = self.merger.merge([w.encode("utf-8") for w in words], self.first, self.last)
        data, stops = ids.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
        words = {w: data[a:b] for w, a, b in zip(words, [0, *stops], stops)} | {"": b""}
        for chunk, word, tail in parts:
            self.chunks[chunk] = words[word] + words[tail]
        found = self.tokenizer.encode_batch_fast(other, add_special_tokens=False)
        for chunk, encoding in zip(other, found):
            self.chunks[chunk] = np.array(encoding.ids, "<u4").tobytes()

    def _known(self, low: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Entries of the words at these places of lower-case bytes; new ones are merged."""
        eights = np.ndarray((len(low) - 7,), "<u8", low, strides=(1,))
        masks = np.array([(1 << 8 * n) - 1 for n in range(9)], "<u8")
        keys = np.stack([
            eights[begin + 8 * half] & masks[np.clip(size - 8 * half, 0, 8)] for half in range(2)
        ])
        entry = self.table.find(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            pairs = np.ascontiguousarray(keys[:, missing].T).view([("a", "<u8"), ("b", "<u8")]).ravel()
            order = np.lexsort((pairs["b"], pairs["a"]))
            pairs = pairs[order]
            fresh = np.concatenate(([True], pairs[1:] != pairs[:-1]))
            once = missing[order[fresh]]
            data = low.tobytes()
            words = [data[a : a + n] for a, n in zip(begin[once].tolist(), size[once].tolist())]
            self.table.add(keys[:, once], *self.merger.merge(words, self.first, self.last))
            entry[missing] = self.table.find(keys[:, missing])
        return entry

    @staticmethod
    def _parts(text: str) -> Iterator[str]:
        """A long text, cut at spaces where there are any."""
        at = 0
        while len(text) - at > 2 * TOGETHER and (stop := text.find(" ", at + TOGETHER)) >= 0:
            yield text[at:stop]
            at = stop + 1
        yield text[at:]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        if len(self.table.count) > self.entries or len(self.chunks) > self.entries // 3:
            self.forget()
        if len(texts) == 1:
            return [b"".join(self._encode([part])[0] for part in self._parts(texts[0]))]
        return self._encode(texts)

    def _encode(self, texts: list[str]) -> list[bytes]:
        coded = [t.encode("utf-8") for t in texts]
        data = np.frombuffer(b" ".join([b"", *coded, b" " * 32]), np.uint8)
        kinds, low = self.kinds[data], self.lower[data]
        lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, which but two are letters
        lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
        kinds[lead] = kinds[lead + 1] = self.LETTER
        capital = lead[data[lead + 1] < 0x9F] + 1
        low[capital] |= 0x20
        # Runs of one kind; a chunk is the runs between two that part chunks.
        begin = np.concatenate(([0], np.flatnonzero(kinds[1:] != kinds[:-1]) + 1))
        kind, size = kinds[begin], np.diff(begin, append=len(data))
        first = np.concatenate(([False], kind[:-1] == self.BETWEEN))
        inside = kind != self.BETWEEN
        begin, kind, size, first = begin[inside], kind[inside], size[inside], first[inside]
        if not len(begin):
            return [b""] * len(texts)
        heads = np.flatnonzero(first)
        odd = (kind == self.OTHER) | (first != (kind == self.LETTER)) | (size > self.LONGEST_WORD)
        odd_chunk = np.logical_or.reduceat(odd, heads)
        odd = odd_chunk[np.cumsum(first) - 1]
        whole = heads[odd_chunk]  # the first run stands for all of such a chunk
        stops = (begin + size)[np.append(heads[1:], len(begin))[odd_chunk] - 1]
        start, count = np.zeros(len(begin), np.int64), np.zeros(len(begin), np.int64)
        plain = np.flatnonzero(~odd)
        entry = self._known(low, begin[plain], size[plain])
        start[plain], count[plain] = self.table.begin[entry], self.table.count[entry]
        ids = self.table.ids
        if len(whole):
            held = data.tobytes()
            chunks = [held[a:b].decode("utf-8") for a, b in zip(begin[whole].tolist(), stops.tolist())]
            different = dict.fromkeys(chunks)
            self._learn([c for c in different if c not in self.chunks])
            coded_chunks = [self.chunks[c] for c in different]
            sizes = np.fromiter(map(len, coded_chunks), np.int64, len(coded_chunks)) // 4
            number = dict(zip(different, range(len(different))))
            number = np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
            start[whole], count[whole] = (len(ids) + np.cumsum(sizes) - sizes)[number], sizes[number]
            ids = np.concatenate((ids, np.frombuffer(b"".join(coded_chunks), "<u4")))
        before = np.cumsum(count) - count
        out = ids[np.repeat(start - before, count) + np.arange(count.sum())].tobytes()
        # Where each text ends among the runs, and so among the ids.
        ends = np.searchsorted(begin, np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) + 1))
        ends = (4 * np.append(before, count.sum())[ends]).tolist()
        return [out[a:b] for a, b in zip([0, *ends], ends)]


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _cut(path: str, capacity: int, with_ids: bool):
    step, end = 4 * capacity, SEPARATOR.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        for batch in batches:
            row, piece, length, crc, ids = [], [], [], [], []
            texts = grouped((t.as_py() for t in batch.column("text")), TOGETHER)
            encoded = chain.from_iterable(map(encoder.encode_all, texts))
            for i, tokens in enumerate(encoded):
                tokens += end
                for n, at in enumerate(range(0, len(tokens), step)):
                    part = tokens[at : at + step]
                    row.append(i)
                    piece.append(n)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = [
                batch.column("id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array([n * capacity for n in piece], pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            names = ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)]
            yield pa.RecordBatch.from_arrays(columns, names)
        encoder.forget()
        give_back_memory()

    return run


def token_pieces(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """``id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``
    (little-endian, four bytes per id) of every piece of every document."""
    rows = df.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long,"
        " length long, ids_crc32 long" + ", ids binary" * with_ids
    )
    return rows.mapInArrow(_cut(tokenizer_path, capacity, with_ids), schema)


# -- placing ---------------------------------------------------------------------------


def place(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; ``pieces`` should be a stored table."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = segments(plan_bins(counts, capacity))
    plan = spark.createDataFrame(
        rows, "length long, first long, last long, each long, sequence long, at long"
    )
    salts = max(1, sum(counts.values()) // NUMBERED_TOGETHER)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(salts)))
    group = Window.partitionBy("length", "salt")
    numbered = salted.withColumn(
        "own", F.row_number().over(group.orderBy("id", "piece", "ids_crc32")) - F.lit(1)
    )
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn(
            "before",
            F.sum("n").over(
                Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
            ),
        )
        .select("length", "salt", F.coalesce("before", F.lit(0)).alias("before"))
    )
    numbered = numbered.join(before, ["length", "salt"]).withColumn(
        "number", F.col("before") + F.col("own")
    )
    # The plan has a few rows per length up to the capacity, whatever the input's size.
    placed = numbered.join(
        F.broadcast(plan),
        (numbered["length"] == plan["length"]) & F.col("number").between(plan["first"], plan["last"]),
    ).drop(plan["length"])
    k = F.col("number") - F.col("first")
    return placed.withColumn(
        "sequence_id", F.col("sequence") + F.floor(k / F.col("each")).cast("long")
    ).withColumn("offset", F.col("at") + k % F.col("each") * F.col("length"))


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens.

    A document is its ids and one separator; only longer ones are cut, into pieces of
    ``capacity``. A NULL text is an empty one (its separator alone). Repeated and NULL
    ids are packed like any others. An empty table gives an empty result. Other columns
    are not looked at.
    """
    spark = df.sparkSession
    prepare_workers(spark, TEXT_BATCH_BYTES)
    pieces = Scratch(spark, "packing").save(
        token_pieces(df, tokenizer_path, id_col, text_col, capacity, with_ids), "pieces"
    )
    kept = ["piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    return place(spark, pieces, capacity).select(
        F.col("id").alias(id_col), *kept, "sequence_id", "offset"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
