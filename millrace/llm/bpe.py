"""Byte-level BPE: pre-tokenisation without regex, cached pair merging, and decoding.

Code points are mapped to classes, classes to transition functions of a small automaton,
and the functions are composed by a blocked prefix scan (composition is associative, so
blocks advance side by side). The states and the neighbouring classes tell where tokens
of the pattern begin. Only slices between those places reach the merging.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import column, give_back_memory, grouped, prepare_workers, table, text_or_empty
from .merges import LONGEST, from_ranks

#: Slices a worker's cache may hold, and code points per block of the scan.
CACHE_ENTRIES = 400_000
BLOCK = 256

LETTER, NUMBER, SPACE, WHITE, OTHER, END = range(6)
#: Unicode's White_Space; fixed values.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# States: 0 an apostrophe here may begin a contraction, 1 it may not, 2 one letter of a
# contraction is still to come, 3 two are. A function takes two bits per state.
_FREE, _BOUND, _ONE, _TWO = range(4)


def _function(*to: int) -> int:
    return sum(s << (2 * i) for i, s in enumerate(to))


IDENTITY = _function(_FREE, _BOUND, _ONE, _TWO)
TO_FREE = _function(_FREE, _FREE, _FREE, _ONE)
TO_BOUND = _function(_BOUND, _BOUND, _BOUND, _BOUND)
RESET = _function(_FREE, _FREE, _FREE, _FREE)
SHORT = _function(_ONE, _BOUND, _BOUND, _BOUND)
LONG = _function(_TWO, _BOUND, _BOUND, _BOUND)


@cache
def compositions() -> np.ndarray:
    """``[f, g]``: first f, then g."""
    f, g = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    out = np.zeros((256, 256), np.uint8)
    for s in range(4):
        out |= (((g >> (2 * ((f >> (2 * s)) & 3))) & 3) << (2 * s)).astype(np.uint8)
    return out


@cache
def classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    out[WHITE_SPACE] = WHITE
    out[32] = SPACE
    return out


def scan(functions: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """State after each position, from state 0: blocks are scanned side by side, their
    totals by doubling, and each block's own prefixes are applied to its first state."""
    n, compose = len(functions), compositions()
    blocks = -(-n // block)
    padded = np.full(blocks * block, IDENTITY, np.uint8)
    padded[:n] = functions
    by_step = np.ascontiguousarray(padded.reshape(blocks, block).T)
    for t in range(1, block):
        by_step[t] = compose[by_step[t - 1], by_step[t]]
    total, step = by_step[-1].copy(), 1
    while step < blocks:
        total[step:] = compose[total[:-step], total[step:]]
        step *= 2
    start = np.zeros(blocks, np.uint8)
    start[1:] = total[:-1] & 3
    return np.ascontiguousarray(((by_step >> (2 * start)) & 3).T).reshape(-1)[:n]


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where a match of the pattern begins; ``ends`` are places of text separators."""
    kind = classes()[points]
    kind[ends] = END
    after = np.append(kind[1:], np.uint8(END))
    before = np.concatenate(([np.uint8(END)], kind[:-1]))
    function = np.array([TO_FREE, TO_FREE, TO_BOUND, TO_FREE, TO_BOUND, RESET], np.uint8)[kind]
    quote = np.flatnonzero((points == ord("'")) & (kind == OTHER))
    if len(quote):
        padded = np.append(points, [0, 0])
        padded[ends] = 0
        one, two = padded[quote + 1], padded[quote + 2]
        function[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))
        pair |= (one == ord("l")) & (two == ord("l"))
        function[quote[pair]] = LONG
    state = scan(function)
    ahead = np.concatenate(([np.uint8(_FREE)], state[:-1]))
    contracted = np.concatenate(([False], ahead[:-1] == _ONE))  # one ended just before
    white, white_before = (kind == SPACE) | (kind == WHITE), (before == SPACE) | (before == WHITE)
    white_after = (after == SPACE) | (after == WHITE) | (after == END)
    begins = np.where(
        white,
        ~white_before | ~white_after,
        np.where(white_before, before == WHITE, (kind != before) | contracted),
    )
    begins &= ahead < _ONE
    begins |= (kind == END) | (before == END)
    return begins


class ByteBPE:
    """Encodes and decodes by a table of ranks, remembering the ids of slices."""

    def __init__(self, ranks: dict[bytes, int], entries: int = CACHE_ENTRIES):
        self.ranks, self.entries = ranks, entries
        self.merger, self.first = from_ranks(ranks)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.cache: dict[str, list[int]] = {}

    @classmethod
    def from_file(cls, path: str) -> ByteBPE:
        lines = map(bytes.split, Path(path).read_bytes().splitlines())
        return cls({base64.b64decode(line[0]): int(line[1]) for line in lines if line})

    def slices(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Slices of all texts, where each begins in its text, and slices per text."""
        whole = "\0".join(texts) + "\0"
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1) - 1
        starts = np.flatnonzero(boundaries(points, ends))
        text_of = np.searchsorted(ends, starts)
        inside = starts != ends[text_of]
        stops = np.append(starts[1:], len(points))[inside]
        starts, text_of = starts[inside], text_of[inside]
        pieces = [whole[a:b] for a, b in zip(starts.tolist(), stops.tolist())]
        offsets = starts - (ends - sizes)[text_of]
        return pieces, offsets, np.bincount(text_of, minlength=len(texts))

    def _long(self, word: bytes) -> list[int]:
        """Merges one long slice by a queue of pairs over a linked list."""
        ranks, n = self.ranks, len(word)
        token = [word[i : i + 1] for i in range(n)]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        rank = lambda i: ranks.get(token[i] + token[after[i]]) if after[i] >= 0 else None
        queue = [(r, i, token[i], token[i + 1]) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i] if token[i] == a else -1
            if j < 0 or token[j] != b:
                continue  # one of the two has been merged meanwhile
            token[i], token[j] = a + b, b""
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(queue, (r, k, token[k], token[after[k]]))
        return [ranks[t] for t in token if t]

    def _learn(self, pieces: list[str]) -> None:
        if len(self.cache) > self.entries:
            self.cache.clear()
        new = [p for p in dict.fromkeys(pieces) if p not in self.cache]
        words = [p.encode("utf-8") for p in new]
        short = [i for i, w in enumerate(words) if len(w) <= LONGEST]
        ids, counts = self.merger.merge([words[i] for i in short], self.first)
        ids, stops = ids.tolist(), np.cumsum(counts).tolist()
        for i, a, b in zip(short, [0, *stops], stops):
            self.cache[new[i]] = ids[a:b]
        for piece, word in zip(new, words):
            if len(word) > LONGEST:
                self.cache[piece] = self._long(word)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return [ids for ids, _ in self.encode_slices(texts, False)]

    def encode_slices(self, texts: list[str], offsets: bool = True) -> Iterator[tuple[list[int], list[tuple] | None]]:
        """Per text its ids and, if asked for, for each slice where it begins and ends in
        the text and how many ids it has."""
        pieces, starts, counts = self.slices(texts)
        self._learn(pieces)
        known, at = self.cache, 0
        for n in counts.tolist():
            own = pieces[at : at + n]
            found = list(map(known.__getitem__, own))
            places = None
            if offsets:
                begins = starts[at : at + n].tolist()
                places = [(a, a + len(p), len(ids)) for a, p, ids in zip(begins, own, found)]
            yield list(chain.from_iterable(found)), places
            at += n

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode_slices(self, ids: list[int], places: list[tuple]) -> list[tuple[int, int, str]]:
        """The slices that ``places`` names, each decoded by itself: where it begins and
        ends, and its text."""
        out, at = [], 0
        for begin, end, n in places:
            text = self.decode(ids[at : at + n]).decode("utf-8")
            if len(text) != end - begin:
                raise ValueError(f"ids give {len(text)} characters for those from {begin} to {end}")
            out.append((begin, end, text))
            at += n
        if at != len(ids):
            raise ValueError(f"offsets name {at} of {len(ids)} ids")
        return out


@cache
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE.from_file(path)


_PLACES = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("ids", pa.int32())]))
_SLICES = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))


def _named(kind: pa.ListType, rows: list[list[tuple]]) -> pa.Array:
    names = [f.name for f in kind.value_type]
    return pa.array([[dict(zip(names, r)) for r in row] for row in rows], kind)


def _digests(path: str, with_ids: bool, with_offsets: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            counts, digests, decoded, ids_of, places_of = [], [], [], [], []
            for texts in grouped(t.as_py() for t in batch.column("text")):
                for ids, places in bpe.encode_slices(texts, with_offsets):
                    counts.append(len(ids))
                    decimal = " ".join(map(bpe.decimal.__getitem__, ids))
                    digests.append(hashlib.sha256(decimal.encode()).hexdigest())
                    decoded.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
                    if with_ids:
                        ids_of.append(ids)
                    if with_offsets:
                        places_of.append(places)
            columns = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int32())))
                names.append("ids")
            if with_offsets:
                columns.append(_named(_PLACES, places_of))
                names.append("offsets")
            yield pa.RecordBatch.from_arrays(columns, names)
        bpe.cache.clear()
        give_back_memory()

    return run


def encode(
    df: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    with_offsets: bool = False,
) -> DataFrame:
    """One row per input row: id, ``n_tokens``, digests of the ids and of the bytes they
    decode to and, if asked for, the ``ids`` and the ``offsets``: where each slice begins
    and ends in the text, in code points, and how many of the ids are its own. A slice
    starts and ends between characters, so it can be decoded without its neighbours.

    A NULL text is an empty one, of no tokens. Repeated and NULL ids give a row each. An
    empty table gives an empty result. Other columns are not looked at.
    """
    prepare_workers(df.sparkSession)
    rows = df.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    schema = (
        f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string,"
        " decoded_sha256 string" + ", ids array<int>" * with_ids
        + ", offsets array<struct<begin:int,end:int,ids:int>>" * with_offsets
    )
    return rows.mapInArrow(_digests(ranks_path, with_ids, with_offsets), schema).withColumnRenamed("id", id_col)


def decode(
    df: DataFrame,
    ranks_path: str,
    id_col: str = "doc_id",
    ids_col: str = "ids",
    offsets_col: str | None = None,
) -> DataFrame:
    """Id and ``text`` of every row of ids; NULL ids give an empty text.

    With the offsets of ``encode`` the text is put together from its slices, which are a
    column ``slices`` (``begin``, ``end``, ``text``) too. Offsets that do not fit the ids are an
    error; NULL ones are those of no slice.
    """
    prepare_workers(df.sparkSession)
    rows = df.select(
        column(id_col).alias("id"), column(ids_col).cast("array<int>").alias("ids"),
        *([column(offsets_col).alias("offsets")] if offsets_col else []),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(ranks_path)
        for batch in batches:
            ids_of = [i.as_py() or [] for i in batch.column("ids")]
            if not offsets_col:
                texts = [bpe.decode(ids).decode("utf-8", "replace") for ids in ids_of]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])
                continue
            places = [[(p["begin"], p["end"], p["ids"]) for p in o.as_py() or []] for o in batch.column("offsets")]
            slices = [bpe.decode_slices(ids, some) for ids, some in zip(ids_of, places)]
            texts = ["".join(text for _, _, text in some) for some in slices]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string()), _named(_SLICES, slices)], ["id", "text", "slices"]
            )

    schema = f"id {rows.schema['id'].dataType.simpleString()}, text string"
    if offsets_col:
        schema += ", slices array<struct<begin:int,end:int,text:string>>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
