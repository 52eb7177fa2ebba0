"""Byte-pair merging of many words at once, and word caches on top of it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from pathlib import Path

import numpy as np

#: Words of more bytes than this are left to the caller.
LONGEST = 48
_NONE = np.int32(2**31 - 1)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairMerger:
    """Merges the adjacent pair of lowest rank, leftmost first, until no pair is known.

    All words of a call advance together: a matrix of symbols with one row per word and
    a matrix of the ranks of neighbours, of which a merge changes two entries.
    """

    def __init__(self, left, right, rank, merged):
        order = np.argsort(rank, kind="stable")
        self.merged = np.asarray(merged, np.int32)[order]
        self.rank = np.asarray(rank, np.int64)[order]
        keys = self._keys(np.asarray(left)[order], np.asarray(right)[order])
        self.shift = np.uint64(64 - max(10, int(len(keys) * 16).bit_length()))
        self.slots = np.full(1 << (64 - int(self.shift)), np.uint64(2**64 - 1))
        self.at = np.full(len(self.slots), _NONE, np.int32)
        place, todo, self.depth = self._hash(keys), np.arange(len(keys)), 0
        while len(todo):
            self.depth += 1
            slot = place[todo]
            free = self.slots[slot] == np.uint64(2**64 - 1)
            _, first = np.unique(slot, return_index=True)
            wins = np.zeros(len(todo), bool)
            wins[first] = True
            wins &= free
            self.slots[slot[wins]] = keys[todo[wins]]
            self.at[slot[wins]] = todo[wins]
            todo = todo[~wins]
            place[todo] = (place[todo] + 1) & (len(self.slots) - 1)

    @staticmethod
    def _keys(left, right):
        return (np.asarray(left).astype(np.uint64) << np.uint64(32)) | np.asarray(right).astype(np.uint64)

    def _hash(self, keys):
        return ((keys * _MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of the merge of each pair in order of rank; a large one for no merge."""
        keys = self._keys(left, right)
        slot = self._hash(keys)
        found = np.where(self.slots[slot] == keys, self.at[slot], _NONE)
        for _ in range(self.depth - 1):
            slot = (slot + 1) & (len(self.slots) - 1)
            found = np.where(self.slots[slot] == keys, self.at[slot], found)
        return found

    def _merge(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, width = symbols.shape
        lengths = lengths.copy()
        if width < 2:
            return symbols, lengths
        columns = np.arange(width)
        ranks = np.full((n, width), _NONE, np.int32)
        pairs = columns[None, :-1] < lengths[:, None] - 1
        ranks[:, :-1][pairs] = self.find(symbols[:, :-1][pairs], symbols[:, 1:][pairs])
        live = np.arange(n)
        x, r = symbols.copy(), ranks
        out = symbols.copy()
        while len(live):
            j = r.argmin(axis=1)
            rows = np.arange(len(live))
            best = r[rows, j]
            more = best != _NONE
            if not more.all():
                out[live[~more]] = x[~more]
                live, x, r, j, best = live[more], x[more], r[more], j[more], best[more]
                rows = np.arange(len(live))
                if not len(live):
                    break
            x[rows, j] = self.merged[best]
            after = columns[None, :] > j[:, None]
            x[:, :-1] = np.where(after[:, :-1], x[:, 1:], x[:, :-1])
            from_j = columns[None, :-1] >= j[:, None]
            r[:, :-1] = np.where(from_j, r[:, 1:], r[:, :-1])
            r[:, -1] = _NONE
            lengths[live] -= 1
            left_ok = j > 0
            at = rows[left_ok]
            r[at, j[left_ok] - 1] = self.find(x[at, j[left_ok] - 1], x[at, j[left_ok]])
            right_ok = j + 1 < lengths[live]
            at = rows[right_ok]
            r[at, j[right_ok]] = self.find(x[at, j[right_ok]], x[at, j[right_ok] + 1])
        return out, lengths

    def merge(self, words: Sequence[bytes], first: np.ndarray, last: np.ndarray | None = None):
        """Symbols of all words one after the other, and how many each word has.

        ``first`` gives the symbol of a byte, ``last`` (if any) that of a word's last one.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        symbols = first[flat].astype(np.int32)
        if last is not None and len(words):
            ends = starts + sizes - 1
            symbols[ends] = last[flat[ends]]
        counts = np.zeros(len(words), np.int64)
        parts = []
        for low, high in ((0, 8), (8, 14), (14, 24), (24, LONGEST)):
            rows = np.flatnonzero((sizes > low) & (sizes <= high))
            if len(rows):
                columns = np.arange(high)
                inside = columns[None, :] < sizes[rows, None]
                x = np.full((len(rows), high), -1, np.int32)
                x[inside] = symbols[(starts[rows, None] + columns)[inside]]
                x, counts[rows] = self._merge(x, sizes[rows])
                parts.append((rows, x))
        begin = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        for rows, x in parts:
            inside = np.arange(x.shape[1])[None, :] < counts[rows, None]
            out[(begin[rows, None] + np.arange(x.shape[1]))[inside]] = x[inside]
        return out, counts


def byte_symbols() -> dict[int, str]:
    """The printable stand-ins that byte-level vocabularies use for bytes: printable
    Latin-1 bytes stand for themselves, the others count up from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def from_tokenizer_file(path: str) -> tuple[PairMerger, np.ndarray, np.ndarray]:
    """The merges of a BPE file in JSON, the symbols of bytes, and those at word ends."""
    model = json.loads(Path(path).read_text(encoding="utf-8"))["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = [vocab[a] for a, _ in merges]
    right = [vocab[b] for _, b in merges]
    merged = [vocab[a + b] for a, b in merges]
    symbols = byte_symbols()
    first = np.array([vocab[symbols[b]] for b in range(256)])
    last = np.array([vocab[symbols[b] + suffix] for b in range(256)])
    return PairMerger(left, right, range(len(merges)), merged), first, last


def from_ranks(ranks: dict[bytes, int]) -> tuple[PairMerger, np.ndarray]:
    """Any two tokens whose bytes together are a token may merge, at that token's rank."""
    left, right, merged = [], [], []
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    first = np.array([ranks[bytes([b])] for b in range(256)])
    return PairMerger(left, right, merged, merged), first
