"""Minimal acyclic transducers: sets of terms that number their members in byte order.

Terms arrive sorted, so the states that the next term cannot reach any more are final:
each is looked up among the states there are, by its finality and its arcs, and merged
with an equal one. An arc carries the number of terms that come before its own, so the
sum along a term's path is the term's ordinal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa


@dataclass
class Transducer:
    """Arcs sorted by state and label; ``key`` is both. The last state is the first one
    of every path."""

    key: np.ndarray
    target: np.ndarray
    before: np.ndarray
    final: np.ndarray
    terms: int

    @property
    def root(self) -> int:
        return len(self.final) - 1

    def to_bytes(self) -> bytes:
        out = pa.BufferOutputStream()
        parts = (self.key, self.target, self.before, self.final, np.array([self.terms]))
        batch = pa.record_batch([pa.array([p]) for p in parts], names=[str(i) for i in range(5)])
        with pa.ipc.new_stream(out, batch.schema) as writer:
            writer.write_batch(batch)
        return out.getvalue().to_pybytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        batch = pa.ipc.open_stream(data).read_next_batch()
        *parts, terms = (c.values.to_numpy(zero_copy_only=False) for c in batch.columns)
        return cls(*parts, int(terms[0]))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Ordinals of the terms ``data[start : start + size]``, -1 for strangers. All
        terms take their next step together; one without an arc to take drops out."""
        out = np.full(len(starts), -1, np.int64)
        at = np.arange(len(starts))
        state = np.full(len(starts), self.root, np.int64)
        number = np.zeros(len(starts), np.int64)
        step = 0
        while len(at):
            ended = sizes[at] == step
            if ended.any():
                done = ended & self.final[state]
                out[at[done]] = number[done]
                at, state, number = at[~ended], state[~ended], number[~ended]
            if not len(at) or not len(self.key):
                break
            wanted = state * 256 + data[starts[at] + step]
            arc = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            fine = self.key[arc] == wanted
            at, arc = at[fine], arc[fine]
            state, number = self.target[arc].astype(np.int64), number[fine] + self.before[arc]
            step += 1
        return out

    def __iter__(self) -> Iterator[bytes]:
        """All terms, in the order of their ordinals."""
        first = np.searchsorted(self.key, np.arange(len(self.final) + 1) * 256)
        path, stack = bytearray(), [(self.root, 0, False)]
        while stack:
            state, depth, entered = stack.pop()
            if not entered:
                if self.final[state]:
                    yield bytes(path[:depth])
                arcs = range(int(first[state]), int(first[state + 1]))
                stack += [(arc, depth, True) for arc in reversed(arcs)]
            else:  # an arc to take
                path[depth:] = bytes([int(self.key[state]) & 255])
                stack.append((int(self.target[state]), depth + 1, False))


def build(terms: Iterable[bytes]) -> Transducer:
    """The smallest transducer of distinct terms given in byte order."""
    known: dict[tuple, int] = {}
    states: list[tuple] = []
    below: list[int] = []  # terms that can be read from a state
    path: list[list] = [[False, []]]  # the states of the last term, not yet merged
    labels = bytearray()

    def settle(node: list) -> int:
        shape = (node[0], tuple(node[1]))
        state = known.get(shape)
        if state is None:
            state = known[shape] = len(states)
            states.append(shape)
            below.append(node[0] + sum(below[t] for _, t in node[1]))
        return state

    def settle_to(depth: int) -> None:
        while len(labels) > depth:
            state = settle(path.pop())
            path[-1][1].append((labels.pop(), state))

    last = b""
    for term in terms:
        shared = next((i for i, (a, b) in enumerate(zip(last, term)) if a != b), min(len(last), len(term)))
        settle_to(shared)
        for label in term[shared:]:
            labels.append(label)
            path.append([False, []])
        path[-1][0] = True
        last = term
    settle_to(0)
    # The first state is not shared with any other, so that it can come last.
    states.append((path[0][0], tuple(path[0][1])))
    below.append(path[0][0] + sum(below[t] for _, t in path[0][1]))
    key, target, before = [], [], []
    for state, (final, arcs) in enumerate(states):
        number = int(final)
        for label, to in arcs:
            key.append(state * 256 + label)
            target.append(to)
            before.append(number)
            number += below[to]
    final = np.array([s[0] for s in states], bool)
    as_ints = lambda values, kind: np.array(values, kind)
    return Transducer(as_ints(key, np.int64), as_ints(target, np.int32), as_ints(before, np.int64), final, below[-1])
