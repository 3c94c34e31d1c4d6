"""Minimal acyclic transducers: sorted terms in, the place of each term in that order out.

Built from sorted terms one by one (Daciuk, Mihov, Watson and Watson, Incremental construction of
minimal acyclic finite-state automata, 2000). An arc carries the number of terms that its state puts
before it; the sum along the path of a term is its ordinal (minimal perfect hashing with automata).
Arcs are kept as sorted arrays, so that many tokens are followed at once.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class Transducer:
    """Arcs sorted by state * 256 + byte, with the state behind them and the terms before them; state 0 is the start."""

    def __init__(self, keys: np.ndarray, targets: np.ndarray, before: np.ndarray, final: np.ndarray):
        self.keys, self.targets, self.before, self.final = keys, targets, before, final

    @property
    def nbytes(self) -> int:
        return self.keys.nbytes + self.targets.nbytes + self.before.nbytes + self.final.nbytes

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.keys), len(self.final)], "<i8")
        return b"".join(a.tobytes() for a in (sizes, self.keys, self.targets, self.before, self.final))

    @classmethod
    def from_bytes(cls, stored: bytes) -> Transducer:
        arcs, states = np.frombuffer(stored, "<i8", 2).tolist()
        keys = np.frombuffer(stored, "<i8", arcs, 16)
        targets = np.frombuffer(stored, "<i4", arcs, 16 + 8 * arcs)
        before = np.frombuffer(stored, "<i4", arcs, 16 + 12 * arcs)
        return cls(keys, targets, before, np.frombuffer(stored, bool, states, 16 + 16 * arcs))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of the bytes of each span, -1 where they are no term. All spans take a step at a time."""
        out = np.full(len(starts), -1, np.int64)
        if len(self.keys) == 0:
            return out
        left, at = np.arange(len(starts)), starts.copy()
        state, sums = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        while len(left):
            done = at == ends[left]
            if done.any():
                whole = done & self.final[state]
                out[left[whole]] = sums[whole]
                go = ~done
                left, at, state, sums = left[go], at[go], state[go], sums[go]
            key = state * 256 + data[at]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[arc] == key
            arc, left, at = arc[known], left[known], at[known] + 1
            state, sums = self.targets[arc].astype(np.int64), sums[known] + self.before[arc]
        return out


def build(terms: Iterable[bytes]) -> Transducer:
    """The minimal transducer of distinct terms in byte order; the empty term is not allowed."""
    # A frozen state is (final, arcs); an open state on the path of the last term is [final, arcs].
    register: dict[tuple, int] = {}
    frozen: list[tuple] = []
    counts: list[int] = []
    path: list[list] = [[False, []]]
    last = b""

    def freeze(depth: int) -> None:
        """Close the open states below ``depth``; equal ones become one."""
        while len(path) > depth + 1:
            final, arcs = path.pop()
            state = (final, tuple(arcs))
            number = register.get(state)
            if number is None:
                number = register[state] = len(frozen)
                frozen.append(state)
                counts.append(final + sum(counts[t] for _, t in arcs))
            path[-1][1].append((last[len(path) - 1], number))

    for term in terms:
        if term <= last:
            raise ValueError("terms must be distinct and in byte order")
        shared = 0
        for a, b in zip(term, last):
            if a != b:
                break
            shared += 1
        freeze(shared)
        path.extend([False, []] for _ in range(len(term) - shared))
        path[-1][0] = True
        last = term
    freeze(0)
    # The start comes first: the numbers of all frozen states move up by one.
    states = [(path[0][0], tuple(path[0][1])), *frozen]
    keys, targets, before = [], [], []
    for number, (final, arcs) in enumerate(states):
        terms_before = int(final)
        for byte, target in arcs:
            keys.append(number * 256 + byte)
            targets.append(target + 1)
            before.append(terms_before)
            terms_before += counts[target]
    return Transducer(np.array(keys, "<i8"), np.array(targets, "<i4"), np.array(before, "<i4"), np.array([f for f, _ in states], bool))
