"""Weighted acyclic automata that give the count of a phrase when they read it.

A phrase is a row of labels (64-bit numbers other than 0). The automaton has one
layer of states a word: an arc carries a label, the count of the phrase read so
far, and leads to a state of the next layer. States from which the same phrases
go on with the same counts are one state.

All steps work on whole layers in numpy. An automaton is built from sorted
phrases in one pass; automata of shards are united by merging their sorted
phrases and adding the counts of equal ones.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

from namelens.llm.counting import sort_rows
from namelens.llm.words import mixed, range_hashes

FINAL = -1


@dataclass
class CountAutomaton:
    """``first[k]`` has the arc offsets of the states of layer k, the others one entry an arc."""

    first: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]
    targets: list[np.ndarray]

    @classmethod
    def from_sorted(cls, phrases: np.ndarray, counts: np.ndarray, summed: bool = True) -> CountAutomaton:
        """From different rows in order, short ones filled up with 0.

        ``counts`` say how often a row occurs without its continuation; an arc's
        weight is the sum over all rows that begin as it does. Unless ``summed``,
        it is the count of the row that ends there, 0 without such a row.
        """
        n, depth = phrases.shape
        equal = np.zeros(n, dtype=np.int64)
        if n:
            same = np.cumprod(phrases[1:] == phrases[:-1], axis=1)
            equal[1:] = same.sum(axis=1)
        sums = np.r_[0, np.cumsum(counts)]
        rows, first, labels, weights = [], [np.zeros(1, dtype=np.int64)], [], []
        for k in range(depth):
            breaks = np.flatnonzero(equal <= k)
            own = breaks[phrases[breaks, k] != 0]
            ends = np.r_[breaks, n][np.searchsorted(breaks, own, side="right")]
            rows.append(own)
            labels.append(phrases[own, k])
            if summed:
                weights.append(sums[ends] - sums[own])
            else:
                # A row comes before its continuations.
                over = phrases[own, k + 1] == 0 if k + 1 < depth else np.ones(len(own), dtype=bool)
                weights.append(np.where(over, counts[own], 0))
            starts = np.zeros(1, dtype=np.int64) if k == 0 else np.searchsorted(own, rows[k - 1])
            first.append(starts)
        offsets = [np.r_[starts, len(arcs)] for starts, arcs in zip(first[1:], labels)]
        targets = [np.arange(len(arcs)) for arcs in labels]
        if targets:
            targets[-1] = np.full(len(labels[-1]), FINAL)
        automaton = cls(offsets, labels, weights, targets)
        automaton._share_states()
        return automaton

    def _share_states(self) -> None:
        """Let states with the same arcs be one, from the last layer to the first."""
        for k in range(len(self.labels) - 1, 0, -1):
            first, sizes = self.first[k], np.diff(self.first[k])
            arcs = mixed(
                mixed(self.labels[k]) + mixed(self.weights[k].astype(np.uint64)) * np.uint64(3) + self.targets[k].astype(np.uint64)
            )
            signs = range_hashes(arcs, first[:-1], first[1:])
            _, kept, state = np.unique(signs, return_index=True, return_inverse=True)
            if not self._equal_arcs(k, kept[state], sizes):
                kept = state = np.arange(len(sizes))
            into = np.where(sizes == 0, FINAL, state)
            self.targets[k - 1] = into
            # Arcs of the states that stay.
            lengths = sizes[kept]
            at = np.repeat(first[:-1][kept] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())
            self.first[k] = np.r_[0, np.cumsum(lengths)]
            self.labels[k], self.weights[k], self.targets[k] = self.labels[k][at], self.weights[k][at], self.targets[k][at]

    def _equal_arcs(self, k: int, like: np.ndarray, sizes: np.ndarray) -> bool:
        """Whether every state has the arcs of the state it is taken for."""
        if (sizes[like] != sizes).any():
            return False
        first = self.first[k]
        at = np.repeat(first[:-1][like] - first[:-1], sizes) + np.arange(len(self.labels[k]))
        return all((v[at] == v).all() for v in (self.labels[k], self.weights[k], self.targets[k]))

    @property
    def depth(self) -> int:
        return len(self.labels)

    def _next(self, k: int, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Arcs of layer k that leave ``states``, and the place of the state each leaves."""
        low = self.first[k][states]
        sizes = self.first[k][states + 1] - low
        origin = np.repeat(np.arange(len(states)), sizes)
        arcs = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        return arcs, origin

    def frequent(self, least: int, shortest: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Phrases of every length from ``shortest`` with a count of ``least`` or more: rows and counts.

        A continuation is no more frequent than its beginning, so the rest is not walked through.
        """
        out = []
        states = np.zeros(1, dtype=np.int64)
        read = np.zeros((1, 0), dtype=np.uint64)
        for k in range(self.depth):
            arcs, origin = self._next(k, states)
            kept = self.weights[k][arcs] >= least
            arcs, origin = arcs[kept], origin[kept]
            read = np.concatenate((read[origin], self.labels[k][arcs][:, None]), axis=1)
            if k + 1 >= shortest:
                out.append((read, self.weights[k][arcs]))
            going = self.targets[k][arcs] != FINAL
            read, states = read[going], self.targets[k][arcs][going]
        return out

    def phrases(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows and counts that the automaton was built from."""
        rows, counts = [], []
        states, read = np.zeros(1, dtype=np.int64), np.zeros((1, 0), dtype=np.uint64)
        for k in range(self.depth):
            arcs, origin = self._next(k, states)
            weights, targets = self.weights[k][arcs], self.targets[k][arcs]
            read = np.concatenate((read[origin], self.labels[k][arcs][:, None]), axis=1)
            going = targets != FINAL
            ended = weights.copy()
            if k + 1 < self.depth:
                summed = np.r_[0, np.cumsum(self.weights[k + 1])]
                after = targets[going]
                ended[going] -= summed[self.first[k + 1][after + 1]] - summed[self.first[k + 1][after]]
            stop = ended > 0
            filled = np.zeros((int(stop.sum()), self.depth), dtype=np.uint64)
            filled[:, : k + 1] = read[stop]
            rows.append(filled)
            counts.append(ended[stop])
            read, states = read[going], targets[going]
        if not rows:
            return np.zeros((0, 0), dtype=np.uint64), np.zeros(0, dtype=np.int64)
        return np.concatenate(rows), np.concatenate(counts)

    def lookup(self, queries: np.ndarray) -> np.ndarray:
        """The counts of phrases, 0 for those it does not know: all are read side by side."""
        n = len(queries)
        states = np.zeros(n, dtype=np.int64)
        found = np.zeros(n, dtype=np.int64)
        open_ = np.ones(n, dtype=bool)
        for k in range(min(self.depth, queries.shape[1])):
            at = np.flatnonzero(open_ & (queries[:, k] != 0))
            # A phrase that has ended keeps the count of its last arc.
            open_ &= queries[:, k] != 0
            if not len(at):
                break
            found[at] = 0
            alive = at[states[at] != FINAL]
            open_[at[states[at] == FINAL]] = False
            low, high = self.first[k][states[alive]], self.first[k][states[alive] + 1]
            end, wanted = high.copy(), queries[alive, k]
            while (low < high).any():
                middle = (low + high) // 2
                less = (low < high) & (self.labels[k][np.minimum(middle, len(self.labels[k]) - 1)] < wanted)
                high = np.where((low < high) & ~less, middle, high)
                low = np.where(less, middle + 1, low)
            hit = low < end
            hit[hit] = self.labels[k][low[hit]] == wanted[hit]
            found[alive[hit]] = self.weights[k][low[hit]]
            states[alive[hit]] = self.targets[k][low[hit]]
            open_[alive[~hit]] = False
        if queries.shape[1] > self.depth:
            found[queries[:, self.depth] != 0] = 0
        return found

    def to_bytes(self) -> bytes:
        """Layer by layer, each array in the narrowest numbers that hold it."""
        parts = [struct.pack("<i", self.depth)]
        for first, labels, weights, targets in zip(self.first, self.labels, self.weights, self.targets):
            parts += _packed(np.diff(first)) + [struct.pack("<i", len(labels)), labels.astype("<u8").tobytes()]
            # The last layer leads nowhere: one number says so.
            ends = (targets == FINAL).all()
            parts += _packed(weights) + _packed(np.zeros(0, dtype=np.int64) if ends else targets - FINAL)
        return b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> CountAutomaton:
        (depth,) = struct.unpack_from("<i", data)
        place, out = 4, cls([], [], [], [])
        for _ in range(depth):
            sizes, place = _unpacked(data, place)
            (arcs,) = struct.unpack_from("<i", data, place)
            out.first.append(np.r_[0, np.cumsum(sizes)])
            out.labels.append(np.frombuffer(data, dtype="<u8", count=arcs, offset=place + 4))
            weights, place = _unpacked(data, place + 4 + 8 * arcs)
            targets, place = _unpacked(data, place)
            out.weights.append(weights)
            out.targets.append(targets + FINAL if len(targets) else np.full(arcs, FINAL))
        return out


def _packed(values: np.ndarray) -> list[bytes]:
    most = int(values.max(initial=0))
    kind = next(k for k in (1, 2, 4, 8) if most < 1 << 8 * k)
    return [struct.pack("<ib", len(values), kind), values.astype(f"<u{kind}").tobytes()]


def _unpacked(data: bytes, place: int) -> tuple[np.ndarray, int]:
    size, kind = struct.unpack_from("<ib", data, place)
    values = np.frombuffer(data, dtype=f"<u{kind}", count=size, offset=place + 5).astype(np.int64)
    return values, place + 5 + size * kind


def united(automata: Iterable[CountAutomaton], depth: int) -> CountAutomaton:
    """One automaton with the sums of the counts."""
    rows, counts = [np.zeros((0, depth), dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    for automaton in automata:
        own, n = automaton.phrases()
        rows.append(own)
        counts.append(n)
    return CountAutomaton.from_sorted(*sort_rows(np.concatenate(rows), np.concatenate(counts)))
