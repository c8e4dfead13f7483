"""Counts of the different words of a task's texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

# Different words that a task holds before it hands them on.
SHARD_WORDS = 1 << 19


def sort_rows(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows in order, each with the sum of its counts."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[new], np.add.reduceat(counts, new)


class ShardCounts:
    """Labels of words with their counts; a word is spelled out when it is first seen."""

    def __init__(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.spelled: list[tuple[np.ndarray, tuple[list, ...]]] = []
        self.counts: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, labels: np.ndarray, spell: Callable[[np.ndarray], tuple[list, ...]]) -> None:
        """``spell`` gives the columns of the words at some places of ``labels``."""
        unique, index, counts = np.unique(labels, return_index=True, return_counts=True)
        self.counts.append((unique, counts))
        place = np.searchsorted(self.known, unique)
        old = np.zeros(len(unique), dtype=bool)
        inside = place < len(self.known)
        old[inside] = self.known[place[inside]] == unique[inside]
        new = unique[~old]
        self.spelled.append((new, spell(index[~old])))
        self.known = np.sort(np.concatenate((self.known, new)), kind="stable")

    @property
    def full(self) -> bool:
        return len(self.known) >= SHARD_WORDS

    def rows(self) -> tuple[np.ndarray, list[pa.Array], np.ndarray]:
        """Labels, the columns that ``spell`` gave, and counts."""
        labels = np.concatenate([c[0] for c in self.counts])
        unique, total = sort_rows(labels[:, None], np.concatenate([c[1] for c in self.counts]))
        spelled = np.concatenate([s[0] for s in self.spelled])
        columns = [pa.array([v for part in parts for v in part], pa.string()) for parts in zip(*[s[1] for s in self.spelled])]
        return spelled, columns, total[np.searchsorted(unique[:, 0], spelled)]
