"""Double-array tries: the children of node ``s`` by code ``c`` are at ``BASE[s] + c`` where ``CHECK`` says ``s``."""

from __future__ import annotations

import numpy as np

ROOT = 1
STEP = 4096     # slots looked at together
TRIES = 64      # holes that a node with several children tries before it goes to the end


class DoubleArray:
    """A trie over sequences of codes ``1, 2, ...``; whole levels are built and followed at a time."""

    def __init__(self, room: int):
        self.base, self.check = np.zeros(room + 2, np.int64), np.zeros(room + 2, np.int64)
        self.check[[0, ROOT]] = -1          # slot 0 is no node, the root has no parent
        self.low = ROOT + 1                 # no hole before it
        self.end = ROOT + 1                 # nothing but holes from here on

    def _reach(self, size: int) -> None:
        if size > len(self.base):
            more = max(size, 2 * len(self.base)) - len(self.base)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.zeros(more, np.int64)))

    def _holes(self, count: int) -> np.ndarray:
        """The first ``count`` holes."""
        found, at = [], self.low
        while at < self.end and count:
            part = np.flatnonzero(self.check[at:min(at + STEP, self.end)] == 0)[:count] + at
            found.append(part)
            count, at = count - len(part), at + STEP
        self._reach(self.end + count)
        return np.concatenate([*found, np.arange(self.end, self.end + count)])

    def _take(self, nodes: np.ndarray, slots: np.ndarray) -> None:
        self.check[slots] = nodes
        self.end = max(self.end, int(slots.max()) + 1)
        self._reach(self.end + 1)
        self.low = int(self._holes(1)[0])

    def add_level(self, nodes: np.ndarray, codes: np.ndarray) -> None:
        """Give each node its children; rows are sorted by node, no pair comes twice, no node has any yet.

        An only child fits every hole, so those of a level are placed at once; larger families go first.
        """
        starts = np.flatnonzero(np.concatenate(([True], nodes[1:] != nodes[:-1])))
        counts = np.diff(np.concatenate((starts, [len(nodes)])))
        for k in np.argsort(-counts, kind="stable")[:int((counts > 1).sum())]:
            self._place(int(nodes[starts[k]]), codes[starts[k]:starts[k] + counts[k]])
        only = starts[counts == 1]
        if len(only):
            holes = self._holes(len(only))
            self.base[nodes[only]] = holes - codes[only]
            self._take(nodes[only], holes)

    def _place(self, node: int, codes: np.ndarray) -> None:
        least, span = int(codes.min()), int(codes.max() - codes.min())
        for hole in self._holes(TRIES):
            self._reach(int(hole) + span + 1)
            if not self.check[hole - least + codes].any():
                break
        else:
            hole = self.end
            self._reach(int(hole) + span + 1)
        self.base[node] = hole - least
        self._take(np.full(len(codes), node), hole - least + codes)

    def follow(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The children of the nodes by these codes, 0 where there is none."""
        slots = self.base[nodes] + codes
        known = (slots > ROOT) & (slots < self.end) & (codes > 0)
        slots = np.where(known, slots, 0)
        return np.where(known & (self.check[slots] == nodes), slots, 0)
