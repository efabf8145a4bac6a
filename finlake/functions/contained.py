"""Which of many names occur in a text, found task by task without a join.

The names are a tree of their bytes, walked from every place of the texts at once, a byte a step: the arrays hold the
places that some name still fits. Below a node that a single name passes the rest of that name is compared instead.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Places walked from at once.
PLACES = 1 << 17
#: The branches of as many whole depths as have so many nodes are a plain table, those of all others are in a hash table.
DENSE = 4096
#: Pairs put out in one batch.
PAIRS = 100_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class NameIndex:
    """A tree of names, each known by its place in the list. A name without any byte occurs nowhere."""

    def __init__(self, names: Iterable[bytes]):
        numbers: dict[bytes, list[int]] = {}
        for number, name in enumerate(names):
            if name:
                numbers.setdefault(name, []).append(number)
        listed = sorted(numbers)
        self.data = np.frombuffer(b"".join(listed), np.uint8)
        self.sizes = np.array([len(n) for n in listed], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        # A name that is listed several times: its places, and where they begin.
        self.numbers = np.array([i for n in listed for i in numbers[n]], np.int64)
        self.times = np.array([len(numbers[n]) for n in listed], np.int64)
        self.firsts = np.cumsum(self.times) - self.times
        self._grow()

    def _grow(self) -> None:
        """Nodes by their depth; a branch ``node << 8 | byte`` leads to a node, or to the one name below as ``~name``."""
        keys, targets, ends = [], [], []
        self.below: list[int] = []  # nodes down to each depth
        name, node, depth, nodes = np.arange(len(self.sizes)), np.zeros(len(self.sizes), np.int64), 0, 1
        while True:
            self.below.append(nodes)
            ended = self.sizes[name] == depth
            ends.append((node[ended], name[ended]))
            name, node = name[~ended], node[~ended]
            if not len(name):
                break
            key = node << 8 | self.data[self.starts[name] + depth]  # in order, as the names are
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            target = np.where(size > 1, nodes - 1 + np.cumsum(size > 1), ~name[first])
            keys.append(key[first])
            targets.append(target)
            node = np.repeat(target, size)
            nodes += int((size > 1).sum())
            name, node, depth = name[node > 0], node[node > 0], depth + 1
        self.end = np.full(nodes, -1, np.int64)
        for at, ended in ends:
            self.end[at] = ended
        none = np.zeros(0, np.int64)
        self._spread(np.concatenate([none, *keys]), np.concatenate([none, *targets]))

    def _spread(self, keys: np.ndarray, targets: np.ndarray) -> None:
        self.near = max(n for n in self.below if n <= DENSE)
        near = keys < self.near << 8
        self.dense = np.zeros(self.near << 8, np.int32)
        self.dense[keys[near]] = targets[near]
        keys, targets = keys[~near], targets[~near]
        bits = max(4, int(3 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.table, self.leads = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        slots, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.table[slots[left]] == -1]
            self.table[slots[free]] = keys[free]
            placed = self.table[slots[left]] == keys[left]
            self.leads[slots[left[placed]]] = targets[left[placed]]
            left = left[~placed]
            slots[left] = slots[left] + 1 & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _SPREAD >> self.shift).astype(np.int64)

    def _targets(self, keys: np.ndarray, depth: int) -> np.ndarray:
        """Where branches lead, 0 for one that is not there."""
        if self.below[depth] <= self.near:
            return self.dense[keys]
        slots = self._slots(keys)
        held = self.table[slots]
        same = held == keys
        out = np.where(same, self.leads[slots], 0)
        left = np.flatnonzero(~same & (held != -1))
        while len(left):
            slots[left] = slots[left] + 1 & self.mask
            held = self.table[slots[left]]
            same = held == keys[left]
            out[left[same]] = self.leads[slots[left[same]]]
            left = left[~same & (held != -1)]
        return out

    def places(self, data: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, name) of every name that begins in ``data`` from ``first`` to before ``last``; it may end behind that."""
        place, node = np.arange(first, last), np.zeros(last - first, np.int64)
        found, tails, depth = [], [], 0
        while len(place):
            if place[-1] + depth >= len(data):
                inside = place + depth < len(data)
                place, node = place[inside], node[inside]
            target = self._targets(node << 8 | data[place + depth], depth)
            depth += 1
            leaf = np.flatnonzero(target < 0)
            if len(leaf):
                tails.append((place[leaf], ~target[leaf], np.full(len(leaf), depth)))
            on = np.flatnonzero(target > 0)
            place, node = place[on], target[on].astype(np.int64)
            end = self.end[node]
            ended = np.flatnonzero(end >= 0)
            found.append((place[ended], end[ended]))
        if tails:
            found += self._tails(data, *(np.concatenate(x) for x in zip(*tails)))
        return tuple(np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found)) if found else (place, node)

    def _tails(self, data: np.ndarray, place: np.ndarray, name: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        keep = place + self.sizes[name] <= len(data)
        place, name, at = place[keep], name[keep], at[keep]
        while len(place):
            whole = self.sizes[name] == at
            yield place[whole], name[whole]
            place, name, at = place[~whole], name[~whole], at[~whole]
            same = data[place + at] == self.data[self.starts[name] + at]
            place, name, at = place[same], name[same], at[same] + 1

    def contained(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, number) of every listed name that occurs in the text of a row, each once. A row's text is what ``data``
        has from its offset to the next one."""
        codes = [np.zeros(0, np.int64)]
        for first in range(int(offsets[0]), int(offsets[-1]), PLACES):
            place, name = self.places(data, first, min(first + PLACES, int(offsets[-1])))
            row = np.searchsorted(offsets, place, "right") - 1
            within = place + self.sizes[name] <= offsets[row + 1]
            codes.append(np.unique(row[within] * len(self.sizes) + name[within]))
        code = np.unique(np.concatenate(codes)) if len(codes) > 2 else codes[-1]
        row, name = np.divmod(code, max(1, len(self.sizes)))
        times = self.times[name]
        nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        return np.repeat(row, times), self.numbers[np.repeat(self.firsts[name], times) + nth]


def finder(held: Broadcast, keep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function from batches (key, text) to batches (name, key). ``held`` has ``names`` as they are put out and
    ``looked`` as they are looked for, both in bytes; with ``keep`` a worker keeps their index for its next task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names = held.value.get("index"), held.value["names"]
        if index is None:
            index = NameIndex(held.value["looked"].to_pylist())
            if keep:
                held.value["index"] = index
        for batch in batches:
            text = batch.column("_text").cast(pa.binary())
            _, offsets, data = text.buffers()
            if not len(text) or data is None:
                continue
            offsets = np.frombuffer(offsets, np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
            data = np.frombuffer(data, np.uint8)[:offsets[-1]]
            row = 0
            while row < len(text):
                # Whole texts, of about PLACES bytes together.
                next_row = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PLACES, "right")) - 1)
                rows, numbers = index.contained(data[:offsets[next_row]], offsets[row:next_row + 1])
                for at in range(0, len(rows), PAIRS):
                    keys = batch.column("_key").take(pa.array(rows[at:at + PAIRS] + row))
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(numbers[at:at + PAIRS])), keys], ["_name", "_key"])
                row = next_row

    return run
