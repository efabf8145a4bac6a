"""Near-duplicate classes by SimHash fingerprints of 64 bits, exact up to a number of differing bits.

Fingerprints are embedded as bit counts of two-bit segments. The Manhattan distance of two such vectors is at most the
Hamming distance of the fingerprints. Of two fingerprints with at most four differing bits, one half has at most two: in
that half the vectors are within two steps, and on the grid some cell lies within one step of both. So every fingerprint
enters, for each half, its own cell and the cells one step away, all links meet in a cell, and there they are verified on
the fingerprints themselves.

Equal fingerprints are one node. Small cells compare all their members;
larger ones give only links that connect, found by searching outwards through those not yet reached; beyond BLOCK members
a cell is cut into blocks that meet pairwise, each pair a task's group of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, fields_and, per_batch, settle
from .components import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
#: Members of a cell that are compared each with each, and of a block.
FEW, BLOCK = 12, 2048
_PART = 1 << 16
_HALF = 16  # segments of two bits in a half
_POWERS = 3 ** np.arange(_HALF, dtype=np.int64)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """A bit is 1 where over half of the shingles' hashes have it; no words give zero, fewer than ``size`` one shingle."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(size, len(words))
    begin, end = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    total = np.zeros(64, np.int64)
    for i in range(0, len(begin), _PART):
        found = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(begin[i : i + _PART], end[i : i + _PART], strict=True)]
        bits = np.unpackbits(np.array(found, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * total > len(begin))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """(id, fingerprint as a signed long) of every row; a null text is empty."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def build():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = np.array([fingerprint(t, size) for t in as_bytes(batch.column("text"))], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fingerprint"])

        return run

    return per_batch(rows, build, fields_and(rows.schema.fields[:1], "fingerprint long"))


def segment_counts(found: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments of each fingerprint."""
    counts = found - ((found >> np.uint64(1)) & np.uint64(0x5555555555555555))
    return ((counts[:, None] >> np.arange(0, 64, 2, dtype=np.uint64)) & np.uint64(3)).astype(np.int64)


def grid_cells(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint number, cell): the cells at most one step away from each fingerprint, in either half."""
    counts = segment_counts(found)
    rows, cells = [], []
    for half in range(2):
        part = counts[:, half * _HALF : (half + 1) * _HALF]
        home = part @ _POWERS + half * 3**_HALF
        rows.append(np.arange(len(found)))
        cells.append(home)
        for step, allowed in ((1, part < 2), (-1, part > 0)):
            row, segment = np.nonzero(allowed)
            rows.append(row)
            cells.append(home[row] + step * _POWERS[segment])
    return np.concatenate(rows), np.concatenate(cells)


def grid_entries(nodes: DataFrame) -> DataFrame:
    """(fingerprint, cell) for every cell a fingerprint enters, at most 66 each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy()
            for i in range(0, len(found), 2048):
                part = found[i : i + 2048]
                rows, cells = grid_cells(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(part[rows]), pa.array(cells.astype(np.int32))], ["fingerprint", "cell"])

    return nodes.select("fingerprint").mapInArrow(run, "fingerprint long, cell int")


def few_links(groups: np.ndarray, found: np.ndarray, longest: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All links within groups that lie together and have at most ``longest`` members."""
    left, right = [], []
    for step in range(1, longest):
        near = (groups[step:] == groups[:-step]) & (np.bitwise_count(found[step:] ^ found[:-step]) <= most)
        at = np.flatnonzero(near)
        left.append(found[at])
        right.append(found[at + step])
    return np.concatenate(left), np.concatenate(right)


def spanning_links(found: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever links connect among these fingerprints: a breadth-first search through those left."""
    left, right = [], []
    rest = found
    while len(rest):
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            frontier = queue.pop()
            for member in frontier:
                near = np.bitwise_count(rest ^ member) <= most
                if near.any():
                    reached, rest = rest[near], rest[~near]
                    left.append(np.full(len(reached), member))
                    right.append(reached)
                    queue.append(reached)
                    if not len(rest):
                        break
    empty = np.zeros(0, np.uint64)
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def cell_links(members: DataFrame, most: int) -> DataFrame:
    """(u, v) of the links found in each group of rows with the same ``part``, by which the partitions are sorted."""

    def links(groups: np.ndarray, found: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
        sizes = np.diff(np.append(starts, len(groups)))
        small = np.repeat((sizes > 1) & (sizes <= FEW), sizes)
        parts = [few_links(groups[small], found[small], FEW, most)]
        parts += [spanning_links(found[a : a + n], most) for a, n in zip(starts, sizes, strict=True) if n > FEW]
        left, right = (np.concatenate(x) for x in zip(*parts, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_groups, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            groups = np.concatenate([held_groups, batch.column("part").to_numpy()])
            found = np.concatenate([held, batch.column("fingerprint").to_numpy().view(np.uint64)])
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(groups, groups[-1])) if len(groups) else 0
            if cut:
                yield links(groups[:cut], found[:cut])
            held_groups, held = groups[cut:], found[cut:]
        if len(held):
            yield links(held_groups, held)

    return members.select("part", "fingerprint").mapInArrow(run, "u long, v long")


def fingerprint_links(nodes: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """(u, v): links between different fingerprints that connect all that links connect; a pair may come more than once.

    ``nodes`` holds each fingerprint once; ``most`` is at most 4, as the grid is made for it.
    """
    if not 0 <= most <= MAX_BITS:
        raise ValueError(f"links of more than {MAX_BITS} bits need another grid")
    # Cells that are one block need no mark, so few rows are joined; every entry goes to its cell.
    crowded = grid_entries(nodes).groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    met = grid_entries(nodes).join(crowded, "cell", "left")
    blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    pairs = met.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.struct("cell", F.least("own", "other"), F.greatest("own", "other"))
    # Two groups with the same hash would only be compared with each other as well.
    dealt = pairs.select(F.xxhash64(pair).alias("part"), "fingerprint").repartition("part").sortWithinPartitions("part")
    return cell_links(dealt, most)


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id) of every row: the smallest id that links reach from it, its own included.

    Null and empty texts have fingerprint zero, which links like any other; texts may be of any length. Rows that repeat
    an id count each. Rows without an id take part, but their id is nobody's component; a component without any id has
    null. An empty table gives no rows.
    """
    rows = settle(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = settle(rows.groupBy("fingerprint").agg(F.min("id").alias("first")), "fingerprint-nodes")
    reached = components(fingerprint_links(nodes, most)).select(F.col("node").alias("fingerprint"), "root")
    rooted = settle(nodes.join(reached, "fingerprint", "left").select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")), "fingerprint-roots")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(firsts, "root").select("fingerprint", "component_id")
    return rows.join(classes, "fingerprint").select("id", "fingerprint", "component_id")
