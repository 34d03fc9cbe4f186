"""Packing documents into token sequences of a fixed capacity.

Only the number of pieces of each length matters for the packing, and there are no more lengths than the capacity. So
the packing is solved on that histogram: first by Martello and Toth's reduction, which fixes sets of pieces that
provably dominate every other way to fill a sequence with one of them, then by best fit decreasing for what is left.
The answer is a short list of patterns with multiplicities. Pieces find their place by their rank among the pieces of
the same length; ranks come from one range exchange that may split the pieces of a frequent length over many tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.store import staged, staged_texts
from salesloom.llm.tokens import encoded

Patterns = list[tuple[tuple[int, ...], int]]


# ---------------------------------------------------------------- the histogram

def _dominating(size: int, room: int, sizes: list[int], counts: Counter) -> tuple[int, ...] | None:
    """Companions for a piece that dominate all feasible companions, or None if no rule proves it.

    ``sizes`` are the lengths on hand in ascending order without the piece itself; ``counts`` their numbers.
    """
    fits = bisect_right(sizes, room)
    if not fits:
        return ()
    best = sizes[fits - 1]
    if best == room:
        return (best,)                     # it fills the sequence
    small = []
    for s in sizes[:3]:
        small += [s] * min(3, counts[s])
        if len(small) >= 3:
            break
    if len(small) < 2 or small[0] + small[1] > room:
        return (best,)                     # no two others fit together
    if len(small) >= 3 and sum(small[:3]) <= room:
        return None
    # at most two others fit: (best, y) dominates if every pair has a smaller part <= y or a sum <= best
    k = bisect_right(sizes, room - best)
    if not k:
        y = 0
    else:
        y = sizes[k - 1]
        if y == best and counts[best] < 2:
            y = sizes[k - 2] if k > 1 else 0
    low, high = bisect_right(sizes, y), fits - 1
    while low <= high:
        pair = sizes[low] + sizes[high]
        if pair > room or (low == high and counts[sizes[low]] < 2):
            high -= 1
        elif pair > best:
            return None
        else:
            low += 1
    return (best, y) if y else (best,)


def reduce_by_dominance(counts: Counter, capacity: int) -> Patterns:
    """Fix dominating sets and take their pieces out of ``counts``."""
    fixed: Patterns = []
    changed = True
    while changed:
        changed = False
        for size in sorted(counts, reverse=True):
            while counts[size]:
                counts[size] -= 1
                sizes = sorted(s for s in counts if counts[s])
                mates = _dominating(size, capacity - size, sizes, counts)
                counts[size] += 1
                if mates is None:
                    break
                used = Counter((size, *mates))
                times = min(counts[s] // n for s, n in used.items())
                for s, n in used.items():
                    counts[s] -= n * times
                fixed.append(((size, *mates), times))
                changed = True
        for size in [s for s in counts if not counts[s]]:
            del counts[size]
    return fixed


def best_fit_decreasing(counts: Counter, capacity: int) -> Patterns:
    """Best fit of the remaining pieces, the longest first, all pieces of a length at a time."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, pattern: tuple[int, ...], times: int) -> None:
        if room not in open_bins:
            open_bins[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_bins[room].append((pattern, times))

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(rooms, size)
            if at < len(rooms):
                room = rooms[at]
                pattern, times = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room], rooms[at]
            else:
                room, pattern, times = capacity, (), n
            each = min(room // size, n)
            done = min(times, n // each)
            put(room - each * size, pattern + (size,) * each, done)
            if times > done and pattern:
                put(room, pattern, times - done)
            n -= done * each
    return [one for group in open_bins.values() for one in group]


def pack_histogram(histogram: dict[int, int], capacity: int) -> Patterns:
    """Patterns of lengths, each at most ``capacity`` in sum, and how often each is used."""
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("a piece must have 1 to capacity tokens")
    counts = Counter({s: n for s, n in histogram.items() if n})
    fixed = reduce_by_dominance(counts, capacity)
    return fixed + best_fit_decreasing(counts, capacity)


def places(patterns: Patterns) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the first ranks of runs of pieces, with the sequence of the first and the offset of all."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for size in pattern:
            runs.setdefault(size, []).append((used[size], sequence, offset))
            used[size] += times
            offset += size
        sequence += times
    return {s: tuple(np.array(c, dtype=np.int64) for c in zip(*r)) for s, r in runs.items()}


# ---------------------------------------------------------------- Spark

PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64())])
PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(tokenizer: str, end_id: int, capacity: int):
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            keys = batch.column(0).to_pylist()
            for key, ids in zip(keys, encoded(batch.column(1), tokenizer)):
                n = len(ids) + 1
                ids = np.concatenate([ids, end]).astype("<u4").tobytes()
                first = n % capacity or capacity
                for piece, stop in enumerate(range(first, n + 1, capacity)):
                    start = max(0, stop - capacity) if piece else 0
                    rows.append((key, piece, start, stop - start, zlib.crc32(ids[4 * start:4 * stop])))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)
    return run


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """The pieces of every text: its ids and ``end_id``, cut only if longer than ``capacity``.

    All pieces but the first have exactly ``capacity`` tokens.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _cut(tokenizer, end_id, capacity), PIECES_DDL)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranks of pieces among those of the same length in this task."""
    part, seen = TaskContext.get().partitionId(), Counter()
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        order = np.argsort(lengths, kind="stable")
        ranks = np.empty(len(lengths), np.int64)
        values, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
        for v, f, c in zip(values.tolist(), first, n):
            ranks[order[f:f + c]] = seen[v] + np.arange(c)
            seen[v] += int(c)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(lengths), pa.int64()), pa.array(ranks)],
            names=[*batch.schema.names, "part", "rank"])


def _placed(found: dict, before: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, parts, ranks = (batch.column(c).to_numpy() for c in ("length", "part", "rank"))
            ranks = ranks.copy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for value in np.unique(lengths).tolist():
                own = np.flatnonzero(lengths == value)
                for part in np.unique(parts[own]).tolist():
                    ranks[own[parts[own] == part]] += before[value, part]
                first, at, off = found[value]
                run_of = np.searchsorted(first, ranks[own], side="right") - 1
                sequence[own] = at[run_of] + ranks[own] - first[run_of]
                offset[own] = off[run_of]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in PIECES.names] + [pa.array(sequence), pa.array(offset)],
                names=[*PIECES.names, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 1024) -> DataFrame:
    """All pieces of ``docs`` (doc_id, text; other columns are ignored) with their sequence and place in it.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null texts are empty and take one token, the
    end id. Rows with equal doc_id are packed each by itself, null doc_ids too. An empty table gives no rows. To the
    driver come the histogram (at most ``capacity`` rows) and one row for each task and length it holds.
    """
    cut = staged_texts(pieces(docs, tokenizer, end_id, capacity), "pieces")
    ranked = staged(cut.repartitionByRange("length", F.xxhash64("doc_id", "ids_crc32", "start")).mapInArrow(
        _numbered, PIECES_DDL + ", part long, rank long"), "pieces-ranked")
    histogram: Counter = Counter()
    before: dict[tuple[int, int], int] = {}
    for row in sorted(ranked.groupBy("part", "length").count().collect()):
        before[row["length"], row["part"]] = histogram[row["length"]]
        histogram[row["length"]] += row["count"]
    found = places(pack_histogram(histogram, capacity))
    return ranked.mapInArrow(_placed(found, before), PIECES_DDL + ", sequence_id long, offset long")
