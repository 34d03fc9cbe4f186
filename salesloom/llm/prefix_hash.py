"""Document fingerprints from polynomial hashes of prefixes.

With the hashes of all prefixes of a text, the hash of any span is one subtraction and one multiplication: spans are
compared in constant time, and the longest common extension of two places is found by binary search. A fingerprint
holds the length and hash of the whole text and the least hashes of its windows; the share of windows that two texts
have in common is estimated from these, so texts are compared without having both at hand.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.store import staged_texts

PRIME = np.uint64((1 << 31) - 1)
BASES = (1_103_515_245, 1_299_709_357)  # two independent hashes make 62 bits
WINDOW = 12    # code points
KEPT = 32      # least window hashes in a fingerprint

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo PRIME; the longest list so far is kept."""
    p = _powers.get(base, np.array([1, base % int(PRIME)], dtype=np.uint64))
    while len(p) < n:
        p = np.concatenate([p, p * np.uint64(pow(base, len(p), int(PRIME))) % PRIME])
    _powers[base] = p if len(p) <= 1 << 22 else p[:1 << 22]
    return p[:n]


class Prefixes:
    """Hashes of all prefixes of a text."""

    def __init__(self, text: str):
        self.codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        self.n = len(self.codes)
        self.sums, self.inverse = [], []
        for base in BASES:
            terms = (self.codes + np.uint64(1)) * powers(base, self.n) % PRIME
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64) % PRIME]))
            self.inverse.append(powers(pow(base, -1, int(PRIME)), self.n + 1))

    def spans(self, starts: np.ndarray, length: int) -> np.ndarray:
        """62-bit hashes of the spans of ``length`` at ``starts``; equal spans of any texts have equal hashes."""
        out = []
        for sums, inverse in zip(self.sums, self.inverse):
            out.append((sums[starts + length] + PRIME - sums[starts]) % PRIME * inverse[starts] % PRIME)
        return (out[0] << np.uint64(31)) | out[1]

    def span(self, start: int, length: int) -> int:
        return int(self.spans(np.array([start]), length)[0])

    def common_extension(self, start: int, other: Prefixes, other_start: int) -> int:
        """Length of the longest span that this text at ``start`` and another at ``other_start`` share."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, middle) == other.span(other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low


def _mixed(h: np.ndarray) -> np.ndarray:
    """Window hashes in an order that has nothing to do with the polynomial (a 64-bit finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) >> np.uint64(32)


def fingerprint(text: str) -> str:
    """Length, hash of the whole text and its least window hashes, in hexadecimal.

    Equal texts have equal fingerprints. A text shorter than a window has one window, an empty text none.
    """
    p = Prefixes(text)
    width = min(WINDOW, p.n)
    least = np.zeros(0, np.uint64)
    if p.n:
        h = _mixed(p.spans(np.arange(p.n - width + 1), width))
        least = np.unique(np.partition(h, 4 * KEPT)[:4 * KEPT] if len(h) > 8 * KEPT else h)
        if len(least) < KEPT:  # many windows repeat
            least = np.unique(h)
    return f"{p.n:x}.{p.span(0, p.n):016x}." + "".join(f"{v:08x}" for v in least[:KEPT].tolist())


def likeness(one: str, two: str) -> float:
    """Estimated share (0 to 1) of windows that two fingerprints' texts have in common; 1 for equal texts."""
    a, b = one.split("."), two.split(".")
    if a[:2] == b[:2]:
        return 1.0
    x, y = ({f[2][i:i + 8] for i in range(0, len(f[2]), 8)} for f in (a, b))
    if not x or not y:
        return 0.0
    # the least KEPT hashes of the union; a short list is a text's whole set
    union = sorted(x | y)[:KEPT]
    both = sum(v in x and v in y for v in union)
    jaccard = both / len(union)
    return 2 * jaccard / (1 + jaccard)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by as much of the beginning of the following one."""
    quarter = len(text) // 4
    return text[:len(text) - quarter] + following[:quarter]


# ---------------------------------------------------------------- Spark

RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
EDGES = pa.schema([*RESULT, ("part", pa.int64()), ("edge", pa.string()), ("text", pa.string())])
EDGES_DDL = RESULT_DDL + ", part long, edge string, text string"


def _row(key: int | None, text: str, own: str, following: str, next_fingerprint: str) -> tuple:
    changed = edited(text, following)
    changed_fingerprint = own if changed == text else fingerprint(changed)
    return (key, len(text), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(), own,
            changed_fingerprint, likeness(own, changed_fingerprint), likeness(own, next_fingerprint))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: all rows of a range but the last, which waits for the first of the next range."""
    part, rows, before = TaskContext.get().partitionId(), [], None
    nothing = (None,) * 5

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), EDGES)], schema=EDGES)

    for found in batches:
        for key, text in zip(found.column(0), found.column(1)):
            key, text = key.as_py(), text.as_py() or ""
            own = fingerprint(text)
            if before is None:
                rows.append((key, len(text), *nothing, part, "first", text))
            else:
                rows.append((*_row(*before, text, own), part, None, None))
            before = (key, text, own)
            if len(rows) >= 1000:
                yield batch()
                rows = []
    if before is not None:
        rows.append((before[0], len(before[1]), *nothing, part, "last", before[1]))
        yield batch()


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in batches:
        rows = []
        for key, text, following in zip(*(c.to_pylist() for c in found.columns)):
            rows.append(_row(key, text, fingerprint(text), following, fingerprint(following)))
        columns = list(zip(*rows)) or [[]] * len(RESULT)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each document (doc_id, text; other columns are ignored), in comparison with its edited text and the
    next document by doc_id (nulls first, equal ids by text; the last is followed by the first).

    Null texts are empty. An empty table gives no rows; a single document follows itself. Texts move once, in a range
    exchange; the last row of each range gets the first of the next by a join of one row for each range.
    """
    spark = docs.sparkSession
    key = F.col("doc_id").asc_nulls_first()
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    done = staged_texts(ordered.repartitionByRange(key).sortWithinPartitions(key, "text").mapInArrow(_within, EDGES_DDL),
                  "fingerprints")
    first = done.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    parts = sorted(r.next_part for r in first.select("next_part").collect())  # one number for each range
    order = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part long, next_part long")
    last = done.filter("edge = 'last'").select("doc_id", "text", "part").join(order, "part").join(first, "next_part")
    return done.filter("edge IS NULL").select(*RESULT.names).unionByName(
        last.select("doc_id", "text", "following").mapInArrow(_across, RESULT_DDL))
