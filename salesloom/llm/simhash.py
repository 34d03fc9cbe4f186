"""Near-duplicate documents by SimHash fingerprints and fuzzy hashing with the Golay code.

A fingerprint of 64 bits is cut into three segments. The perfect binary Golay code puts every word of 23 bits into the
sphere of exactly one codeword, so a segment has the index of its codeword as a key, and with one bit flipped it falls
into at most six spheres. Of three errors in all, the segments have either none in two of them, or none in one and a
single one in another, or one in each. Each case gives keys that both fingerprints of a link must share; a single error
changes the parity of its segment, so the even one states its own codeword and the odd one those of its neighbours.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.near_dup import components
from salesloom.llm.store import staged, staged_texts
from salesloom.llm.words import mixed

WIDTH, SEED, BITS, ERRORS = 3, 42, 64, 3  # words of a shingle, seed of its hash, bits, differing bits of a link
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACE = b" \t\n\v\f\r"
CHUNK = 1 << 20      # bytes of a text that are cut into words at once
BLOCK = 8192         # members of a bucket that one task compares at once
SMALL = 16           # groups up to this size are compared side by side

# Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, CHECKS = 23, 11


# ---------------------------------------------------------------- fingerprints

def _word_runs(text: str) -> Iterator[list[bytes]]:
    """The words of a text in runs; a run begins with the last words of the run before."""
    data = text.encode("utf-8", "surrogatepass").translate(LOWER)
    at, held = 0, []
    while at < len(data):
        stop = min(len(data), at + CHUNK)
        while stop < len(data) and data[stop] not in SPACE:
            stop += 1
        held += data[at:stop].split()
        at = stop
        if at < len(data) and len(held) < WIDTH:
            continue
        yield held
        held = held[len(held) - WIDTH + 1:]


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """Unsigned XXH64 of each shingle of a text, repeats included, in runs."""
    whole, first = text or "", True
    for words in _word_runs(whole):
        if len(words) < WIDTH:
            if first and words:
                yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
            return
        first = False
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends - sizes + 1).tolist()
        yield np.array([xxhash.xxh64_intdigest(joined[a:b], SEED)
                        for a, b in zip(starts, ends[WIDTH - 1:].tolist())], np.uint64)


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit set, bit 0 first."""
    out = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
        out += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return out


def fingerprint(text: str | None) -> int:
    """A bit is set if more than half of the shingles' hashes have it; a text without words has 0."""
    n, counts = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(text):
        n += len(hashes)
        counts += set_bits(hashes)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0]) if n else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.view(np.int64))], names=["doc_id", "bits"])


# ---------------------------------------------------------------- the code

def _remainders(values: np.ndarray) -> np.ndarray:
    """Remainder of words of 23 bits modulo the generator."""
    out = values.astype(np.int64)
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        out = np.where(out >> bit & 1, out ^ (GENERATOR << (bit - CHECKS)), out)
    return out


def _corrections() -> np.ndarray:
    """The error pattern for each remainder: all patterns of up to three errors have remainders of their own."""
    patterns = [sum(1 << i for i in places) for n in range(ERRORS + 1)
                for places in itertools.combinations(range(LENGTH), n)]
    out = np.zeros(1 << CHECKS, np.int64)
    out[_remainders(np.array(patterns))] = patterns
    return out


CORRECTIONS = _corrections()


def codeword_index(values: np.ndarray) -> np.ndarray:
    """Index of the codeword within three bits of each word of 23 bits: its leading 12 bits."""
    values = values.astype(np.int64)
    return (values ^ CORRECTIONS[_remainders(values)]) >> CHECKS


# ---------------------------------------------------------------- keys

def _neighbours(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and codeword index for each distinct codeword of the words that differ in one of ``width`` bits."""
    near = np.sort(codeword_index(values[:, None] ^ (1 << np.arange(width))[None, :]), axis=1)
    new = np.ones(near.shape, bool)
    new[:, 1:] = near[:, 1:] != near[:, :-1]
    return np.nonzero(new)[0], near[new]


def _packed(case: int, *parts: np.ndarray) -> np.ndarray:
    """Parts of at most 22 bits, two of them or three of 12 bits, and the number of the case, in 64 bits."""
    out = np.full(len(parts[0]), case, np.int64)
    for part in parts:
        out = out << (22 if len(parts) == 2 else 12) | part
    return out


def _expand(rows: np.ndarray, n: int, near: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``rows`` (numbers below n, any order) all its entries of ``near``: place in rows, index."""
    counts = np.bincount(near[0], minlength=n)
    first = np.cumsum(counts) - counts
    sizes = counts[rows]
    place = np.repeat(np.arange(len(rows)), sizes)
    return place, near[1][np.arange(len(place)) - np.repeat(np.cumsum(sizes) - sizes - first[rows], sizes)]


def bucket_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and key: two fingerprints (uint64) with at most three differing bits share a key."""
    values = [((fingerprints >> np.uint64(a)) & np.uint64((1 << w) - 1)).astype(np.int64) for a, w in SEGMENTS]
    own = [codeword_index(v) for v in values]
    near = [_neighbours(v, w) for v, (_, w) in zip(values, SEGMENTS)]
    odd = [np.bitwise_count(v) % 2 == 1 for v in values]
    n, rows, keys = len(fingerprints), [], []

    def add(case: int, row: np.ndarray, *parts: np.ndarray) -> None:
        rows.append(row)
        keys.append(_packed(case, *parts))

    every = np.arange(n)
    for case, (a, b) in enumerate(itertools.combinations(range(3), 2)):        # two segments without errors
        add(case, every, values[a], values[b])
    for case, (a, b) in enumerate(itertools.permutations(range(3), 2), 3):     # none in a, one in b
        even = np.flatnonzero(~odd[b])
        add(case, even, values[a][even], own[b][even])
        several, index = near[b][0][odd[b][near[b][0]]], near[b][1][odd[b][near[b][0]]]
        add(case, several, values[a][several], index)
    # one in each: the even side of the first segment varies that one, the odd side the other two
    several, index = near[0][0][~odd[0][near[0][0]]], near[0][1][~odd[0][near[0][0]]]
    add(9, several, index, own[1][several], own[2][several])
    rest = np.flatnonzero(odd[0])
    place, second = _expand(rest, n, near[1])
    rest = rest[place]
    place, third = _expand(rest, n, near[2])
    rest, second = rest[place], second[place]
    add(9, rest, own[0][rest], second, third)
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 2000):
            part = batch.slice(at, 2000)
            bits = part.column(0).to_numpy(zero_copy_only=False)
            rows, keys = bucket_keys(bits.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(bits[rows]), pa.array(keys)], names=["bits", "bucket"])


# ---------------------------------------------------------------- links

def spanning(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (places) that connect all fingerprints of few differing bits, one less than each component has members."""
    left, one, two = np.arange(len(bits)), [], []
    while len(left):
        waiting, left = [left[0]], left[1:]
        while waiting and len(left):
            now = waiting.pop()
            hit = np.bitwise_count(bits[left] ^ bits[now]) <= ERRORS
            if hit.any():
                found, left = left[hit], left[~hit]
                one.append(np.full(len(found), now))
                two.append(found)
                waiting += found.tolist()
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *one]), np.concatenate([empty, *two])


def group_links(group: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (lesser and greater fingerprint) that connect similar members of each group; rows come sorted by group."""
    starts = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
    sizes = np.diff(starts, append=len(group))
    one, two = [], []
    for at, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        a, b = spanning(bits[at:at + n])
        one.append(bits[at + a])
        two.append(bits[at + b])
    small = np.repeat(sizes <= SMALL, sizes)
    group, bits = group[small], bits[small]
    for step in range(1, int(sizes[sizes <= SMALL].max(initial=1))):
        hit = (group[step:] == group[:-step]) & (np.bitwise_count(bits[step:] ^ bits[:-step]) <= ERRORS)
        one.append(bits[:-step][hit])
        two.append(bits[step:][hit])
    empty = np.zeros(0, bits.dtype)
    one, two = np.concatenate([empty, *one]), np.concatenate([empty, *two])
    low, high = np.minimum(one, two), np.maximum(one, two)
    order = np.lexsort((high, low))
    low, high = low[order], high[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return low[new], high[new]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows come sorted by bucket and pair of blocks; whole groups are compared, about 100,000 rows at once."""
    held: list[list[np.ndarray]] = [[], []]

    def links(upto: int | None) -> pa.RecordBatch:
        group, bits = (np.concatenate(c) for c in held)
        held[:] = [[group[upto:]], [bits[upto:]]] if upto else [[], []]
        one, two = group_links(group[:upto], bits[:upto].view(np.uint64))
        return pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64))],
                                          names=["one", "two"])

    for batch in batches:
        bucket, low, high, bits = (batch.column(c).to_numpy(zero_copy_only=False)
                                   for c in ("bucket", "low", "high", "bits"))
        blocks = (low.astype(np.uint64) << np.uint64(32)) + high.astype(np.uint64)
        held[0].append(mixed(mixed(bucket.view(np.uint64)) + blocks).view(np.int64))
        held[1].append(bits)
        if sum(map(len, held[0])) >= 100_000:
            whole = np.concatenate(held[0])
            changes = np.flatnonzero(whole[1:] != whole[:-1])
            if len(changes):
                yield links(int(changes[-1]) + 1)
    if sum(map(len, held[0])):
        yield links(None)


def similar_links(nodes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links (one, two) that connect all distinct fingerprints ``nodes`` (bits) of few differing bits.

    Only keys that two fingerprints share are compared. The members of a bucket of more than ``block`` are dealt over
    blocks, and each pair of blocks is one comparison, so no task holds more than two blocks of a bucket.
    """
    keyed = staged(nodes.select("bits").mapInArrow(_keyed, "bits long, bucket long"), "keys")
    shared = keyed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select(
        "bucket", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    members = keyed.join(shared, "bucket").withColumn("own", F.pmod(F.xxhash64("bits"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    paired = members.select("bucket", "bits", "own", other).select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "bits")
    dealt = paired.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return staged(dealt.mapInArrow(_compared, "one long, two long").distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for each row of ``docs`` (doc_id, text).

    ``component_id`` is the least doc_id reachable over links of at most three differing bits. Null, empty and blank
    texts have the fingerprint zero and are linked like any other. Rows that repeat a doc_id are one document, linked
    with whatever one of its texts is linked with. A null doc_id joins the component of its fingerprint; if no
    document with an id is there, its component is null. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged_texts(rows.mapInArrow(_fingerprints, "doc_id long, bits long"), "fingerprints")
    nodes = staged(signed.groupBy("bits").agg(F.min("doc_id").alias("least")), "nodes")
    known = signed.filter("doc_id IS NOT NULL")
    several = known.groupBy("doc_id").agg(F.min("bits").alias("low"), F.max("bits").alias("high")).filter("low <> high")
    bridges = known.join(several, "doc_id").select(F.col("low").alias("one"), F.col("bits").alias("two"))
    named = staged(components(similar_links(nodes, block).unionByName(bridges)), "components")
    placed = staged(nodes.join(named, nodes["bits"] == named["node"], "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component")), "placed")
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    found = placed.join(least, "component").select("bits", "component_id")
    return signed.join(found, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
