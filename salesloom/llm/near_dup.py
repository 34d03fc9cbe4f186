"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

Documents with the same shingle set are one node from the start, so copies cost one node. A node's sketch is cut into
bands; nodes that share a band are candidates. Each bucket compares its members with one pivot first, which is linear
in the bucket and connects groups of near copies. Only members that are still outside the pivot's component are
compared further, with whole blocks of nodes through inverted lists. So no link is lost within a bucket, and the pairs
of a large group are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.store import staged, staged_texts
from salesloom.llm.words import IS_SPACE, groups, mixed, seeds, word_hashes

BANDS, ROWS = 42, 6       # at a similarity of 0.8 a pair shares no band with probability 3e-6
SLOTS = BANDS * ROWS
PART, WHOLE = 80, 100     # linked if WHOLE * intersection >= PART * union
IS_WORD = ~IS_SPACE
SEEDS = seeds(2 * SLOTS, 7)
EMPTY = np.iinfo(np.uint64).max


# ---------------------------------------------------------------- sets and sketches

def shingle_sets(column: pa.Array, width: int = 2) -> Iterator[np.ndarray]:
    """Sorted hashes of each text's distinct shingles.

    A text of fewer words than ``width`` is one shingle, one without words has none. A shingle's hash has 64 bits.
    """
    for data, bounds in groups(column):
        words, before = word_hashes(data, bounds, IS_WORD)
        chained = np.full(len(words), np.uint64(width))
        for k in range(width):
            chained[:len(words) - k] = mixed(chained[:len(words) - k] + words[k:])
        for a, b in zip(before[:-1].tolist(), before[1:].tolist()):
            if b - a >= width:
                yield np.unique(chained[a:b - width + 1])
            elif b > a:
                h = np.full(1, np.uint64(b - a))
                for k in range(a, b):
                    h = mixed(h + words[k])
                yield h
            else:
                yield np.zeros(0, np.uint64)


def sketch(elements: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a set of hashes.

    In round i every element falls into a slot by a hash of the round and brings a value that begins with i; slots
    keep their least value. After SLOTS rounds every slot still empty takes the least value over all elements, so no
    slot stays empty. Values of later rounds are larger: rounds past the one that fills the last slot change nothing,
    and several are taken at once.
    """
    out = np.full(SLOTS, EMPTY)
    low = np.uint64(0xFFFFFFFF)
    at, step = 0, max(1, -(-1600 // len(elements)))
    while at < SLOTS:
        rounds = np.arange(at, min(SLOTS, at + step))
        h = mixed(elements[None, :] ^ SEEDS[rounds][:, None])
        slot = ((h >> np.uint64(32)) * np.uint64(SLOTS)) >> np.uint64(32)
        np.minimum.at(out, slot.ravel().astype(np.int64),
                      ((rounds.astype(np.uint64)[:, None] << np.uint64(32)) | (h & low)).ravel())
        if out.max() != EMPTY:
            return out
        at += step
    for slot in np.flatnonzero(out == EMPTY):
        h = mixed(elements ^ SEEDS[SLOTS + slot]) & low
        out[slot] = (np.uint64(SLOTS + slot) << np.uint64(32)) | h.min()
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of the sketch."""
    rows = values.reshape(BANDS, ROWS)
    h = SEEDS[:BANDS].copy()
    for k in range(ROWS):
        h = mixed(h ^ rows[:, k])
    return h.view(np.int64)


def linked(one: np.ndarray, two: np.ndarray, part: int = PART, whole: int = WHOLE) -> bool:
    both = len(np.intersect1d(one, two, assume_unique=True))
    return whole * both >= part * (len(one) + len(two) - both)


FILTER_BITS = 23


def _slots(ids: np.ndarray) -> np.ndarray:
    return (ids ^ (ids >> np.uint64(FILTER_BITS))) & np.uint64((1 << FILTER_BITS) - 1)


def _id_filter(ids: DataFrame) -> np.ndarray:
    """A bit for the slot of each number; 2 ** FILTER_BITS bits, of which at most 2 ** (FILTER_BITS - 6) words come to the
    driver. A filter that is full lets everything pass."""
    slot = F.col("doc_id").bitwiseXOR(F.call_function("shiftrightunsigned", F.col("doc_id"), F.lit(FILTER_BITS)))
    slot = slot.bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for r in ids.groupBy(F.floor(slot / 64).alias("at")).agg(F.bit_or(bit).alias("bits")).collect():
        out[r["at"]] = np.uint64(r["bits"] & (2 ** 64 - 1))
    return out


def _passing(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    known = batch.filter(pc.is_valid(batch.column(0)))
    slot = _slots(known.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
    return known.filter(pa.array((bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0))


def _sets_with(more, schema: pa.Schema, width: int, only: np.ndarray | None = None):
    """Task: doc_id and what ``more`` makes of the shingle set, in batches; of doc_ids that pass the filter ``only``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch if only is None else _passing(batch, only)
            rows = []
            for key, own in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), width)):
                rows.append((key, *more(own)))
                if len(rows) == 2000:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def _signature(own: np.ndarray) -> tuple:
    if not len(own):
        return 0, None, None, None
    key = mixed(own + np.uint64(len(own)))
    one, two = int(key.sum(dtype=np.uint64)), int(mixed(key ^ SEEDS[0]).sum(dtype=np.uint64))
    return len(own), one - (1 << 63), two - (1 << 63), band_keys(sketch(own))


SIGNATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()),
                        ("set_b", pa.int64()), ("bands", pa.list_(pa.int64()))])
SETS = pa.schema([("node", pa.int64()), ("items", pa.binary())])


# ---------------------------------------------------------------- components

def components(links: DataFrame) -> DataFrame:
    """node and the least node it reaches, for all nodes of ``links`` (one, two), by rounds of two kinds of star.

    Each round points all larger neighbours of a node at its least neighbour, then all smaller ones likewise; every
    round is written to the shared folder. The rounds end when the links form stars around the least nodes.
    """
    def edges(df: DataFrame) -> DataFrame:
        return staged(df.filter("one <> two").select(
            F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two")).distinct(), "links")

    def star(df: DataFrame, larger: bool) -> DataFrame:
        both = df.select(F.col("two").alias("of"), F.col("one").alias("to"))
        if larger:
            both = both.unionByName(df.select(F.col("one").alias("of"), F.col("two").alias("to")))
        # rows stay rows: the least neighbour is joined back, so a node with many neighbours is one row there
        least = staged(both.groupBy("of").agg(F.min("to").alias("least")).withColumn(
            "least", F.least("of", "least")), "least")
        joined = both.join(least, "of")
        if larger:
            return joined.filter("to > of").select(F.col("least").alias("one"), F.col("to").alias("two"))
        return joined.select(F.col("least").alias("one"), F.col("to").alias("two")).unionByName(
            least.select(F.col("least").alias("one"), F.col("of").alias("two")))

    def settled(df: DataFrame) -> bool:
        """Whether every node but the least of each component has that one as its only neighbour."""
        ends = df.select(F.col("one").alias("node"), F.lit(1).alias("as_one"), F.lit(0).alias("as_two")).union(
            df.select("two", F.lit(0), F.lit(1)))
        return ends.groupBy("node").agg(F.max("as_one").alias("as_one"), F.sum("as_two").alias("as_two")).filter(
            "as_two > 1 OR as_one + as_two > 1").isEmpty()

    now = edges(links)
    while not settled(now):
        now = edges(star(edges(star(now, True)), False))
    return now.select(F.col("two").alias("node"), F.col("one").alias("component"))


# ---------------------------------------------------------------- candidates

def _verify(part: int, whole: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = [], []
            for a, b, x, y in zip(*batch.columns):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if linked(x, y, part, whole):
                    one.append(a.as_py())
                    two.append(b.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             names=["one", "two"])
    return run


def verified(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """The distinct pairs (one, two) whose full sets are similar enough."""
    pairs = staged(pairs.distinct(), "pairs")
    joined = pairs.join(sets.select(F.col("node").alias("one"), F.col("items").alias("x")), "one").join(
        sets.select(F.col("node").alias("two"), F.col("items").alias("y")), "two")
    return staged(joined.select("one", "two", "x", "y").mapInArrow(_verify(part, whole), "one long, two long"),
                  "verified")


def similar_links(members: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Links (one, two) that connect all nodes of similar sets sharing a bucket of ``members`` (bucket, node, n).

    Every member is compared with the pivot of its bucket, the least node. Of two members that are still in different
    components one at least is outside the pivot's component: each of these goes to all blocks of nodes that hold
    one of its bucket's members. Pairs whose sizes ``n`` alone rule out the similarity are not listed.
    """
    first = staged(members.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("p")).select(
        "bucket", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n")), "pivots")
    pairs = members.join(first, "bucket").filter(
        (F.col("node") != F.col("pivot")) & (F.least("n", "pivot_n") * whole >= F.greatest("n", "pivot_n") * part))
    links = verified(pairs.select(F.col("pivot").alias("one"), F.col("node").alias("two")), sets, part, whole)
    named = components(links)
    placed = staged(members.join(named, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("component")), "placed")
    main = placed.join(first.select("bucket", F.col("pivot").alias("node")), ["bucket", "node"]).select(
        "bucket", F.col("component").alias("main"))
    apart = staged(placed.join(main, "bucket").filter("component <> main").select("bucket", "node"), "apart")
    components_of = placed.select("node", "component").distinct()
    links = named.select(F.col("component").alias("one"), F.col("node").alias("two"))
    return links if apart.isEmpty() else links.unionByName(
        block_links(members, components_of, first, apart, sets, part, whole))


BLOCK, QUERIES = 256, 1000


def block_links(members: DataFrame, named: DataFrame, first: DataFrame, apart: DataFrame, sets: DataFrame, part: int,
                whole: int) -> DataFrame:
    """Links of each node of ``apart`` (bucket, node) to nodes in blocks that hold a member of its bucket.

    Nodes are put into blocks of about BLOCK, nodes of the same group together: by the least pivot of their buckets
    and, where many have the same, by a hash. A node is compared with a block through the block's inverted lists, so
    rows are made for nodes and blocks, not for pairs. A block with many nodes to compare is handled in several
    places, QUERIES at a time. Of the similar nodes in a block one for each other component makes a link: ``named``
    has every node's component so far.
    """
    home = staged(members.join(first, "bucket").groupBy("node").agg(F.min("pivot").alias("home")), "homes")
    sizes = home.groupBy("home").agg(F.count("*").alias("size"))
    blocks = staged(home.join(sizes, "home").select(
        "node", "home", F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / BLOCK)).alias("block")), "blocks")
    present = staged(members.join(apart.select("bucket").distinct(), "bucket").join(blocks, "node").select(
        "bucket", "home", "block").distinct(), "present")
    queries = staged(apart.join(present, "bucket").select("node", "home", "block").distinct(), "queries")
    turns = staged(queries.groupBy("home", "block").agg(F.ceil(F.count("*") / QUERIES).alias("turns")), "turns")
    held = blocks.join(turns, ["home", "block"]).select(
        "node", "home", "block", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(0).alias("asks"))
    asked = queries.join(turns, ["home", "block"]).select(
        "node", "home", "block", F.pmod(F.xxhash64("node", F.lit(1)), "turns").alias("turn"), F.lit(1).alias("asks"))
    rows = held.unionByName(asked).join(staged(sets.join(named, "node"), "sets-named"), "node")
    keys = ["home", "block", "turn"]
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "asks", "node")
    return staged(dealt.select(*keys, "asks", "node", "component", "items").mapInArrow(
        _compare_blocks(part, whole), "one long, two long"), "block-links")


class Block:
    """Sets with inverted lists of their items."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray]):
        self.nodes, self.sizes = np.array(nodes), np.array([len(s) for s in sets])
        items = np.concatenate(sets)
        order = np.argsort(items, kind="stable")
        self.items, self.owners = items[order], np.repeat(np.arange(len(sets)), self.sizes)[order]

    def similar(self, own: np.ndarray, part: int, whole: int) -> np.ndarray:
        """The nodes whose sets are similar to ``own``."""
        low, high = (np.searchsorted(self.items, own, side=side) for side in ("left", "right"))
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        both = np.bincount(self.owners[at], minlength=len(self.nodes))
        return self.nodes[whole * both >= part * (self.sizes + len(own) - both)]


def _compare_blocks(part: int, whole: int):
    """Task: rows come by block, a block's own nodes before those to compare with it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets, block, component_of = None, [], [], None, {}
        for batch in batches:
            one, two = [], []
            keys = zip(*(batch.column(c).to_pylist() for c in ("home", "block", "turn", "asks", "node", "component")))
            for (*key, asks, node, component), items in zip(keys, batch.column("items")):
                if key != now:
                    now, nodes, sets, block, component_of = key, [], [], None, {}
                own = np.frombuffer(items.as_buffer(), np.uint64)
                if not asks:
                    nodes.append(node)
                    sets.append(own.copy())
                    component_of[node] = component
                    continue
                block = block or Block(nodes, sets)
                found = block.similar(own, part, whole)
                apart = {component_of[n]: n for n in found.tolist() if component_of[n] != component}
                one += [node] * len(apart)
                two += apart.values()
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())],
                                             names=["one", "two"])
    return run


def near_duplicates(docs: DataFrame, width: int = 2, part: int = PART, whole: int = WHOLE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    ``component_id`` is the least doc_id reachable over links; ``kept`` marks it. Texts that are null or without words
    have no shingles, are linked with nothing and are kept. Rows with the same doc_id are one document: it is linked
    with whatever one of its texts is linked with, and all its rows are kept or none. A null doc_id joins the
    component of its equals in text; alone, its component is null and it is kept.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = staged_texts(rows.mapInArrow(_sets_with(_signature, SIGNATURES, width),
                                    "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"),
                    "signatures")
    keys = ["set_a", "set_b", "n_shingles"]
    narrow = signed.select("doc_id", *keys)
    nodes = staged(narrow.filter("n_shingles > 0").groupBy(*keys).agg(F.min("doc_id").alias("node")), "nodes")
    known = nodes.filter("node IS NOT NULL").select(F.col("node").alias("doc_id"), *keys)
    banded = signed.join(known, ["doc_id", *keys], "left_semi").select(
        F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    full = staged(banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).filter(
        "low < high").select("bucket"), "buckets")
    members = staged(banded.join(full, "bucket").select("bucket", "node", "n"), "members")
    wanted = members.select(F.col("node").alias("doc_id")).distinct()
    # texts stay where they are: a filter lets the wanted ones pass, and few others, which the joins leave out
    sets = staged_texts(rows.mapInArrow(
        _sets_with(lambda own: (own.tobytes(),), SETS, width, _id_filter(wanted)), "node long, items binary"), "sets")
    links = similar_links(members, sets, part, whole)
    # rows of one doc_id with different texts are different sets of the same document
    same = narrow.join(nodes, keys).filter("doc_id IS NOT NULL AND doc_id <> node").select(
        F.col("node").alias("one"), F.col("doc_id").alias("two"))
    several = narrow.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("set_a").alias("low"), F.max("set_a").alias("high")).filter("low <> high").select("doc_id")
    bridges = same.join(several.withColumnRenamed("doc_id", "two"), "two", "left_semi").select("one", "two")
    named = staged(components(links.unionByName(bridges)), "components")
    out = narrow.join(nodes, keys, "left").withColumn("node", F.coalesce("node", "doc_id"))
    out = out.join(named, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))
