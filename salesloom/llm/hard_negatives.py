"""Hard negatives by segment summary filtering.

A vector's segments are summarised by their means and deviations. Over a segment of L components the product of two
vectors lies within L * (product of the means) plus or minus L * (product of the deviations). Summed over the segments
this bounds a score from both sides. Few wide segments are tried first, and only what they cannot decide is refined
with narrower ones and at last scored exactly.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.store import staged

LEVELS = (4, 16)     # segments of a vector at each level
SLACK = 1e-9         # of the sum of the bound's terms: covers rounding in the bounds; scores themselves are exact


@dataclasses.dataclass(frozen=True)
class Mining:
    """Which rows are anchors and which negatives are hard."""

    every: int = 50            # anchors: vec_id divisible by this
    positives: int = 5
    negatives: int = 3
    least: int = 50            # negatives score between least and most percent of the positive
    most: int = 95
    scale: int = 256           # components are multiplied by this and rounded down
    block: int = 16384         # rows that meet a block of anchors in one task
    anchor_block: int = 4096


# ---------------------------------------------------------------- summaries and bounds

class Vectors:
    """Vectors of whole numbers as a matrix, with the summaries of their segments at each level."""

    def __init__(self, vectors: list, width: int):
        # vectors of fewer components are filled up with zeros
        self.exact = np.zeros((len(vectors), width), np.int64)
        for row, v in zip(self.exact, vectors):
            row[:len(v)] = v
        self.real = self.exact.astype(np.float64)
        self.largest = int(np.abs(self.exact).max(initial=0))
        self.levels = [self._summary(min(n, width)) for n in LEVELS] if width else []

    def _summary(self, segments: int) -> tuple[np.ndarray, np.ndarray]:
        """Mean and deviation of each segment, times the root of its length."""
        parts = np.array_split(self.real, segments, axis=1)
        root = np.sqrt([p.shape[1] for p in parts])
        return np.stack([p.mean(1) for p in parts], 1) * root, np.stack([p.std(1) for p in parts], 1) * root


def bounds(one: Vectors, two: Vectors, level: int, pairs: tuple[np.ndarray, np.ndarray] | None,
           ) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest possible score of pairs (rows of one, rows of two), or of all pairs as matrices."""
    (m, d), (n, e) = one.levels[level], two.levels[level]
    if pairs is None:
        middle, spread, size = m @ n.T, d @ e.T, np.abs(m) @ np.abs(n).T
    else:
        m, d, n, e = m[pairs[0]], d[pairs[0]], n[pairs[1]], e[pairs[1]]
        middle, spread, size = ((x * y).sum(1) for x, y in ((m, n), (d, e), (np.abs(m), np.abs(n))))
    spread = spread + SLACK * (size + spread + 1)
    return middle - spread, middle + spread


def scores(one: Vectors, two: Vectors, pairs: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Inner products as whole numbers (which must fit 64 bits), by doubles where these cannot round."""
    small = one.largest * two.largest * max(1, one.exact.shape[1]) < 1 << 53
    x, y = (one.real, two.real) if small else (one.exact, two.exact)
    return (x @ y.T if pairs is None else (x[pairs[0]] * y[pairs[1]]).sum(1)).astype(np.int64)


class Search:
    """The best rows for each anchor and score window, of rows that come in chunks by ascending id.

    What the first chunks hold raises the least score that later rows must be able to reach.
    """

    def __init__(self, anchors: Vectors, ids: np.ndarray, labels: np.ndarray, low: np.ndarray, high: np.ndarray,
                 top: int, same_label: bool):
        self.anchors, self.ids, self.labels, self.top, self.same = anchors, ids, labels, top, same_label
        self.low, self.high = low, high            # anchors x windows
        self.bar = low.copy()
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * low.shape[1] for _ in ids]

    def add(self, rows: Vectors, ids: np.ndarray, labels: np.ndarray) -> None:
        keep = (self.labels[:, None] == labels[None, :]) == self.same
        keep &= self.ids[:, None] != ids[None, :]
        for level in range(len(self.anchors.levels)):
            keep = self._narrowed(keep, lambda pairs, level=level: bounds(self.anchors, rows, level, pairs))
        dense = keep.mean() > 0.1 if keep.size else False
        r, c = np.nonzero(keep)
        exact = scores(self.anchors, rows, None)[r, c] if dense else scores(self.anchors, rows, (r, c))
        inside = (exact >= self.bar.min(1)[r]) & (exact <= self.high.max(1)[r])
        r, c, exact = r[inside], c[inside], exact[inside]
        order = np.lexsort((c, -exact, r))
        r, c, exact = r[order], c[order], exact[order]
        cuts = np.searchsorted(r, np.arange(len(self.ids) + 1))
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            own, at = exact[cuts[i]:cuts[i + 1]], ids[c[cuts[i]:cuts[i + 1]]]
            for w in range(self.low.shape[1]):
                first = int(np.searchsorted(-own, -self.high[i, w]))
                last = min(first + self.top, int(np.searchsorted(-own, -self.bar[i, w], side="right")))
                if first < last:
                    held = [np.concatenate(x) for x in zip(self.found[i][w], (at[first:last], own[first:last]))]
                    best = np.lexsort((held[0], -held[1]))[:self.top]
                    self.found[i][w] = held[0][best], held[1][best]
                    if len(best) == self.top:
                        self.bar[i, w] = max(self.bar[i, w], held[1][best[-1]])

    def _narrowed(self, keep: np.ndarray, bounds_of) -> np.ndarray:
        """The pairs whose bounds reach into a window; few pairs are looked up, many are taken as a matrix."""
        bar, high = self.bar.min(1), self.high.max(1)
        if keep.size and keep.mean() > 0.1:
            lower, upper = bounds_of(None)
            return keep & (upper >= bar[:, None]) & (lower <= high[:, None])
        r, c = np.nonzero(keep)
        lower, upper = bounds_of((r, c))
        passed = (upper >= bar[r]) & (lower <= high[r])
        keep[r[~passed], c[~passed]] = False
        return keep

    def results(self) -> Iterator[tuple[int, int, int, int]]:
        """Anchor, window, row and score."""
        for i, anchor in enumerate(self.ids.tolist()):
            for w, (ids, exact) in enumerate(self.found[i]):
                for row, score in zip(ids.tolist(), exact.tolist()):
                    yield anchor, w, row, score


# ---------------------------------------------------------------- tasks

FOUND = pa.schema([(c, pa.int64()) for c in ("anchor_id", "window", "row_id", "score")])
FOUND_DDL = "anchor_id long, window long, row_id long, score long"
CHUNK_VALUES = 1 << 18       # components of the rows that are compared at once
ANY = 1 << 62


def _searched(top: int, same_label: bool):
    """Task: rows come by group and role, anchors before the rows they meet, rows by ascending id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, search, held = None, None, []
        width = 0

        def flush() -> None:
            nonlocal search, width, held
            if held and isinstance(search, list):
                anchors = search
                windows = max(len(a[3]) for a in anchors)
                # a missing window admits nothing
                low = np.array([[*[x for x, _ in a[3]], *[ANY] * (windows - len(a[3]))] for a in anchors], np.int64)
                high = np.array([[*[x for _, x in a[3]], *[-ANY] * (windows - len(a[3]))] for a in anchors], np.int64)
                width = max(1, max(len(v) for _, _, v, _ in [*anchors, *held]))
                search = Search(Vectors([a[2] for a in anchors], width), np.array([a[0] for a in anchors]),
                                np.array([a[1] for a in anchors]), low, high, top, same_label)
            if held and search is not None:
                # components that no anchor has add nothing to a score
                rows = Vectors([v[:width] for _, _, v, _ in held], width)
                search.add(rows, np.array([h[0] for h in held]), np.array([h[1] for h in held]))
            held = []

        def finish() -> pa.RecordBatch | None:
            flush()
            out = list(search.results()) if isinstance(search, Search) else []
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=FOUND) if out else None

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("label_group", "row_block", "anchor_block", "role", "vec_id",
                                                               "label")))
            for (*key, role, vec_id, label), vector, windows in zip(keys, batch.column("vector"),
                                                                    batch.column("windows").to_pylist()):
                if key != now:
                    if (done := finish()) is not None:
                        yield done
                    now, search = key, None
                values = vector.values.to_numpy(zero_copy_only=False)
                if role == 0:
                    search = search or []
                    search.append((vec_id, label, values.copy(), [(w["low"], w["high"]) for w in windows]))
                elif search is not None:
                    held.append((vec_id, label, values.copy(), None))
                    if len(held) * max(1, len(values)) >= CHUNK_VALUES:
                        flush()
        if (done := finish()) is not None:
            yield done
    return run


# ---------------------------------------------------------------- the operator

def vectors(embeddings: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """vec_id, label and vector (whole numbers) of the rows that take part."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").filter(finite).select(
        "vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform("embedding", lambda x: F.floor(x * mining.scale)).alias("vector"))
    repeated = staged(rows.groupBy("vec_id").agg(F.count("*").alias("n")).filter("n > 1").select("vec_id"), "repeated")
    first = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("first")).select("vec_id", "first.label", "first.vector")
    return staged(rows.join(repeated, "vec_id", "left_anti").unionByName(first), "vectors")


def _met(rows: DataFrame, anchors: DataFrame, sizes: DataFrame, mining: Mining, top: int, same_label: bool) -> DataFrame:
    """Best rows in the windows of each anchor, by blocks of rows and anchors of the same ``label_group``.

    ``sizes`` has the number of rows and anchors of each group. A group of any size is dealt over as many blocks as it
    needs; each block of rows meets each block of anchors in one task.
    """
    def blocks(df: DataFrame, role: int, own: str, other: str) -> DataFrame:
        counted = df.join(sizes, "label_group")
        return counted.select(
            "label_group", F.pmod(F.xxhash64("vec_id"), own).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other), F.lit(role).alias("role"), "vec_id", "label",
            "vector", "windows" if role == 0 else F.lit(None).cast("array<struct<low:long,high:long>>").alias("windows"))

    keys = ["label_group", "row_block", "anchor_block"]
    both = blocks(anchors, 0, "anchor_block", "row_block").unionByName(blocks(rows, 1, "row_block", "anchor_block"))
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, "role", "vec_id")
    found = dealt.select(*keys, "role", "vec_id", "label", "vector", "windows").mapInArrow(
        _searched(top, same_label), FOUND_DDL)
    order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "row_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _sizes(rows: DataFrame, anchors: DataFrame, mining: Mining) -> DataFrame:
    """Number of blocks of rows and of anchors for each label group that has anchors."""
    n = rows.groupBy("label_group").agg(F.count("*").alias("n"))
    a = anchors.groupBy("label_group").agg(F.count("*").alias("a"))
    return n.join(a, "label_group").select(
        "label_group", F.ceil(F.col("n") / mining.block).cast("int").alias("row_block"),
        F.ceil(F.col("a") / mining.anchor_block).cast("int").alias("anchor_block"))


def mine(embeddings: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Rows with a null vec_id, label or vector, or a component that is null or not finite, take no part. Of rows that
    repeat a vec_id the one with the least label and vector counts. Vectors may differ in length: components that one of
    two lacks count as zero. Equal scores are ordered by vec_id. Anchors without positives, and positives without
    negatives in their window, have no rows. Other columns are ignored.
    """
    rows = vectors(embeddings, mining)
    anchors = rows.filter(F.col("vec_id") % mining.every == 0)
    whole = F.array(F.struct(F.lit(-ANY).alias("low"), F.lit(ANY).alias("high")))
    by_label = F.col("label").alias("label_group")
    own = anchors.select("*", by_label, whole.alias("windows"))
    positives = staged(_met(rows.select("*", by_label), own, staged(_sizes(rows.select(by_label), own, mining), "sizes"),
                            mining, mining.positives, True).select(
        "anchor_id", F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"),
        (F.col("rank") - 1).cast("long").alias("window")), "positives")
    least, most = F.col("positive_score") * mining.least, F.col("positive_score") * mining.most
    # at most ``positives`` windows for each anchor
    windows = positives.select("anchor_id", F.struct(
        "window", F.ceil(least.cast("decimal(38,0)") / 100).cast("long").alias("low"),
        F.floor(most.cast("decimal(38,0)") / 100).cast("long").alias("high")).alias("w")).groupBy("anchor_id").agg(
        F.sort_array(F.collect_list("w")).alias("ws")).select(
        F.col("anchor_id").alias("vec_id"),
        F.transform("ws", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"))).alias("windows"))
    one_group = F.lit(0).cast("long").alias("label_group")
    asked = staged(anchors.join(windows, "vec_id").select("vec_id", "label", "vector", one_group, "windows"), "asked")
    everything = rows.select("*", one_group)
    sizes = staged(_sizes(everything, asked, mining), "sizes")
    found = _met(everything, asked, sizes, mining, mining.negatives, False)
    return found.join(positives, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("row_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
