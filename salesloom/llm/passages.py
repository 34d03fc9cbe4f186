"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages, and only the document has a label. Every passage is encoded from counts of its
characters and words; gated attention weighs the passages, and the weighted representation is scored. The model has a
few hundred numbers, is fitted on a bounded sample of labelled documents, and goes to the tasks as a plain value;
every whole text is scored in one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.words import IS_SPACE, LOWER, groups, segment_hashes

PASSAGE_WORDS = 48
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "#*$%&|<>", "!", ".?", ",;:",
           "\"'()[]{}@/\\_-+=~^`", "\n"]
BYTE_CLASS = np.full(256, len(CLASSES) + 1, np.uint8)      # the rest: control characters and blanks
for _i, _chars in enumerate(CLASSES):
    BYTE_CLASS[[ord(c) for c in _chars]] = _i
BYTE_CLASS[128:] = len(CLASSES)                            # beyond ASCII
N_FEATURES = len(CLASSES) + 1 + 6


@dataclass(frozen=True)
class Training:
    documents: int = 3000          # labelled documents at most, taken by a hash of doc_id
    passages: int = 256            # of a training document at most, evenly spaced; scoring takes all
    steps: int = 250
    hidden: int = 16
    attention: int = 8
    rate: float = 0.03
    decay: float = 1e-3
    seed: int = 5


# ---------------------------------------------------------------- passages

def passage_features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of a group of texts, and the row of each. A text without words has one of zeros."""
    rows = len(bounds) - 1
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] |= inside[first]
    starts = np.flatnonzero(begins)
    before = np.concatenate([[0], np.cumsum(begins)])[bounds]
    blank = np.flatnonzero(before[1:] == before[:-1])
    if not len(starts):
        return np.zeros((rows, N_FEATURES)), np.arange(rows)
    row_of = np.repeat(np.arange(rows), np.diff(before))
    place = np.arange(len(starts)) - before[row_of]
    heads = np.flatnonzero(place % PASSAGE_WORDS == 0)      # first word of each passage
    cuts = starts[heads]
    kinds = BYTE_CLASS[data]
    size = np.add.reduceat(inside.astype(np.int32), cuts).astype(float)
    words = np.diff(heads, append=len(starts)).astype(float)
    columns = [np.add.reduceat((kinds == k).astype(np.int32), cuts) / size for k in range(len(CLASSES) + 1)]
    h = segment_hashes(np.where(inside, LOWER[data].astype(np.uint64) + np.uint64(1), np.uint64(0)), starts)
    passage = np.repeat(np.arange(len(heads)), words.astype(np.int64))
    same = np.concatenate([[False], (h[1:] == h[:-1]) & (row_of[1:] == row_of[:-1])])
    order = np.lexsort((h, passage))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (passage[order][1:] != passage[order][:-1])
    distinct = np.bincount(passage[order][new], minlength=len(heads))
    # bytes of each word, white space behind it left out
    lengths = np.add.reduceat(inside.astype(np.int32), starts)
    closing = kinds[np.minimum(starts + lengths - 1, len(data) - 1)]
    columns += [np.add.reduceat(same.astype(float), heads) / words, distinct / words, size / words / 10,
                np.add.reduceat(((closing >= 3) & (closing < len(CLASSES))).astype(float), heads) / words,
                np.add.reduceat((lengths == 1).astype(float), heads) / words, np.log1p(words) / 4]
    found = np.column_stack(columns)
    owners = row_of[heads]
    if len(blank):
        found = np.concatenate([found, np.zeros((len(blank), N_FEATURES))])
        owners = np.concatenate([owners, blank])
        order = np.argsort(owners, kind="stable")
        found, owners = found[order], owners[order]
    return found, owners


# ---------------------------------------------------------------- model

@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, features: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """A score for each document; ``owners`` ascend from 0 and leave none out."""
        return forward(self.weights, (features - self.mean) / self.scale, np.flatnonzero(
            np.diff(owners, prepend=-1)))["p"]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def forward(w: dict[str, np.ndarray], x: np.ndarray, heads: np.ndarray) -> dict[str, np.ndarray]:
    """Gated attention over the passages of each document; ``heads`` is the first passage of each."""
    sizes = np.diff(heads, append=len(x))
    h = np.tanh(x @ w["encode"] + w["encode_b"])
    t, s = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
    e = (t * s) @ w["w"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, heads), sizes))
    a = e / np.repeat(np.add.reduceat(e, heads), sizes)
    z = np.add.reduceat(a[:, None] * h, heads)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "sizes": sizes, "p": sigmoid(z @ w["out"] + w["out_b"])}


def gradients(w: dict[str, np.ndarray], x: np.ndarray, heads: np.ndarray, error: np.ndarray,
              f: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Gradients of the loss, from its derivative by each document's logit."""
    h, t, s, a, sizes = f["h"], f["t"], f["s"], f["a"], f["sizes"]
    dz = np.repeat(error[:, None] * w["out"], sizes, axis=0)
    da = (h * dz).sum(axis=1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, heads), sizes))
    dt = de[:, None] * w["w"] * s * (1 - t * t)
    ds = de[:, None] * w["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz + dt @ w["v"].T + ds @ w["u"].T) * (1 - h * h)
    return {"out": f["z"].T @ error, "out_b": error.sum(), "w": (t * s).T @ de, "v": h.T @ dt, "u": h.T @ ds,
            "encode": x.T @ dh, "encode_b": dh.sum(axis=0)}


def fit(features: np.ndarray, owners: np.ndarray, labels: np.ndarray, how: Training = Training()) -> Model:
    """Fit by Adam on all given documents; both classes weigh the same in the loss."""
    rng = np.random.default_rng(how.seed)
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-3
    x, heads = (features - mean) / scale, np.flatnonzero(np.diff(owners, prepend=-1))
    start = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    w = {"encode": start(N_FEATURES, how.hidden), "encode_b": np.zeros(how.hidden),
         "v": start(how.hidden, how.attention), "u": start(how.hidden, how.attention), "w": start(how.attention),
         "out": start(how.hidden), "out_b": np.zeros(())}
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    share = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    for step in range(1, how.steps + 1):
        f = forward(w, x, heads)
        for k, g in gradients(w, x, heads, (f["p"] - labels) * share, f).items():
            g = g + how.decay * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - how.rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    return Model(mean, scale, w)


# ---------------------------------------------------------------- Spark

def held_out(doc_id="doc_id"):
    """Whether a document is kept from training; a null doc_id is."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def _bags(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, labels, row = batch.column(0), batch.column(1), 0
            for data, bounds in groups(batch.column(2)):
                found, owners = passage_features(data, bounds)
                heads = np.flatnonzero(np.diff(owners, prepend=-1))
                own = np.split(found, heads[1:])
                own = [b if len(b) <= most else b[np.linspace(0, len(b) - 1, most).astype(int)] for b in own]
                n = len(own)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(row, n), labels.slice(row, n),
                     pa.array([b.astype("<f4").tobytes() for b in own], pa.binary())],
                    names=["doc_id", "quality", "bag"])
                row += n
    return run


def train(docs: DataFrame, labels: DataFrame, how: Training = Training()) -> Model | None:
    """The model from at most ``how.documents`` labelled documents outside the held-out fold; None without any.

    ``labels`` has doc_id and quality (0 or 1); rows with other or null values, and repeated doc_ids, are passed over.
    """
    sample = labels.filter(F.col("quality").isin(0, 1) & ~held_out()).select(
        "doc_id", F.col("quality").cast("int").alias("quality")).dropDuplicates(["doc_id"]).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(how.documents)
    bags = docs.select("doc_id", "text").join(sample, "doc_id").select("doc_id", "quality", "text").mapInArrow(
        _bags(how.passages), "doc_id long, quality int, bag binary").collect()
    bags = sorted(bags)[:how.documents]  # repeated documents bring more rows than the sample has
    if not bags:
        return None
    own = [np.frombuffer(r["bag"], "<f4").reshape(-1, N_FEATURES).astype(float) for r in bags]
    return fit(np.concatenate(own), np.repeat(np.arange(len(own)), [len(b) for b in own]),
               np.array([r["quality"] for r in bags], float), how)


def _score(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.zeros(0)]
            for data, bounds in groups(batch.column(1)):
                if model is None:
                    scores.append(np.full(len(bounds) - 1, 0.5))
                else:
                    scores.append(model.scores(*passage_features(data, bounds)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], *batch.columns[2:], pa.array(np.concatenate(scores))],
                                             names=["doc_id", "held_out", "score"])
    return run


def score(docs: DataFrame, labels: DataFrame, how: Training = Training(), threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted for each row of ``docs`` (doc_id, text).

    Only the text is an input of the score. Null and empty texts have one passage of zeros. Without any label all
    scores are 0.5.
    """
    model = train(docs, labels, how)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().alias("held_out"))
    out = rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
