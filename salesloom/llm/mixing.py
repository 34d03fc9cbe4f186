"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The documents of a source are dealt into blocks by a hash, and the blocks are permuted. A source's target fixes how
many blocks are drawn from that permutation (a second pass follows where the target exceeds the source), with one
block drawn in part. The quotas of all sources are then split down a tree over the output shards: at every node the
left half gets its share of blocks, drawn without replacement from what the node holds. So shards are equally large
and each source's blocks are spread as if all blocks had been shuffled. A shard draws the next blocks of each source's
permutation and shuffles its documents locally.

Only per-source totals and block sizes (at most BLOCKS for each source) come to the driver.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.store import set_aside, staged

WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = 4096


@dataclass(frozen=True)
class Recipe:
    weights: tuple[float, ...] = (5, 2, 1)   # of the sources in order, repeating
    volume: float = 1.5                      # of the mix, in sizes of the input
    most: float = 2                          # times a source's size
    block_words: int = 1 << 14
    shard_words: int = 1 << 24
    seed: int = 17


def targets(sizes: list[int], weights: list[float], volume: float, most: float = 2) -> list[float]:
    """Shares of ``volume`` by weight, none above ``most`` times its size; what is cut off is shared again."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = min(float(volume), most * sum(sizes))
    while open_:
        total = sum(weights[i] for i in sorted(open_))
        full = [i for i in sorted(open_) if left * weights[i] / total >= most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(most * sizes[i])
            open_.discard(i)
        left -= sum(out[i] for i in full)
    return out


def split_tree(quotas: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); rows are equally large but for one block."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(low: int, high: int, counts: np.ndarray) -> None:
        if high - low == 1:
            out[low] = counts
            return
        middle, total = (low + high) // 2, int(counts.sum())
        share = total * (middle - low) // (high - low)
        left = rng.multivariate_hypergeometric(counts, share, method="marginals")
        split(low, middle, left)
        split(middle, high, counts - left)

    if shards:
        split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


@dataclass
class Plan:
    """Sources in order with size and target, and each drawn block with its shard and the words to take of it."""

    sources: list[tuple[str | None, int, int, float]] = field(default_factory=list)  # name, blocks, size, target
    drawn: list[tuple[int, int, int, int]] = field(default_factory=list)  # source, block, shard, words (-1: all)


def draw(sources: list[tuple[str | None, int]], block_sizes: list[dict[int, int]], counts: list[int],
         recipe: Recipe) -> Plan:
    """The plan for ``sources`` (name, size) with the sizes of their blocks and how many blocks each has."""
    weights = [recipe.weights[i % len(recipe.weights)] for i in range(len(sources))]
    sizes = [size for _, size in sources]
    wanted = targets(sizes, weights, recipe.volume * sum(sizes), recipe.most)
    sequences = []
    for i, (name, size) in enumerate(sources):
        rng = np.random.default_rng([recipe.seed, zlib.crc32((name or "").encode()), int(name is None)])
        sequence, left = [], wanted[i]
        while left > 0 and size:
            for block in rng.permutation(counts[i]).tolist():
                own = block_sizes[i].get(block, 0)
                if own <= left:
                    sequence.append((block, -1))
                    left -= own
                else:
                    sequence.append((block, round(left)))
                    left = 0
                if left <= 0:
                    break
        sequences.append(sequence)
    shards = max(1, round(sum(wanted) / recipe.shard_words))
    parts = split_tree(np.array([len(s) for s in sequences]), shards, np.random.default_rng(recipe.seed))
    plan = Plan([(name, counts[i], size, wanted[i]) for i, (name, size) in enumerate(sources)])
    for i, sequence in enumerate(sequences):
        shard_of = np.repeat(np.arange(shards), parts[:, i])
        plan.drawn += [(i, block, int(shard), words) for (block, words), shard in zip(sequence, shard_of)]
    return plan


def fill(order: list[tuple[int, int]], room: int) -> set[int]:
    """Documents (number, size) that come as near to ``room`` words as taking them in order allows."""
    taken, left = set(), room
    for number, size in order:
        if size <= left:
            taken.add(number)
            left -= size
    rest = [(size, number) for number, size in order if number not in taken]
    if rest and abs(left - min(rest)[0]) < left:
        taken.add(min(rest)[1])
    return taken


# ---------------------------------------------------------------- Spark

def sized(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with its number of words and a hash that orders documents at random."""
    words = F.coalesce(F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")), F.lit(0))
    words = F.when(F.col("text").isNull(), F.lit(0)).otherwise(words)
    return docs.withColumns({"__size": words.cast("long"), "__h": _order_hash(seed)})


def _order_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "doc_id", "text")


def _with_blocks(rows: DataFrame, plan: Plan, spark: SparkSession) -> DataFrame:
    named = spark.createDataFrame([(i, *s) for i, s in enumerate(plan.sources)],
                                  "__no int, __source string, __blocks int, source_size long, target double")
    joined = rows.join(named, F.col("source").eqNullSafe(F.col("__source")), "left").drop("__source")
    return joined.withColumn("__block", F.pmod(F.col("__h"), F.col("__blocks")).cast("int"))


DRAWN = "__no int, __block int, __shards array<int>, __part_shard int, __words long"
MOST_BROADCAST = 100_000  # drawn blocks, some 5 MB
CHOSEN = ["__c_no", "__c_id", "__c_h", "__c_size"]


def _fill_blocks(frame):
    """Of each source's block that is drawn in part, the documents to take."""
    import pandas as pd

    frame = frame.sort_values(["h", "id", "size"], na_position="first").reset_index(drop=True)
    taken = fill(list(enumerate(frame["weight"].tolist())), int(frame["words"].iloc[0]))
    return pd.DataFrame(frame.loc[sorted(taken), ["no", "id", "h", "size"]]).set_axis(CHOSEN, axis=1)


def _planned(narrow: DataFrame, recipe: Recipe) -> tuple[Plan, list[tuple], DataFrame]:
    """The plan; each drawn block with its shards and, if drawn in part, that shard and the words to take; and the
    documents taken of the latter blocks. ``narrow`` has doc_id, source, __size and __h and is read several times."""
    spark = narrow.sparkSession
    totals = sorted(((r["source"], r["size"]) for r in narrow.groupBy("source").agg(
        F.sum("__size").alias("size")).collect()), key=lambda s: (s[0] is None, s[0] or ""))
    counts = [max(1, min(BLOCKS, size // recipe.block_words)) for _, size in totals]
    first = Plan([(name, n, size, 0.0) for (name, size), n in zip(totals, counts)])
    block_sizes: list[dict[int, int]] = [{} for _ in totals]
    for r in _with_blocks(narrow, first, spark).groupBy("__no", "__block").agg(F.sum("__size").alias("size")).collect():
        block_sizes[r["__no"]][r["__block"]] = r["size"]
    plan = draw(totals, block_sizes, counts, recipe)
    whole: dict[tuple[int, int], list[int]] = {}
    part: dict[tuple[int, int], tuple[int, int]] = {}
    for no, block, shard, words in plan.drawn:
        if words < 0:
            whole.setdefault((no, block), []).append(shard)
        else:
            part[no, block] = (shard, words)
    drawn = [(no, block, whole.get((no, block), []), *part.get((no, block), (None, None)))
             for no, block in sorted({*whole, *part})]
    partly = _with_blocks(narrow, plan, spark).join(
        spark.createDataFrame(drawn, DRAWN).filter("__words IS NOT NULL"), ["__no", "__block"])
    chosen = staged(partly.groupBy(F.col("__no").alias("no"), F.col("doc_id").alias("id"), F.col("__h").alias("h"),
                                   F.col("__size").alias("size"), F.col("__words").alias("words")).agg(
        (F.count("*") * F.col("__size")).alias("weight")).groupBy("no").applyInPandas(
        _fill_blocks, "__c_no int, __c_id long, __c_h long, __c_size long"), "partly-drawn").withColumn("__chosen", F.lit(True))
    return plan, drawn, chosen


def _shards() -> Column:
    """One shard for each time a row is taken."""
    return F.concat(F.coalesce("__shards", F.array().cast("array<int>")),
                    F.when(F.col("__chosen"), F.array("__part_shard")).otherwise(F.array().cast("array<int>")))


def decide(narrow: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """``narrow`` (of ``sized``, without texts) with source_size, target, taken and shards, one for each time taken."""
    plan, drawn, chosen = _planned(narrow, recipe)
    spark = narrow.sparkSession
    out = _with_blocks(narrow, plan, spark).join(spark.createDataFrame(drawn, DRAWN), ["__no", "__block"], "left")
    same = (F.col("__part_shard").isNotNull() & (F.col("__no") == F.col("__c_no")) & (F.col("__h") == F.col("__c_h"))
            & (F.col("__size") == F.col("__c_size")) & F.col("doc_id").eqNullSafe(F.col("__c_id")))
    out = out.join(chosen, same, "left").drop(*CHOSEN)
    return out.withColumn("shards", _shards()).withColumn("taken", F.size("shards") * F.col("__size")).drop(
        "__no", "__block", "__blocks", "__shards", "__part_shard", "__words", "__chosen")


def assess(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """doc_id, size, source_size, target, taken and shards for each row of ``docs`` (doc_id, text, source).

    Sources are ordered by code point with null last, and weigh in that order. Null texts have no words. A source
    without words has target 0. Rows that repeat doc_id and text are taken alike. An empty table gives no rows.
    """
    narrow = staged(sized(docs.select("doc_id", "text", "source"), recipe.seed).drop("text"), "sized")
    return decide(narrow, recipe).select(
        "doc_id", F.col("__size").alias("size"), "source_size", "target", "taken", "shards")


def mix(docs: DataFrame, recipe: Recipe = Recipe()) -> DataFrame:
    """The mix itself: each document as often as it is taken, by shard and shuffled within it; columns of ``docs``.

    What is taken is decided without the texts. A row's block tells its shards, so every text moves once for each time
    it is taken, to its shard; only texts of blocks drawn in part, one for each source, meet the list of documents first.
    """
    safe, back = set_aside(docs, ["source_size", "target", "shards", "taken"])
    narrow = staged(sized(docs.select("doc_id", "text", "source"), recipe.seed).drop("text"), "sized")
    plan, drawn, chosen = _planned(narrow, recipe)
    spark = docs.sparkSession
    blocks = spark.createDataFrame(drawn, DRAWN)
    if len(drawn) <= MOST_BROADCAST:
        blocks = F.broadcast(blocks)
    rows = _with_blocks(safe.withColumn("__h", _order_hash(recipe.seed)), plan, spark).join(blocks, ["__no", "__block"])
    whole = rows.filter("__part_shard IS NULL").withColumn("__all", F.col("__shards"))
    same = (F.col("__no") == F.col("__c_no")) & (F.col("__h") == F.col("__c_h")) & F.col("doc_id").eqNullSafe(F.col("__c_id"))
    partly = rows.filter("__part_shard IS NOT NULL").join(chosen, same, "left").withColumn("__all", _shards())
    taken = whole.unionByName(partly.select(*whole.columns))
    one = taken.select("*", F.posexplode("__all").alias("__time", "__shard"))
    return back(one.repartition("__shard").sortWithinPartitions("__shard", F.xxhash64("__h", "__time"), "doc_id"))
