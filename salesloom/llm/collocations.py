"""Phrases that stand together more often than their parts would: best-first growth under admissible bounds.

A phrase of words w1 ... wk with f occurrences scores floor(1000 f n / (l r)) at its weakest cut into a first part with l
and a rest with r occurrences. As r >= f, no phrase that begins with w1 scores above 1000 n / f(w1): that is the bound of
w1. First words are taken in the order of their bounds, highest first, and grown word by word as long as the prefix is
frequent. After each round the language's last place of the result is known so far; growth ends as soon as no first
word's bound reaches it. So the most frequent words, which make up most of a text, are not grown in a large corpus.

Words are 64-bit hashes while phrases are counted; that no two words of a language share a hash is checked, and the hash
is drawn again if they do. Tasks combine what they count before it is shuffled, filters of a fixed number of bits keep
out most of what cannot be frequent, and exact joins remove the rest.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.store import batches_of, staged, staged_texts
from salesloom.llm.words import LOWER, groups, mixed, segment_hashes

# Bytes between words, and those that end a piece.
SPACES = [0x20, 0x09]
BREAKS = [*b".,;:!?", *range(0x0A, 0x0E)]
IS_BREAK = np.isin(np.arange(256), BREAKS)
IS_WORD = ~np.isin(np.arange(256), SPACES + BREAKS)

FILTER_BITS = 22        # a filter has 2 ** 22 bits: half a megabyte, whatever the corpus
RUN_BYTES = 1 << 16     # of text in one run, about
RUNS_AT_ONCE = 100      # runs that go to a Python worker at once
HELD = 1 << 18          # phrases that a task holds before it combines equal ones
SHARES = (16, 1)        # first words of each round: those whose occurrences make up 1/16 and all of the words


@dataclasses.dataclass(frozen=True)
class Rules:
    least: int = 100        # occurrences of a phrase
    longest: int = 5        # words of a phrase
    top: int = 2000         # phrases of each language
    shares: tuple[int, ...] = SHARES  # rounds of growth


# ---------------------------------------------------------------- words of texts

def _words(data: np.ndarray, bounds: np.ndarray, stream: int) -> tuple[np.ndarray, ...]:
    """Start, end and hash of each word of a group of texts, the row it is in, and whether a piece begins with it."""
    inside = IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] |= inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64), starts, np.zeros(0, bool)
    hashes = segment_hashes(np.where(inside, LOWER[data].astype(np.uint64) + np.uint64(1), np.uint64(0)), starts, stream)
    hashes[hashes == 0] = 1     # 0 stands for a break
    row = np.searchsorted(bounds, starts, side="right") - 1
    piece = np.cumsum(IS_BREAK[data])[starts] + row
    opens = np.ones(len(starts), bool)
    opens[1:] = piece[1:] != piece[:-1]
    ends = starts + np.add.reduceat(inside.astype(np.int64), starts)
    return starts, ends, hashes, row, opens


def _lang_groups(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    """The texts of each language of a batch."""
    langs = batch.column(0).dictionary_encode()
    codes = langs.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(codes, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1):
        if len(part):
            yield langs.dictionary[int(codes[part[0]])].as_py(), batch.column(1).take(pa.array(part))


# ---------------------------------------------------------------- phrases

def lang_key(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))


def phrase_keys(lang: str, columns: Sequence[np.ndarray]) -> np.ndarray:
    """A 64-bit key of the phrases whose words stand in ``columns``."""
    key = np.full(len(columns[0]), lang_key(lang))
    for c in columns:
        key = mixed(key * np.uint64(3) + c)
    return key


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys & np.uint64((1 << FILTER_BITS) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


def filter_of(phrases: DataFrame, words: Sequence[str]) -> np.ndarray:
    """A filter of phrases (lang and columns ``words``); at most 2 ** (FILTER_BITS - 6) rows come to the driver."""
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            columns = [batch.column(i + 1).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(len(words))]
            for code, lang in enumerate(langs.dictionary.to_pylist()):
                keys = phrase_keys(lang, [c[codes == code] for c in columns])
                slot = np.unique(keys & np.uint64((1 << FILTER_BITS) - 1))
                yield pa.RecordBatch.from_arrays([pa.array(slot.view(np.int64))], names=["slot"])

    found = phrases.select("lang", *words).mapInArrow(slots, "slot long")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for r in found.groupBy(F.floor(F.col("slot") / 64).alias("at")).agg(F.bit_or(one).alias("bits")).collect():
        out[r["at"]] = np.uint64(r["bits"] & (2 ** 64 - 1))
    return out


def _emitted(lang: str, columns: list[np.ndarray], fields: Sequence[str]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), 100_000):
        part = [c[at:at + 100_000] for c in columns]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part[0]), pa.string()),
                                          *[pa.array(c.view(np.int64)) for c in part]], names=["lang", *fields])


def _count_words(stream: int):
    """Task: occurrences of the hash of each word, combined over many texts; a second hash tells words of equal hashes apart."""
    fields = ["hash", "second", "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for lang, texts in _lang_groups(batch):
                for data, bounds in groups(texts):
                    both = [_words(data, bounds, s)[2] for s in (stream, stream + 1)]
                    yield from _added(held, lang, *_combined(both, np.ones(len(both[0]), np.int64), []), fields)
        for lang in list(held):
            yield from _emptied(held, lang, fields)
    return run


def _added(held: dict[str, list], lang: str, columns: list, n: np.ndarray, sides: list, fields: Sequence[str],
           ) -> Iterator[pa.RecordBatch]:
    """Put counted phrases to those a task holds; what cannot be combined into half of HELD is given out."""
    parts = held.setdefault(lang, [])
    parts.append((columns, n, sides))
    if sum(len(p[1]) for p in parts) > HELD:
        parts[:] = [_merged(parts)]
        if len(parts[0][1]) > HELD // 2:
            yield from _emptied(held, lang, fields)


def _emptied(held: dict[str, list], lang: str, fields: Sequence[str]) -> Iterator[pa.RecordBatch]:
    columns, n, sides = _merged(held.pop(lang))
    yield from _emitted(lang, [*columns, n, *sides], fields)


def _merged(parts: list) -> tuple[list, np.ndarray, list]:
    columns, n, sides = zip(*parts)
    return _combined([np.concatenate(c) for c in zip(*columns)], np.concatenate(n), [np.concatenate(c) for c in zip(*sides)])


RUNS_DDL = "lang string, words binary"


def _runs(stream: int, frequent: np.ndarray):
    """Task: the hashes of the frequent words in order, 0 wherever the next one does not follow directly in its piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = [], []
            for lang, texts in _lang_groups(batch):
                for data, bounds in groups(texts, RUN_BYTES):
                    _, _, hashes, _, opens = _words(data, bounds, stream)
                    kept = np.flatnonzero(_passes(frequent, phrase_keys(lang, [hashes])))
                    broken = opens[kept]
                    broken[1:] |= np.diff(kept) > 1
                    broken[:1] = True
                    values = np.zeros(len(kept) + int(broken.sum()), np.uint64)
                    values[np.arange(len(kept)) + np.cumsum(broken)] = hashes[kept]
                    if len(kept):
                        langs.append(lang)
                        out.append(values.tobytes())
            if langs:
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.binary())],
                                                 names=["lang", "words"])
    return run


SPELLED_DDL = "lang string, hash long, word binary"


def _spelled(stream: int, wanted: np.ndarray):
    """Task: the words whose hashes pass a filter, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            rows = []
            for lang, texts in _lang_groups(batch):
                for data, bounds in groups(texts):
                    starts, ends, hashes, _, _ = _words(data, bounds, stream)
                    kept = np.flatnonzero(_passes(wanted, phrase_keys(lang, [hashes])))
                    found, at = np.unique(hashes[kept].view(np.int64), return_index=True)
                    new = [(h, i) for h, i in zip(found.tolist(), kept[at].tolist()) if (lang, h) not in seen]
                    seen.update((lang, h) for h, _ in new)
                    rows += [(lang, h, LOWER[data[starts[i]:ends[i]]].tobytes()) for h, i in new]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.string(), pa.int64(), pa.binary()))], names=["lang", "hash", "word"])
    return run


def _combined(columns: list[np.ndarray], n: np.ndarray, sides: list[np.ndarray]) -> tuple[list, np.ndarray, list]:
    """Equal phrases as one: added up; ``sides`` hold the word before and after, 0 where occurrences differ in it."""
    order = np.lexsort(columns[::-1])
    columns, n, sides = [c[order] for c in columns], n[order], [s[order] for s in sides]
    new = np.zeros(len(n), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    if not len(at):
        return columns, n, sides
    same = [np.where(np.minimum.reduceat(s, at) == np.maximum.reduceat(s, at), s[at], np.uint64(0)) for s in sides]
    return [c[at] for c in columns], np.add.reduceat(n, at), same


def _count_phrases(lengths: Sequence[int], wanted: Callable[[str, list[np.ndarray]], np.ndarray], width: int,
                   with_sides: bool):
    """Task: occurrences of the phrases of these lengths that ``wanted`` admits, combined over the task's runs.

    A phrase stands in ``width`` columns, with 0 behind its last word.
    """
    fields = [*names(width), "n", *["before", "after"][:2 * with_sides]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for lang, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                w = np.frombuffer(raw.as_buffer(), np.uint64)
                wide = np.concatenate([[np.uint64(0)], w, np.zeros(width + 1, np.uint64)])
                for k in lengths:
                    at = np.flatnonzero(np.logical_and.reduce([wide[1 + i:1 + i + len(w)] != 0 for i in range(k)]))
                    none = np.zeros(len(at), np.uint64)
                    columns = [wide[1 + at + i] if i < k else none for i in range(width)]
                    passed = wanted(lang, columns)
                    at, columns = at[passed], [c[passed] for c in columns]
                    if len(at):
                        sides = [wide[at], wide[at + k + 1]] if with_sides else []
                        one = _combined(columns, np.ones(len(at), np.int64), sides)
                        yield from _added(held, lang, *one, fields)
        for lang in list(held):
            yield from _emptied(held, lang, fields)
    return run


def names(k: int) -> list[str]:
    return [f"w{i + 1}" for i in range(k)]


def _ddl(k: int, sides: bool) -> str:
    return ", ".join(["lang string", *[f"{w} long" for w in names(k)], "n long", *["before long", "after long"][:2 * sides]])


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), exact: factors of at most 15 and 18 digits, products in 38."""
    big = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * big[0] * n.cast("decimal(18,0)"), big[1] * big[2])


# ---------------------------------------------------------------- rounds

class Corpus:
    """The frequent words of a corpus and its texts as runs of them."""

    def __init__(self, docs: DataFrame, rules: Rules):
        texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
        self.texts, self.stream = texts, 11     # the stream of random numbers for the hash
        while True:
            counts = staged(staged_texts(
                texts.mapInArrow(_count_words(self.stream), "lang string, hash long, second long, n long"),
                "word-counts").groupBy("lang", "hash").agg(
                F.sum("n").alias("n"), F.min("second").alias("low"), F.max("second").alias("high")), "words")
            self.sizes = staged(counts.groupBy("lang").agg(F.sum("n").alias("total")), "sizes")
            self.words = staged(counts.filter(F.col("n") >= rules.least), "frequent-words")
            if self.words.filter("low <> high").isEmpty():
                break
            self.stream += 2
        frequent = filter_of(self.words.withColumnRenamed("hash", "w1"), ["w1"])
        self.runs = staged_texts(texts.mapInArrow(_runs(self.stream, frequent), RUNS_DDL), "runs")

    def spelled(self, hashes: DataFrame) -> DataFrame:
        """The words of some hashes (lang, hash)."""
        bits = filter_of(hashes.withColumnRenamed("hash", "w1"), ["w1"])
        found = staged_texts(self.texts.mapInArrow(_spelled(self.stream, bits), SPELLED_DDL), "spelled")
        return hashes.join(found.distinct(), ["lang", "hash"])

    def staged(self, df: DataFrame, purpose: str) -> DataFrame:
        """``staged`` for what is counted in the runs, which go to the Python workers a few at a time."""
        with batches_of(df.sparkSession, RUNS_AT_ONCE):
            return staged(df, purpose)

    def count(self, lengths: Sequence[int], wanted, width: int, sides: bool = False) -> DataFrame:
        return self.runs.mapInArrow(_count_phrases(lengths, wanted, width, sides), _ddl(width, sides))


def _grown(corpus: Corpus, first: DataFrame, rules: Rules) -> DataFrame | None:
    """Frequent phrases of two words and more that begin with one of ``first`` (lang, w1, l1).

    k is the number of words w1, w2 ..., with 0 behind the last; l1, l2 ... are the counts of the prefixes, null behind
    the phrase's own.
    """
    out, prefix = None, first
    for k in range(2, rules.longest + 1):
        bits = filter_of(prefix, names(k - 1))

        def wanted(lang: str, columns: list[np.ndarray], bits=bits, k=k) -> np.ndarray:
            return _passes(bits, phrase_keys(lang, columns[:k - 1]))

        counts = corpus.count([k], wanted, k).groupBy("lang", *names(k)).agg(F.sum("n").alias(f"l{k}")).filter(
            F.col(f"l{k}") >= rules.least)
        prefix = corpus.staged(counts.join(prefix, ["lang", *names(k - 1)]), f"phrases-{k}")
        if prefix.isEmpty():
            break
        more = range(k + 1, rules.longest + 1)
        whole = prefix.withColumns({"k": F.lit(k), **{f"w{i}": F.lit(0).cast("long") for i in more},
                                    **{f"l{i}": F.lit(None).cast("long") for i in more}})
        out = whole if out is None else out.unionByName(whole)
    return out


def _scored(corpus: Corpus, grown: DataFrame, bar: DataFrame, rules: Rules) -> DataFrame:
    """Score and cut of the phrases that no equally frequent longer one holds and whose bounds reach the ``bar``."""
    n, words = rules.longest, names(rules.longest)
    parts = [F.col(f"l{j}") for j in range(1, n + 1)]
    last = corpus.words.select("lang", F.col("hash").alias("last"), F.col("n").alias("r_last"))
    known = grown.withColumn("last", F.element_at(F.array(*words), F.col("k"))).join(last, ["lang", "last"]).join(
        corpus.sizes, "lang").join(bar, "lang").withColumns({
            "a": F.element_at(F.array(*parts), F.col("k")), "l_last": F.element_at(F.array(*parts), F.col("k") - 1)})
    own, total = F.col("a"), F.col("total")
    # the rest after a cut is as frequent as the phrase at least; the last word's count is known
    bound = F.least(*[F.when(F.col("k") > j, _score(own, total, parts[j - 1], own)) for j in range(1, n)],
                    _score(own, total, F.col("l_last"), F.col("r_last")))
    held = staged(known.withColumn("bound", bound).filter(F.col("bound") >= F.col("bar")), "open")
    # best first: those of the highest bounds settle what the others must reach
    best = _last_place(held.select("lang", F.col("bound").alias("score")), 2 * rules.top).withColumnRenamed("score", "least")
    ahead = held.join(best, "lang", "left").withColumn("least", F.coalesce("least", F.lit(0)))
    first = staged(_exact(corpus, ahead.filter(F.col("bound") >= F.col("least")).drop("least"), rules), "first")
    settled = _bar(corpus, first, rules).withColumnRenamed("bar", "settled")
    behind = staged(ahead.filter(F.col("bound") < F.col("least")).join(settled, "lang").filter(
        F.col("bound") >= F.col("settled")).drop("least", "settled"), "behind")
    return first if behind.isEmpty() else first.unionByName(_exact(corpus, behind, rules))


def _exact(corpus: Corpus, held: DataFrame, rules: Rules) -> DataFrame:
    """Score and cut of the phrases of ``held`` by the counts of all their rests."""
    n, words = rules.longest, names(rules.longest)
    parts = [F.col(f"l{j}") for j in range(1, n + 1)]
    own, total = F.col("a"), F.col("total")
    # the rests of a phrase, itself among them; 0 fills up behind the last word
    padded = F.concat(F.array(*words), F.array(*[F.lit(0).cast("long")] * n))
    rests = held.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 2)).alias("cut")).withColumn(
        "rest", F.slice(padded, F.col("cut") + 1, n))
    rest_words = [F.col("rest")[i].alias(w) for i, w in enumerate(words)]
    bits = filter_of(rests.select("lang", *rest_words).distinct(), words)
    counts = corpus.count(range(2, n + 1), lambda lang, columns: _passes(bits, phrase_keys(lang, columns)), n, True)

    def always(c: str) -> Column:
        """The word that stands there in all places, 0 if there is none."""
        return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(0).alias(c)

    details = corpus.staged(counts.groupBy("lang", *words).agg(F.sum("n").alias("r"), always("before"), always("after")),
                            "details").select("lang", F.array(*words).alias("rest"), "r", "before", "after")
    left = F.get(F.array(*parts), F.col("cut") - 1)
    cut = F.struct(_score(own, total, left, F.col("r")).alias("score"), "cut", left.alias("l"), "r")
    held_in_longer = (F.col("k") < n) & ((F.col("before") != 0) | (F.col("after") != 0))
    inner = rests.join(details, ["lang", "rest"]).groupBy("lang", *words).agg(
        F.min(F.when(F.col("cut") > 0, cut)).alias("inner"), F.max((F.col("cut") == 0) & held_in_longer).alias("held"))
    at_last = F.struct(_score(own, total, F.col("l_last"), F.col("r_last")).alias("score"), (F.col("k") - 1).alias("cut"),
                       F.col("l_last").alias("l"), F.col("r_last").alias("r"))
    return held.join(inner, ["lang", *words]).filter("NOT held").withColumn(
        "best", F.array_min(F.array("inner", at_last))).filter(F.col("best.score") >= F.col("bar")).select(
        "lang", F.slice(F.array(*words), 1, F.col("k")).alias("words"), "a", "best.l", "best.r", F.col("total").alias("n"),
        "best.score")


def _last_place(rows: DataFrame, top: int) -> DataFrame:
    """The score at place ``top`` of each language that has so many rows."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"))
    return rows.select("lang", "score").withColumn("place", F.row_number().over(order)).filter(
        F.col("place") <= top).filter(F.col("place") == top).select("lang", "score")


def _bar(corpus: Corpus, rows: DataFrame | None, rules: Rules) -> DataFrame:
    """The score of each language's last place so far; 0 where places are free."""
    if rows is None:
        return corpus.sizes.select("lang", F.lit(0).cast("long").alias("bar"))
    last = _last_place(rows, rules.top).withColumnRenamed("score", "bar")
    return corpus.sizes.select("lang").join(last, "lang", "left").select("lang", F.coalesce("bar", F.lit(0)).alias("bar"))


def mine(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first phrases of each language (null: und).

    Null and empty texts have no words. A phrase lies within a piece; ties in score go to the more frequent phrase, then
    to the lesser in UTF-8. Columns other than ``text`` and ``lang`` are ignored. Without any frequent phrase the result
    is empty.
    """
    corpus = Corpus(docs, rules)
    # the reach of each round: words of up to so many occurrences, by classes of a quarter of a power of two
    level = F.floor(4 * F.log2("n"))
    levels = corpus.words.groupBy("lang", level.alias("level")).agg(F.sum("n").alias("n")).join(corpus.sizes, "lang")
    upto = Window.partitionBy("lang").orderBy("level")
    levels = staged(levels.withColumn("before", F.sum("n").over(upto) - F.col("n")).select(
        "lang", "level", F.least(*[
            F.when(F.col("before") * share < F.col("total"), turn).otherwise(len(rules.shares) - 1)
            for turn, share in enumerate(rules.shares)]).alias("turn")), "levels")
    words = corpus.words.withColumn("level", level).join(levels, ["lang", "level"]).select(
        "lang", F.col("hash").alias("w1"), F.col("n").alias("l1"), "turn")
    rows = None
    for turn in range(len(rules.shares)):
        bar = staged(_bar(corpus, rows, rules), "bar")
        bound = F.floor(F.col("total").cast("decimal(38,0)") * 1000 / F.col("l1"))
        first = staged(words.filter(F.col("turn") == turn).join(bar, "lang").join(corpus.sizes, "lang").filter(
            bound >= F.col("bar")).select("lang", "w1", "l1"), "frontier")
        grown = None if first.isEmpty() else _grown(corpus, first, rules)
        if grown is not None:
            new = _scored(corpus, grown, bar, rules)
            rows = staged(new if rows is None else rows.unionByName(new), "rows")
    if rows is None:
        return _empty(docs)
    rows = staged(rows.join(_bar(corpus, rows, rules), "lang").filter("score >= bar"), "best")
    placed = rows.select("lang", "words", F.posexplode("words").alias("at", "hash"))
    spelled = placed.join(corpus.spelled(staged(placed.select("lang", "hash").distinct(), "their-words")), ["lang", "hash"]).groupBy(
        "lang", "words").agg(
        # at most ``longest`` words
        F.sort_array(F.collect_list(F.struct("at", F.decode("word", "UTF-8").alias("word")))).alias("spelled"))
    rows = rows.join(spelled, ["lang", "words"]).withColumn(
        "phrase", F.array_join(F.transform("spelled", lambda s: s["word"]), " "))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(place).cast("long")).filter(F.col("rank") <= rules.top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _empty(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.createDataFrame(
        [], "lang string, rank long, phrase string, a long, l long, r long, n long, score long")
