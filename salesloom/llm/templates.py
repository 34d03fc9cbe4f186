"""Line de-duplication by log templates.

Lines are sorted into a tree of fixed depth: by their number of tokens, then by their leading tokens. Tokens with a
digit are variable fields from the start; they are all the same token. Within a leaf every token is a field; a token
that enough documents of the leaf have at the same place is constant, any other is variable. The constant tokens and
their places make the line's template. A template that enough documents hold is recurring, and its lines are dropped but for the first
one, so that text of copied documents does not vanish altogether. A line with next to no variable fields needs no
template: if two documents hold it, it is dropped but for the first one.

Counting replaces the usual one-line-at-a-time matching of such trees: the outcome does not depend on the order of
lines, and no leaf has to fit into one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.store import set_aside, staged, staged_texts
from salesloom.llm.words import IS_SPACE, LOWER, groups, mixed, seeds, segment_hashes

VARIABLE = np.uint64(0)
PLACES = seeds(1 << 16, 9) | np.uint64(1)
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LEAF_BITS = 22  # of a filter of leaves; a leaf that passes it by chance is taken out by a join
LINES = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("line", pa.int32()), ("n", pa.int32()),
                   ("leaf", pa.int64()), ("whole", pa.int64()), ("plain", pa.int32())])
TOKENS = pa.schema([*list(LINES)[:5], ("tokens", pa.list_(pa.int64()))])
LINES_DDL = "doc_id long, text_hash long, line int, n int, leaf long, whole long, plain int"
TOKENS_DDL = "doc_id long, text_hash long, line int, n int, leaf long, tokens array<long>"


@dataclass(frozen=True)
class Tree:
    leading: int = 3          # tokens that name a leaf, beside the number of tokens
    least_docs: int = 10      # documents that make a token constant and a template recurring
    least_words: int = 3      # without a digit, in a line that two documents make recurring
    most_variable: int = 10   # per cent of such a line's tokens that may have a digit
    constant_share: int = 60  # per cent of a template's tokens that are constant, at least


def _lines(leading: int, leaves: np.ndarray | None = None):
    """Task: leaf and hash of each line that has a word; with a filter of leaves, the tokens of the lines that pass."""
    schema = LINES if leaves is None else TOKENS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, hashes, row = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(), 0
            null = np.array(batch.column(0).is_null())
            for data, bounds in groups(batch.column(2)):
                *out, at, h = _group(data, bounds, leading)
                own = out[0] + row
                row += len(bounds) - 1
                if leaves is None:
                    columns = [pa.array(c) for c in out[1:]]
                else:
                    slot = out[3].view(np.uint64) & np.uint64((1 << LEAF_BITS) - 1)
                    passed = (leaves[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0
                    own, n = own[passed], out[2][passed]
                    ends = np.cumsum(n, dtype=np.int64)
                    places = np.arange(ends[-1] if len(n) else 0) + np.repeat(at[passed] - ends + n, n)
                    tokens = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)),
                                                      pa.array(h[places].view(np.int64)))
                    columns = [*(pa.array(c[passed]) for c in out[1:4]), tokens]
                ids = pa.array(np.where(null[own], 0, keys[own]).astype(np.int64), mask=null[own])
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes[own]), *columns], schema=schema)
    return run


def _group(data: np.ndarray, bounds: np.ndarray, leading: int) -> list[np.ndarray]:
    """Row, line, number of tokens, leaf, hash of the whole line, number of tokens without a digit and first token of
    the lines with words of a group of texts; last, the hashes of all tokens."""
    inside = ~IS_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] |= inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return [np.zeros(0, t) for t in ("i8", "i4", "i4", "i8", "i8", "i4", "i8", "u8")]
    h = segment_hashes(np.where(inside, LOWER[data].astype(np.uint64) + np.uint64(1), np.uint64(0)), starts)
    exact, digits = h, np.add.reduceat(DIGIT[data].astype(np.int32), starts) > 0
    h = np.where(digits, VARIABLE, h)
    breaks = np.flatnonzero(data == 10)
    row_of = np.searchsorted(bounds, starts, side="right") - 1
    # lines of all rows in order: a row's first line, then one for each newline
    line_of = np.searchsorted(breaks, starts) + row_of
    at = np.flatnonzero(np.diff(line_of, prepend=-1))       # first word of each line
    n = np.diff(at, append=len(h))
    rows = row_of[at]
    line = np.searchsorted(breaks, starts[at]) - np.searchsorted(breaks, bounds[rows])
    leaf = n.astype(np.uint64)
    for k in range(leading):
        leaf = np.where(n > k, mixed(leaf + h[np.minimum(at + k, len(h) - 1)] + np.uint64(k)), leaf)
    place = np.arange(len(h)) - np.repeat(at, n)
    whole = mixed(np.add.reduceat(exact * PLACES[place % len(PLACES)], at) + n.astype(np.uint64))
    plain = np.add.reduceat((~digits).astype(np.int32), at)
    return [rows, line.astype(np.int32), n.astype(np.int32), leaf.view(np.int64), whole.view(np.int64),
            plain.astype(np.int32), at, h]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"__id": F.col("doc_id").cast("long"), "__hash": F.xxhash64(text)})


def _leaf_filter(leaves: DataFrame) -> np.ndarray:
    """A bit for each value of the last bits of a leaf; at most 2 ** (LEAF_BITS - 6) rows come to the driver."""
    slot = F.col("leaf").bitwiseAND((1 << LEAF_BITS) - 1)
    bits = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    out = np.zeros(1 << (LEAF_BITS - 6), np.uint64)
    for r in leaves.groupBy(F.floor(slot / 64).alias("word")).agg(F.bit_or(bits).alias("bits")).collect():
        out[r["word"]] = np.uint64(r["bits"] & (2 ** 64 - 1))
    return out


def equal_lines(found: DataFrame, tree: Tree) -> DataFrame:
    """Lines that two documents hold word for word, but for the first: doc_id, text_hash, line, template."""
    few = (F.col("n") - F.col("plain")) * 100 <= F.col("n") * tree.most_variable
    own = found.filter(few & (F.col("plain") >= tree.least_words)).select("doc_id", "text_hash", "line", "whole")
    document = F.xxhash64("doc_id", "text_hash")
    several = staged(own.groupBy("whole").agg(F.min(document).alias("low"), F.max(document).alias("high")).filter(
        "low < high").select("whole"), "equal-lines")
    lines = staged(own.join(several, "whole"), "lines-held-equally")
    here = F.struct("doc_id", "text_hash", "line")
    first = staged(lines.groupBy("whole").agg(F.min(here).alias("first")), "first-lines")
    return lines.join(first, "whole").filter(~here.eqNullSafe(F.col("first"))).select(
        "doc_id", "text_hash", "line", F.col("whole").alias("template"))


def recurring_lines(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """Lines to drop: doc_id, text_hash, line (from 0), template.

    All lines of recurring templates but the first by doc_id, text_hash and line, and all lines that two documents
    hold word for word but the first. A line that both rules drop has two rows.
    """
    texts = _keyed(docs).select("__id", "__hash", "text")
    found = staged_texts(texts.mapInArrow(_lines(tree.leading), LINES_DDL), "lines")
    leaves = staged(found.groupBy("leaf").agg(F.count("*").alias("lines")).filter(
        F.col("lines") >= tree.least_docs).select("leaf"), "leaves")
    # tokens are written for lines of these leaves only
    passing = staged_texts(texts.mapInArrow(_lines(tree.leading, _leaf_filter(leaves)), TOKENS_DDL), "tokens")
    lines = staged(passing.join(leaves, "leaf").withColumn("form", F.xxhash64("tokens")), "lines-of-leaves")
    # lines of the same tokens are one form, so that a very common line is looked up once
    fields = lines.select("leaf", "form", "n", "tokens").distinct().select(
        "leaf", "form", "n", F.posexplode("tokens").alias("place", "token"))
    document = F.xxhash64("doc_id", "text_hash").alias("document")
    constant = staged(lines.select("leaf", document, "form", "tokens").distinct().select(
        "leaf", "document", F.posexplode("tokens").alias("place", "token")).distinct().groupBy(
        "leaf", "place", "token").agg(F.count("*").alias("docs")).filter(
        F.col("docs") >= tree.least_docs).select("leaf", "place", "token"), "constant")
    shapes = staged(fields.join(constant, ["leaf", "place", "token"]).groupBy("leaf", "form", "n").agg(
        F.count("*").alias("constant"), F.bit_xor(F.xxhash64("place", "token")).alias("shape")).filter(
        F.col("constant") * 100 >= F.col("n") * tree.constant_share).select(
        "leaf", "form", F.xxhash64("leaf", "shape").alias("template")), "shapes")
    shaped = staged(lines.select("doc_id", "text_hash", "line", "leaf", "form").join(shapes, ["leaf", "form"]), "shaped")
    often = shaped.select("leaf", "template", document).distinct().groupBy("leaf", "template").agg(
        F.count("*").alias("docs")).filter(F.col("docs") >= tree.least_docs)
    first = shaped.groupBy("leaf", "template").agg(F.min(F.struct("doc_id", "text_hash", "line")).alias("first"))
    known = staged(often.join(first, ["leaf", "template"]).select("leaf", "template", "first"), "templates")
    here = F.struct("doc_id", "text_hash", "line")
    return shaped.join(known, ["leaf", "template"]).filter(~here.eqNullSafe(F.col("first"))).select(
        "doc_id", "text_hash", "line", "template").unionByName(equal_lines(found, tree))


def assess(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """All columns of ``docs`` with n_lines, n_dropped and clean_text; columns of these names are replaced.

    A null text has one empty line; lines without words are never dropped. Rows that repeat doc_id and text keep or
    lose the same lines. A null doc_id counts as a document of its own for each text. Documents join their dropped
    lines by doc_id and a hash of the text.
    """
    docs = docs.drop("n_lines", "n_dropped", "clean_text")
    drops = staged(recurring_lines(docs, tree).groupBy("doc_id", "text_hash").agg(
        F.collect_set("line").alias("__drop")), "dropped")  # at most the lines of one text
    keyed = _keyed(docs)
    joined = keyed.join(drops, F.col("__id").eqNullSafe(drops["doc_id"]) & (F.col("__hash") == drops["text_hash"]),
                        "left").drop(drops["doc_id"], drops["text_hash"])
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    out = joined.withColumn("__lines", lines)
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drop"))
    text = F.coalesce("text", F.lit(""))
    clean = F.when(F.col("__drop").isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("__lines"), i)), "\n"))
    out = out.withColumns({"n_lines": F.size("__lines").cast("long"), "clean_text": clean,
                           "n_dropped": F.when(F.col("__drop").isNull(), F.lit(0)).otherwise(F.size("__drop")).cast("long")})
    return out.drop("__id", "__hash", "__lines", "__drop")


def clean(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """The documents without recurring lines; documents of which nothing but those remains are left out."""
    safe, back = set_aside(docs, ["n_lines", "n_dropped", "clean_text"])
    out = assess(safe, tree).filter(~((F.col("n_dropped") > 0) & ~F.rlike("clean_text", F.lit(r"[^\x20\x09-\x0D]"))))
    changed = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("clean_text").cast("long")
    return back(out.withColumns(changed))
