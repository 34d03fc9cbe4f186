"""Token ids in files coded with a static range asymmetric numeral system.

One frequency table, counted over all documents, is shared by every file. A file holds blocks of whole documents in
ascending ``doc_id`` order; each block is coded by itself with many interleaved states, so that a step of the coder
handles a whole vector of tokens, and carries a checksum. The index at the end of a file holds a checkpoint for each
block (its place in the file and the number of tokens before it), so blocks are decoded in parallel and in any order.

Block: magic, numbers of documents, tokens, states and words, doc_ids, lengths, final states, words, CRC-32.
File: blocks, index rows (place, size, documents, tokens, tokens before), number of rows, CRC-32 of the index, magic.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from struct import calcsize, pack, unpack

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.store import filesystem, staged, staged_texts, work_folder
from salesloom.llm.tokens import encoded

SCALE = 20                    # frequencies add up to 2 ** SCALE
LOW = np.uint64(1 << 31)      # states stay in [LOW, LOW << 32); 32-bit words move in and out
STATES = 4096                 # interleaved states of a full block
BLOCK_TOKENS = 1 << 19        # a block ends with the document that reaches this size
BLOCKS_A_TASK = 8             # read by a task, one after the other
HEAD, INDEX_ROW, TAIL = "<4sIQII", "<QQQQQ", "<II4s"
MAGIC = b"rANS"


# ---------------------------------------------------------------- coder

class Table:
    """Frequencies of the shared model, scaled to add up to 2 ** SCALE; every counted id keeps one at least."""

    def __init__(self, frequencies: np.ndarray):
        self.f = frequencies.astype(np.uint64)
        self.c = np.concatenate([[0], np.cumsum(self.f)[:-1]]).astype(np.uint64) if len(self.f) else self.f
        self.symbol = np.repeat(np.arange(len(self.f), dtype=np.uint32), frequencies.astype(np.int64))

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        counts = counts.astype(object)  # exact: a corpus may hold more than 2 ** 44 tokens
        seen, total = int((counts > 0).sum()), int(counts.sum())
        if not total:
            return cls(np.zeros(0, dtype=np.int64))
        if seen >= 1 << SCALE:
            raise ValueError("more ids than the model has room for; raise SCALE")
        room = (1 << SCALE) - seen
        f = np.array([1 + n * room // total if n else 0 for n in counts], dtype=np.int64)
        f[int(np.argmax(f))] += (1 << SCALE) - int(f.sum())
        return cls(f)

    def to_bytes(self) -> bytes:
        body = self.f.astype("<u4").tobytes()
        return pack("<4sII", b"rTAB", len(self.f), zlib.crc32(body)) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> Table:
        magic, n, check = unpack("<4sII", data[:12])
        if magic != b"rTAB" or len(data) != 12 + 4 * n or zlib.crc32(data[12:]) != check:
            raise ValueError("damaged frequency table")
        return cls(np.frombuffer(data, "<u4", n, 12).astype(np.int64))


def encode_tokens(ids: np.ndarray, table: Table, states: int) -> tuple[np.ndarray, np.ndarray]:
    """Final states and words. Token i belongs to state i mod ``states``; words lie in the decoder's order."""
    x = np.full(states, LOW, dtype=np.uint64)
    words, shift, bits = [], np.uint64(63 - SCALE), np.uint64(32)
    low_word, scale = np.uint64(0xFFFFFFFF), np.uint64(SCALE)
    for start in range((len(ids) - 1) // states * states, -1, -states):
        part = ids[start:start + states]
        f, y = table.f[part], x[:len(part)]
        full = (y >> shift) >= f
        if full.any():
            words.append((y[full] & low_word).astype("<u4"))
            y = np.where(full, y >> bits, y)
        div = y // f
        x[:len(part)] = (div << scale) + (y - div * f) + table.c[part]
    return x, np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")


def decode_tokens(x: np.ndarray, words: np.ndarray, n: int, table: Table) -> np.ndarray:
    x, states, at = x.copy(), len(x), 0
    out = np.empty(n, dtype=np.uint32)
    mask, scale, bits = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
    for start in range(0, n, states):
        y = x[:min(states, n - start)]
        slot = y & mask
        part = table.symbol[slot]
        out[start:start + len(y)] = part
        y = table.f[part] * (y >> scale) + slot - table.c[part]
        short = np.flatnonzero(y < LOW)
        if len(short):
            y[short] = (y[short] << bits) | words[at:at + len(short)]
            at += len(short)
        x[:len(y)] = y
    if at != len(words) or (x != LOW).any():
        raise ValueError("damaged block: the coder did not come back to its first state")
    return out


def encode_block(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, table: Table) -> bytes:
    """One block. A null doc_id is stored as the least 64-bit integer."""
    states = max(1, min(STATES, len(ids) // 64))
    x, words = encode_tokens(ids, table, states) if len(ids) else (np.zeros(0, np.uint64), np.zeros(0, "<u4"))
    keys = np.array([NULL_ID if d is None else d for d in doc_ids], dtype="<i8")
    body = b"".join([pack(HEAD, MAGIC, len(keys), len(ids), len(x), len(words)), keys.tobytes(),
                     np.array(lengths, dtype="<u8").tobytes(), x.astype("<u8").tobytes(), words.tobytes()])
    return body + pack("<I", zlib.crc32(body))


def decode_block(data: bytes, table: Table) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_ids, lengths and ids of a block; raises ValueError if it is damaged."""
    head = calcsize(HEAD)
    if len(data) < head + 4 or zlib.crc32(data[:-4]) != unpack("<I", data[-4:])[0]:
        raise ValueError("damaged block: wrong checksum")
    magic, docs, tokens, states, n_words = unpack(HEAD, data[:head])
    if magic != MAGIC:
        raise ValueError("not a block")
    keys = np.frombuffer(data, "<i8", docs, head)
    lengths = np.frombuffer(data, "<u8", docs, head + 8 * docs).astype(np.int64)
    x = np.frombuffer(data, "<u8", states, head + 16 * docs)
    words = np.frombuffer(data, "<u4", n_words, head + 16 * docs + 8 * states).astype(np.uint64)
    ids = decode_tokens(x.astype(np.uint64), words, tokens, table) if tokens else np.zeros(0, np.uint32)
    return [None if k == NULL_ID else int(k) for k in keys], lengths, ids


NULL_ID = -(1 << 63)


# ---------------------------------------------------------------- Spark

def _raw_blocks(docs: Iterator[tuple[int | None, np.ndarray]], end_id: int,
                ) -> Iterator[tuple[list, list, np.ndarray]]:
    keys, lengths, parts, size = [], [], [], 0
    end = np.array([end_id], np.uint32)
    for key, ids in docs:
        keys.append(key)
        lengths.append(len(ids) + 1)
        parts += [ids, end]
        size += lengths[-1]
        if size >= BLOCK_TOKENS:
            yield keys, lengths, np.concatenate(parts)
            keys, lengths, parts, size = [], [], [], 0
    if keys:
        yield keys, lengths, np.concatenate(parts)


def _write_raw(folder: str, tokenizer: str, end_id: int):
    """Task: encode the texts of a range of documents and keep the ids, compressed, with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for batch in batches:
                keys = batch.column(0).to_pylist()
                yield from zip(keys, encoded(batch.column(1), tokenizer))

        part = TaskContext.get().partitionId()
        fs, root = filesystem(folder)
        name = f"{root}/raw-{part:06d}-{uuid.uuid4().hex}"
        counts, n_docs, n_tokens, out = np.zeros(0, np.int64), 0, 0, None
        for keys, lengths, ids in _raw_blocks(documents(), end_id):
            out = out or fs.open_output_stream(name)
            found = np.bincount(ids, minlength=len(counts))
            found[:len(counts)] += counts
            counts = found
            n_docs, n_tokens = n_docs + len(keys), n_tokens + len(ids)
            plain = ids.astype("<u2" if ids.max() < 1 << 16 else "<u4")
            squeezed = pa.compress(plain.tobytes(), codec="zstd", asbytes=True)
            out.write(pack("<IIII", len(keys), len(ids), plain.itemsize, len(squeezed)))
            out.write(np.array([NULL_ID if k is None else k for k in keys], "<i8").tobytes())
            out.write(np.array(lengths, "<u8").tobytes())
            out.write(squeezed)
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({
                "part": [part], "raw": [name.rsplit("/", 1)[1]], "n_docs": [n_docs], "n_tokens": [n_tokens],
                "counts": [counts.astype("<i8").tobytes()]}, schema=RAW)
    return run


RAW = pa.schema([("part", pa.int64()), ("raw", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                 ("counts", pa.binary())])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        for one in batch.column(0):
            one = np.frombuffer(one.as_py(), "<i8")
            if len(one) > len(total):
                one, total = total, one.copy()
            total[:len(one)] += one
    if len(total):
        yield pa.RecordBatch.from_pydict({"counts": [total.tobytes()]}, schema=pa.schema([("counts", pa.binary())]))


def _write_coded(folder: str):
    """Task: code the kept ids of a range with the shared table, block by block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        table = None
        for batch in batches:
            for part, raw in zip(batch.column("part").to_pylist(), batch.column("raw").to_pylist()):
                table = table or Table.from_bytes(_read(fs, f"{root}/table"))
                name, rows, at, before = f"tokens-{part:06d}-{uuid.uuid4().hex}.rans", [], 0, 0
                with fs.open_input_stream(f"{root}/{raw}") as source, fs.open_output_stream(f"{root}/{name}") as out:
                    while head := source.read(16):
                        n, tokens, width, size = unpack("<IIII", head)
                        keys = np.frombuffer(source.read(8 * n), "<i8").tolist()
                        lengths = np.frombuffer(source.read(8 * n), "<u8").tolist()
                        plain = pa.decompress(source.read(size), tokens * width, codec="zstd", asbytes=True)
                        block = encode_block(keys, lengths, np.frombuffer(plain, f"<u{width}"), table)
                        out.write(block)
                        rows.append((at, len(block), n, tokens, before))
                        at, before = at + len(block), before + tokens
                    index = b"".join(pack(INDEX_ROW, *r) for r in rows)
                    out.write(index + pack(TAIL, len(rows), zlib.crc32(index), MAGIC))
                yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_tokens": [before]}, schema=FILES)
    return run


FILES = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_tokens", pa.int64())])


def _read(fs, path: str) -> bytes:
    with fs.open_input_stream(path) as source:
        return source.read()


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Encode ``text`` and write the coded files into ``folder``; one row (part, file, n_tokens) for each file.

    ``docs`` has ``doc_id`` and ``text``; other columns are ignored. Null texts are empty, every document ends with
    ``end_id``. Files follow each other in ascending doc_id order (nulls first); rows with equal ids keep their rows,
    ordered by text. An empty table writes no file. Texts are encoded once: their ids are kept, compressed, in
    ``folder`` while the table of frequencies is counted. Only that table, bounded by the vocabulary, and one row
    for each file pass through the driver.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).repartitionByRange(
        F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    fs, root = filesystem(folder)
    fs.create_dir(root, recursive=True)
    raw = staged_texts(ordered.mapInArrow(
        _write_raw(folder, tokenizer, end_id),
        "part long, raw string, n_docs long, n_tokens long, counts binary"), "rans-raw")
    sums = raw.select("counts").coalesce(16).mapInArrow(_added, "counts binary").collect()
    total = np.zeros(max([0, *(len(r.counts) // 8 for r in sums)]), np.int64)
    for r in sums:
        one = np.frombuffer(r.counts, "<i8")
        total[:len(one)] += one
    with fs.open_output_stream(f"{root}/table") as out:
        out.write(Table.of_counts(total).to_bytes())
    files = raw.count()
    return staged(raw.select("part", "raw").repartition(max(1, files)).mapInArrow(
        _write_coded(folder), "part long, file string, n_tokens long"), "rans-files")


def _index(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        tail, row = calcsize(TAIL), calcsize(INDEX_ROW)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as source:
                    size = source.size()
                    n, check, magic = unpack(TAIL, source.read_at(tail, size - tail))
                    index = source.read_at(n * row, size - tail - n * row)
                if magic != MAGIC or zlib.crc32(index) != check:
                    raise ValueError(f"damaged index of {name}")
                rows = [unpack(INDEX_ROW, index[i:i + row]) for i in range(0, len(index), row)]
                yield pa.RecordBatch.from_pydict({
                    "file": [name] * n, "at": [r[0] for r in rows], "size": [r[1] for r in rows],
                    "start": [base + r[4] for r in rows]}, schema=BLOCKS)
    return run


BLOCKS = pa.schema([("file", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("start", pa.int64())])


def blocks(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """A row for each block with its place and ``start``, the number of tokens before it in all files."""
    rows = sorted((r.part, r.file, r.n_tokens) for r in files.collect())  # one row for each file
    bases, before = [], 0
    for _, name, n in rows:
        bases.append((name, before))
        before += n
    listed = spark.createDataFrame(bases, "file string, base long")
    return listed.repartition(max(1, min(len(bases), 200))).mapInArrow(
        _index(folder), "file string, at long, size long, start long")


def _decode(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        table = None
        for batch in batches:
            for name, at, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size", "start"))):
                table = table or Table.from_bytes(_read(fs, f"{root}/table"))
                with fs.open_input_file(f"{root}/{name}") as source:
                    keys, lengths, ids = decode_block(source.read_at(size, at), table)
                ends = np.cumsum(lengths)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": keys, "start": start + ends - lengths, "n_tokens": lengths,
                    "ids": _cut(ids, ends)}, schema=READ)
    return run


def _cut(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The ids of each document as bytes, on one buffer: Arrow never frees what a list of memoryviews is made of."""
    offsets = pa.array(np.append(0, 4 * ends), pa.int32())  # raises if they pass 2 GB
    return pa.Array.from_buffers(pa.binary(), len(ends), [
        None, offsets.buffers()[1], pa.py_buffer(ids.astype("<u4", copy=False))])


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """The documents in the files: doc_id, start, n_tokens and ids (little-endian unsigned 32-bit).

    Blocks are decoded in parallel, each from its checkpoint; a damaged block, index or table raises an error.
    """
    found = staged(blocks(spark, files, folder), "rans-blocks")
    return found.repartition(max(1, -(-found.count() // BLOCKS_A_TASK))).mapInArrow(
        _decode(folder), "doc_id long, start long, n_tokens long, ids binary")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write ``docs`` to coded files in the shared work folder and read them back."""
    folder = work_folder(docs.sparkSession, "rans")
    return read(docs.sparkSession, write(docs, folder, tokenizer, end_id), folder)
