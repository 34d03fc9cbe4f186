"""Token files, packing, WARC, near duplicates, mixing and the pipeline."""

import gc
import math
import os
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from test_llm_round2 import five_word_components

from salesloom.llm import mixing, near_dup, packing, rans, tokens, warc
from salesloom.llm.store import work_folder


def plain_ids(tokenizer, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    return [e.ids for e in model.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]


def test_encoder_equals_the_tokenizer(tokenizer, real_docs):
    texts = [r.text for r in real_docs.select("text").collect()] + [
        "", " ", "\n", " a", "a ", "a  b", "a\n\nb", "a\tb", "don't we'll", "x<|endoftext|>y", "a b c", "a　b",
        "(foo) 'bar' a.b.c é.é (é) a'b ''s", None, "x" * 5000 + " y", "🙂 a🙂b .🙂", "a\x1cb\x85c"]
    got = [g.tolist() for _ in range(2) for g in tokens.encoded(pa.array(texts), tokenizer)]
    assert got == plain_ids(tokenizer, texts) * 2


def test_rans_round_trip_and_damage():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.geometric(0.01, 200_000), 50_000).astype(np.uint32)
    table = rans.Table.from_bytes(rans.Table.of_counts(np.bincount(ids)).to_bytes())
    lengths = [0, 1, 99_999, 100_000]
    block = rans.encode_block([1, None, 3, 4], lengths, ids, table)
    keys, found, back = rans.decode_block(block, table)
    assert keys == [1, None, 3, 4] and found.tolist() == lengths and (back == ids).all()
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert len(block) < 1.1 * entropy + 8 * rans.STATES
    with pytest.raises(ValueError):
        rans.decode_block(block[:500] + bytes([block[500] ^ 1]) + block[501:], table)
    one = rans.Table.of_counts(np.array([0, 7]))
    assert (rans.decode_block(rans.encode_block([1], [7], np.full(7, 1), one), one)[2] == 1).all()


def test_rans_files(spark, odd_docs, no_docs, tokenizer):
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    want, start = [], 0
    for r, ids in zip(rows, plain_ids(tokenizer, [r.text for r in rows])):
        want.append((r.doc_id, start, len(ids) + 1, zlib.crc32(np.array(ids + [0], "<u4").tobytes())))
        start += len(ids) + 1
    got = rans.round_trip(odd_docs, tokenizer).withColumn("crc", F.crc32("ids")).orderBy("start").collect()
    assert [(r.doc_id, r.start, r.n_tokens, r.crc) for r in got] == want
    assert rans.round_trip(no_docs, tokenizer).count() == 0


def test_rans_decoding_keeps_no_block(tmp_path):
    ids = np.arange(100_000, dtype=np.uint32) % 1000
    table = rans.Table.of_counts(np.bincount(ids))
    block = rans.encode_block([5, None, 7], [1, 49_999, 50_000], ids, table)
    (tmp_path / "table").write_bytes(table.to_bytes())
    (tmp_path / "one.rans").write_bytes(block)
    rows = pa.RecordBatch.from_pylist(
        [{"file": "one.rans", "at": 0, "size": len(block), "start": 10}] * 10, schema=rans.BLOCKS)
    decode = rans._decode(str(tmp_path))
    got = next(decode(iter([rows]))).to_pylist()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [(5, 10, 1), (None, 11, 49_999), (7, 50_010, 50_000)]
    assert b"".join(r["ids"] for r in got) == ids.astype("<u4").tobytes()
    del got
    tracemalloc.start()
    try:
        assert sum(batch.num_rows for batch in decode(iter([rows]))) == 30
        gc.collect()
        assert tracemalloc.get_traced_memory()[0] < 4 * len(ids)  # less than one block's ids
    finally:
        tracemalloc.stop()


def fewest(items, capacity):
    bins = []

    def fits(i, used):
        if i == len(items):
            return True
        for k in range(len(used)):
            if used[k] + items[i] <= capacity and used[k] not in used[:k]:
                used[k] += items[i]
                if fits(i + 1, used):
                    return True
                used[k] -= items[i]
        return False

    items = sorted(items, reverse=True)
    n = max(1, math.ceil(sum(items) / capacity)) if items else 0
    while items and not fits(0, [0] * n):
        n += 1
    return n


def test_dominance_keeps_the_optimum():
    random.seed(5)
    for _ in range(300):
        capacity = random.choice([10, 20, 31])
        items = [random.randint(1, capacity) for _ in range(random.randint(0, 8))]
        patterns = packing.pack_histogram(Counter(items), capacity)
        assert Counter(s for p, n in patterns for s in p for _ in range(n)) == Counter(items)
        assert all(sum(p) <= capacity for p, _ in patterns)
        left = Counter(items)
        fixed = packing.reduce_by_dominance(left, capacity)
        assert sum(n for _, n in fixed) + fewest(list(left.elements()), capacity) == fewest(items, capacity)


def check_packing(rows, capacity=1024):
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_sequence, by_doc


def test_packing_documents(odd_docs, real_docs, no_docs, tokenizer):
    rows = packing.pack_documents(real_docs, tokenizer).collect()
    sequences, docs = check_packing(rows)
    ids = dict(zip([r.doc_id for r in real_docs.collect()], plain_ids(tokenizer, [r.text for r in real_docs.collect()])))
    for key, parts in docs.items():
        whole, at = np.array(ids[key] + [2], "<u4"), 0
        for piece, (number, start, length) in enumerate(sorted(parts)):
            assert (number, start) == (piece, at) and (not piece or length == 1024)
            at += length
        assert at == len(whole)
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in rows}
    r = rows[0]
    assert crc[r.doc_id, r.piece] == zlib.crc32(np.array(ids[r.doc_id] + [2], "<u4")[r.start:r.start + r.length].tobytes())
    assert len(sequences) <= 1.02 * sum(r.length for r in rows) / 1024 + 1
    odd = packing.pack_documents(odd_docs.withColumn("piece", F.lit("clash")), tokenizer).collect()
    check_packing(odd)
    assert sum(r.doc_id == 8 for r in odd) == 2 and sum(r.doc_id == 3 and r.length == 1 for r in odd) == 1
    assert packing.pack_documents(no_docs, tokenizer).count() == 0


def test_warc_members_from_any_range():
    random.seed(6)
    data, places = b"", []
    for i in range(120):
        payload = os.urandom(random.randint(0, 3000)) if i % 2 else b"abc\x1f\x8b\x08" * random.randint(0, 300)
        places.append(len(data))
        data += warc.member(warc.record(i, f"http://x/{i}", payload, "d", None), level=0 if i % 3 else 6)
    source = pa.BufferReader(data)
    for split in (100, 999, 7777, 10 ** 9):
        got = []
        for start in range(0, len(data), split):
            class Source:
                size, read_at = source.size, staticmethod(source.read_at)
            got += [at for at, _ in warc.Members(Source, start, min(len(data), start + split))]
        assert got == places


def test_warc_round_trip(spark):
    big = "x" * 1500
    rows = [(1, "http://a\r\nb", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None),
            (None, "u", big), (7, "é", "ü" * 700), (6, "u", "ü" * 700), (7, "é", "ü" * 700)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    folder = work_folder(spark, "warc")
    got = warc.read(spark, warc.write(pages, folder, archive_bytes=400), folder, split_bytes=150).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got) == sorted([
        ("1", "revisit", 2, 1500), ("2", "response", None, 1500), ("3", "response", None, 5), ("4", "response", None, 5),
        ("5", "response", None, 0), ("None", "revisit", 2, 1500), ("7", "response", None, 1400),
        ("6", "revisit", 7, 1400), ("7", "response", None, 1400)])
    assert {bytes(r.payload) for r in got if r.page_id == 7} == {("ü" * 700).encode()}
    empty = work_folder(spark, "warc")
    assert warc.read(spark, warc.write(pages.limit(0), empty), empty).count() == 0


def brute_components(rows, part=80):
    sets = [near for near in (set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} if w else set()
                              for w in ((r.text or "").lower().split() for r in rows))]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i].doc_id == rows[j].doc_id or (sets[i] and sets[j] and
                                                    100 * len(sets[i] & sets[j]) >= part * len(sets[i] | sets[j])):
                group[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r.doc_id), r.doc_id)
    return [(r.doc_id, len(s), least[root(i)]) for i, (r, s) in enumerate(zip(rows, sets))]


def test_near_duplicates_match_brute_force(spark, real_docs):
    random.seed(7)
    base = [f"w{random.randint(0, 400)}" for _ in range(150)]
    rows = []
    for i in range(90):  # near copies of one text, many just above or below the limit
        words = list(base)
        for _ in range(random.randint(0, 14)):
            words[random.randrange(len(words))] = f"v{random.randint(0, 10 ** 6)}"
        rows.append((10_000 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(
        real_docs.filter("doc_id < 120").select("doc_id", "text"))
    want = brute_components(docs.collect())
    got = near_dup.near_duplicates(docs.withColumn("kept", F.lit("clash"))).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark, odd_docs, no_docs):
    got = near_dup.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count() and near_dup.near_duplicates(no_docs).count() == 0
    found = {r.doc_id: r.component_id for r in got}
    assert found[2] == 1 and found[3] == 3 and found[4] == 4 and found[5] == 5 and found[8] == 8 and found[None] is None
    both = spark.createDataFrame([(5, "a b c d e"), (5, "f g h i j"), (2, "A B C D E"), (9, "f g h i j")],
                                 "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(both).collect()} == {2}


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(8)
    for size in (1, 2, 7, 60, 3000):
        a = np.unique(rng.integers(0, 2 ** 63, size).astype(np.uint64))
        b = np.concatenate([a[: len(a) * 9 // 10], np.unique(rng.integers(0, 2 ** 63, len(a) // 10 + 1).astype(np.uint64))])
        one, two = near_dup.sketch(a), near_dup.sketch(b)
        assert near_dup.EMPTY not in one and (near_dup.sketch(a[::-1].copy()) == one).all()
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert size < 10 or abs((one == two).mean() - true) < 0.12


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 130), (130, 115), (7, 7)]
    got = near_dup.components(spark.createDataFrame(links, "one long, two long")).collect()
    assert {r.node: r.component for r in got} == {**{i: 0 for i in range(1, 61)}, 130: 100, 115: 100}


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450, 2) == [200.0, pytest.approx(500 / 3), pytest.approx(250 / 3)]
    assert mixing.targets([10, 0, 1000], [5, 2, 1], 1515, 2) == [20.0, 0.0, 1495.0]
    assert mixing.targets([], [], 0) == [] and mixing.targets([0], [5], 0) == [0.0]


def test_splitting_tree_is_exact():
    parts = mixing.split_tree(np.array([50, 0, 7, 300]), 8, np.random.default_rng(9))
    assert parts.sum(axis=0).tolist() == [50, 0, 7, 300] and set(parts.sum(axis=1)) <= {44, 45}
    seen = np.mean([mixing.split_tree(np.array([30, 10]), 4, np.random.default_rng(s))[2] for s in range(400)], axis=0)
    assert seen == pytest.approx([7.5, 2.5], abs=0.2)


def test_mixing(spark, real_docs, odd_docs, no_docs):
    recipe = mixing.Recipe(block_words=300, shard_words=20_000)
    got = mixing.assess(real_docs, recipe).join(real_docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    for _, own in got.groupby("source"):
        assert own["source_size"].iloc[0] == own["size"].sum()
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= own["size"].max()
    again = mixing.assess(real_docs, recipe).toPandas()
    assert dict(zip(again["doc_id"], again["taken"])) == dict(zip(got["doc_id"], got["taken"]))
    assert len({s for shards in got["shards"] for s in shards}) > 1
    clash = odd_docs.withColumn("taken", F.lit("clash"))
    mixed = mixing.mix(clash)
    assert mixed.columns == clash.columns and {r.taken for r in mixed.collect()} == {"clash"}
    odd = mixing.assess(odd_docs).collect()
    assert len(odd) == odd_docs.count() and sum(r["size"] for r in odd if r.doc_id == 3) == 0
    assert mixing.assess(no_docs).count() == 0 and mixing.mix(no_docs).count() == 0


def test_pipeline(spark, real_docs, tokenizer):
    docs, before = real_docs, real_docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, "").toPandas(), real_docs.schema)
        assert docs.columns == real_docs.columns, name
        if name == "near dedup":
            kept = sorted(r.doc_id for r in docs.collect())
            assert kept == sorted(five_word_components(sorted(previous)))
        assert name == "mixing" or docs.count() <= before
        previous, before = docs.select("doc_id", "text").collect(), docs.count()
    counts = Counter(r.doc_id for r in docs.collect())
    assert max(counts.values()) <= 2
    check_packing([r for r in corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()])


@pytest.mark.parametrize("name", ["op2_warc", "op4_minhash_near_dedup", "op9_quality_rules"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    from salesloom.llm.queries import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    found, want = QUERIES[name](spark, folder).toPandas(), con.execute(SQL[name]).df()
    key = found.columns[0]
    found = found.sort_values(key).reset_index(drop=True)
    want = want[list(found.columns)].sort_values(key).reset_index(drop=True)
    assert found.astype(object).where(found.notna(), None).values.tolist() == \
        want.astype(object).where(want.notna(), None).values.tolist()
