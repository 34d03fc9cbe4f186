"""SimHash near duplicates, hard negatives and phrase mining against plain versions."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salesloom.llm import collocations, hard_negatives, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """Least doc_id by doc_id for rows (doc_id, fingerprint), by flooding."""
    near = {a: [b for b in rows if (rows[a] ^ rows[b]).bit_count() <= 3] for a in rows}
    out = {}
    for start in sorted(rows):
        waiting = [] if start in out else [start]
        while waiting:
            now = waiting.pop()
            if now not in out:
                out[now] = start
                waiting += near[now]
    return out


def test_golay_spheres_and_keys():
    assert np.bincount(simhash.codeword_index(np.arange(1 << 16) << 7 | 5), minlength=4096).sum() == 1 << 16
    assert len(np.unique(simhash.CORRECTIONS)) == 2048
    rng = np.random.default_rng(7)
    one = rng.integers(0, 1 << 64, 3000, dtype=np.uint64)
    two = one.copy()
    for i in range(len(two)):
        for b in rng.choice(64, i % 4, replace=False).tolist():
            two[i] ^= np.uint64(1 << b)
    keys = [set(zip(*(c.tolist() for c in simhash.bucket_keys(v)))) for v in (one, two)]
    assert {r for r, _ in keys[0] & keys[1]} == set(range(3000))


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_simhash_equals_plain_version(spark, real_docs, block):
    rows = {r.doc_id: plain_fingerprint(r.text) for r in real_docs.collect()}
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id)
           for r in simhash.near_duplicates(real_docs, block).collect()}
    assert {k: v[0] for k, v in got.items()} == rows
    want = plain_components(rows)
    assert {k: v[1] for k, v in got.items()} == want
    assert len(set(want.values())) < len(rows)


def test_simhash_links_of_crowded_buckets(spark):
    """Fingerprints that share two whole segments: one bucket, many blocks, chains of links."""
    rng = random.Random(5)
    bits = sorted({sum(1 << rng.randrange(21) for _ in range(rng.randrange(6))) | 1 << 62 for _ in range(700)})
    df = spark.createDataFrame([(b,) for b in bits], "bits long")
    for block in (simhash.BLOCK, 50):
        links = [(r.one, r.two) for r in simhash.similar_links(df, block).collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in links)
        root = {b: b for b in bits}

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            root[max(top(a), top(b))] = min(top(a), top(b))
        assert {b: top(b) for b in bits} == plain_components({b: b for b in bits})


def test_simhash_odd_rows(spark, odd_docs, no_docs, monkeypatch):
    clash = odd_docs.withColumn("bits", F.lit("x")).withColumn("component_id", F.lit("y"))
    got = [tuple(r) for r in simhash.near_duplicates(clash).orderBy("doc_id").collect()]
    by_id = {r[0]: r for r in got}
    assert len(got) == odd_docs.count() and by_id[1][1] == by_id[2][1] and by_id[2][2] == 1
    assert [by_id[i][1:] for i in (3, 4, 5)] == [("0" * 16, 3)] * 3
    assert sorted(r[1:] for r in got if r[0] == 8) == [by_id[8][1:]] * 2
    assert simhash.near_duplicates(no_docs).count() == 0
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for chunk in (1 << 20, 16):
        monkeypatch.setattr(simhash, "CHUNK", chunk)
        assert all(simhash.fingerprint(t) == plain_fingerprint(t) for t in texts.values())


def test_simhash_same_id_and_null_id(spark):
    rows = [(1, "a b c d"), (5, "a b c d"), (5, "x y z"), (7, "x y z"), (None, "x y z"), (None, "no id here at all")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in got) == [(0, 0), (0, 1), (1, 1), (5, 1), (5, 1), (7, 1)]


# ---------------------------------------------------------------- hard negatives

def plain_negatives(rows, m=hard_negatives.Mining()):
    clean = {}
    for i, v, label in sorted((r for r in rows if None not in r), key=lambda r: r[0]):
        if all(x is not None and np.isfinite(x) for x in v):
            own = ((label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(x))) for x in v])
            clean[i] = min(own, clean.get(i, own))
    out = []
    for a, (label, v) in clean.items():
        if a % m.every:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in clean.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if clean[i][0] == label][:m.positives]:
            hard = [i for i in order if clean[i][0] != label
                    and m.least * score[p] <= 100 * score[i] <= m.most * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(hard[:m.negatives])]
    return sorted(out)


DDL = "vec_id long, embedding array<float>, label int"


def test_bounds_hold():
    rng = np.random.default_rng(3)
    for width in (1, 3, 17, 64):
        one, two = (hard_negatives.Vectors(list(rng.integers(-90, 90, (50, width)) * scale), width) for scale in (1, 1000))
        exact = one.exact @ two.exact.T
        assert (hard_negatives.scores(one, two, None) == exact).all()
        for level in range(len(hard_negatives.LEVELS)):
            low, high = hard_negatives.bounds(one, two, level, None)
            assert (low <= exact).all() and (exact <= high).all()
            r, c = np.nonzero(exact > 0)
            some = hard_negatives.bounds(one, two, level, (r, c))
            assert np.allclose(some[0], low[r, c]) and np.allclose(some[1], high[r, c])


@pytest.mark.parametrize("small", [False, True])
def test_hard_negatives_equal_plain_version(spark, small):
    rng = random.Random(11)
    rows = []
    for i in range(700):
        width = 6 if i % 13 else rng.randrange(9)
        vector = [float(np.float32(rng.choice([0.0, 0.5, rng.gauss(0, 1)]))) for _ in range(width)]
        rows.append((i, [1.0] * 6 if i % 3 == 0 else vector, rng.randrange(4)))
    rows += [(None, [1.0], 1), (701, None, 1), (702, [1.0], None), (703, [float("nan")], 1), (704, [float("inf")], 1),
             (705, [None, 1.0], 1), (50, [2.0, 3.0], 1), (50, [2.0, 3.0], 1), (10, [9.0, 9.0], 2)]
    mining = hard_negatives.Mining(block=64, anchor_block=3) if small else hard_negatives.Mining()
    df = spark.createDataFrame(rows, DDL).withColumns({"score": F.lit(1), "window": F.lit(2), "role": F.lit("x")})
    got = sorted(tuple(r) for r in hard_negatives.mine(df, mining).collect())
    assert got == plain_negatives(rows) and got


def test_hard_negatives_empty_and_one_label(spark):
    assert hard_negatives.mine(spark.createDataFrame([], DDL)).count() == 0
    rows = [(i, [float(i)], 3) for i in (1, 2, 50, 100)]
    assert hard_negatives.mine(spark.createDataFrame(rows, DDL)).count() == 0


# ---------------------------------------------------------------- collocations

def plain_phrases(rows, rules):
    counts, pieces, sizes = {}, {}, {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            sizes[lang] = sizes.get(lang, 0) + len(words)
            own = counts.setdefault(lang, {})
            for k in range(1, rules.longest + 1):
                for i in range(len(words) - k + 1):
                    key = tuple(words[i:i + k])
                    own[key] = own.get(key, 0) + 1
    out = []
    for lang, own in counts.items():
        frequent = {p: a for p, a in own.items() if len(p) > 1 and a >= rules.least}
        held = {q[i:j] for q, a in frequent.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1)
                if j - i < len(q) and 100 * a >= 100 * own[q[i:j]]}
        found = []
        for p, a in frequent.items():
            if p not in held:
                score, cut = min((1000 * a * sizes[lang] // (own[p[:j]] * own[p[j:]]), j) for j in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:cut]], own[p[cut:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, sizes[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:rules.top])]
    return sorted(out)


def texts_with_phrases(n):
    rng = random.Random(8)
    common = [f"w{i}" for i in range(30)]
    fixed = ["alpha beta gamma delta epsilon", "Red Rose.", "new york city", "new york", "é ü", "of the of the of the"]
    rows = []
    for i in range(n):
        words = rng.choices(common, [1 / (k + 1) for k in range(30)], k=rng.randrange(40))
        for _ in range(rng.randrange(6)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(fixed))
        rows.append((["en", "de", None, ""][i % 4 if i % 3 else 0], rng.choice([" ", "  ", "\t", " , "]).join(words)))
    return rows + [("en", None), (None, None), ("fr", ""), ("fr", " .,\n"), ("fr", "x" * 300_000), ("fr", "a b " * 40_000)]


@pytest.mark.parametrize("top", [5, 2000])
def test_collocations_equal_plain_version(spark, top):
    rows = texts_with_phrases(400)
    rules = collocations.Rules(least=8, top=top)
    df = spark.createDataFrame(rows, "lang string, text string").withColumns(
        {"n": F.lit(1), "words": F.lit("x"), "word": F.lit(2)}).repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(df, rules).collect())
    assert got == plain_phrases(rows, rules)
    assert top > 100 or any(r[1] == top for r in got)


def test_bounds_spare_frequent_words(spark, monkeypatch):
    """Words whose bound does not reach the last place are never grown, and the result is the same."""
    rows = [r for r in texts_with_phrases(400) if r[0] == "en"]
    rules = collocations.Rules(least=8, top=3, shares=(2, 1))
    seen = []
    grown = collocations._grown
    monkeypatch.setattr(collocations, "_grown", lambda corpus, first, rules: (
        seen.append(first.agg(F.sum("l1")).first()[0]), grown(corpus, first, rules))[1])
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.mine(df, rules).collect())
    assert got == plain_phrases(rows, rules)
    assert sum(seen) < 0.75 * plain_phrases(rows, rules)[0][6]


def test_collocations_combine_in_small_portions(spark, monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 200)
    rows = texts_with_phrases(60)
    rules = collocations.Rules(least=3)
    corpus_rows = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.mine(corpus_rows, rules).collect()) == plain_phrases(rows, rules)


def test_words_of_equal_hashes_are_told_apart(spark, monkeypatch):
    """A hash by which frequent words are one is found out by a second hash, and another one is drawn."""
    import pyarrow as pa

    words = collocations._words
    poor = lambda data, bounds, stream: [np.minimum(c, np.uint64(5)) if i == 2 and stream == 11 else c
                                         for i, c in enumerate(words(data, bounds, stream))]
    monkeypatch.setattr(collocations, "_words", poor)
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array(["a b c a"])], names=["lang", "text"])
    counted = [r for b in collocations._count_words(11)(iter([batch])) for r in b.to_pylist()]
    assert {r["hash"] for r in counted} == {5} and sorted(r["n"] for r in counted) == [1, 1, 2]
    assert len({r["second"] for r in counted}) == 3
    monkeypatch.undo()
    count, seen = collocations._count_words, []

    def first_is_poor(stream):
        seen.append(stream)
        inner = count(stream)

        def run(batches):
            for b in inner(batches):
                yield b if stream > 11 else b.set_column(1, "hash", pa.array(np.full(b.num_rows, 5)))
        return run

    monkeypatch.setattr(collocations, "_count_words", first_is_poor)
    rows = [r for r in texts_with_phrases(100) if r[0] == "en"]
    rules = collocations.Rules(least=8)
    got = sorted(tuple(r) for r in collocations.mine(spark.createDataFrame(rows, "lang string, text string"), rules).collect())
    assert got == plain_phrases(rows, rules) and seen == [11, 13]


def test_scores_pass_64_bits(spark):
    big = spark.createDataFrame([(10 ** 14, 10 ** 17, 3 * 10 ** 14, 7 * 10 ** 14)], "a long, n long, l long, r long")
    got = big.select(collocations._score(*(F.col(c) for c in "anlr"))).first()[0]
    assert got == 1000 * 10 ** 14 * 10 ** 17 // (21 * 10 ** 28)


def test_collocations_without_phrases(spark, no_docs, odd_docs):
    assert collocations.mine(no_docs).count() == 0
    assert collocations.mine(odd_docs).schema == collocations.mine(no_docs).schema


@pytest.mark.parametrize("name", ["op11_collocations", "op12_hard_negatives"])
def test_queries_match_their_sql(spark, name):
    import duckdb

    from salesloom.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    found, want = QUERIES[name](spark, "/root/testdata/sf0.001"), con.execute(SQL[name])
    assert found.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, found.collect())) == sorted(want.fetchall())
