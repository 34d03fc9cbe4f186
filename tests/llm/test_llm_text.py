"""Quality rules, line templates, licences, fingerprints and passages."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesloom.llm import licences, passages, prefix_hash, quality, templates

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(words):
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered.update(range(i, i + 5))
    return len(covered)


def test_quality_figures_match_brute_force(spark, odd_docs):
    texts = ["a b c d e f a b c d e x", "x y. " * 30, "Home | About | Contact\nA real sentence stands here.\n" * 2,
             "one two three four five six seven eight nine ten eleven.", "we use cookies here and there and so on ok."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(
        odd_docs.filter("doc_id <> 6 OR doc_id IS NULL").select("doc_id", "text"))
    for r in quality.assess(docs).collect():
        text = r.text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeated(words), text
        assert r.base_failed == (len(words) < 10 or 100 * repeated(words) > 20 * len(words))


def test_quality_lines_and_verdict(spark):
    good = "A sentence of more than ten words stands here for the reader to see."
    rows = [(1, good + "\n" + good.upper()), (2, good + "\nread more"), (3, "navi | gation | bar | of words | more\n" * 3),
            (4, "no end of the line here although the words are plain and many of them")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = {r.doc_id: r for r in quality.assess(docs).collect()}
    assert got[1].kept and got[1].n_failed_lines == 0 and got[1].clean_text == rows[0][1]
    assert got[2].kept and got[2].clean_text == good
    assert not got[3].kept and not got[4].kept
    kept = quality.clean(docs).collect()
    assert {r.doc_id: r.text for r in kept} == {1: rows[0][1], 2: good} and kept[0].kept == "clash"


def test_quality_empty_table(no_docs):
    assert quality.assess(no_docs).count() == 0 and quality.clean(no_docs).columns == no_docs.columns


def test_quality_is_native(real_docs):
    plan = quality.clean(real_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_templates_drop_all_but_the_first(spark):
    rows = [(i, f"Body line number {'abcdefghijklmnop'[i]} is unlike others because of {i * 'z'} only.\n"
                f"Page {i} of 99 printed by the archive.") for i in range(14)]
    rows.append((50, "Body of its own.\n\nPage 7 of 99 printed by the archive."))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    tree = templates.Tree(least_docs=10)
    got = {r.doc_id: r for r in templates.assess(docs, tree).collect()}
    assert got[0].n_dropped == 0 and "Page 0" in got[0].clean_text
    assert all("Page" not in got[i].clean_text for i in [*range(1, 14), 50])
    assert got[50].clean_text == "Body of its own.\n" and got[50].n_lines == 3
    assert templates.assess(docs, templates.Tree(least_docs=16)).filter("n_dropped > 0").count() == 0


def test_templates_generalise_fields(spark):
    names = ["ann", "bob", "cid", "dan", "eve", "fay", "gus", "hal", "ida", "jan"]
    rows = [(i, f"sent to the reader {n} by our news office every day of the week") for i, n in enumerate(names)]
    got = templates.assess(spark.createDataFrame(rows, "doc_id long, text string"), templates.Tree(least_docs=5))
    assert got.filter("n_dropped = 1").count() == 9


def test_templates_odd_rows(odd_docs, no_docs):
    got = templates.assess(odd_docs, templates.Tree(least_docs=2)).select("doc_id", "text", "n_dropped", "clean_text")
    rows = got.collect()
    assert len(rows) == odd_docs.count() and templates.assess(no_docs).count() == 0
    assert all(r.clean_text == (r.text or "") for r in rows if r.doc_id in (1, 3, 4, 5, 6, 7))
    assert [r.clean_text for r in rows if r.doc_id == 2] == [""]
    left = templates.clean(odd_docs, templates.Tree(least_docs=2))
    assert left.columns == odd_docs.columns and left.filter("doc_id = 2").count() == 0


def test_automaton_statistics_match_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(60):
        sequences = [rng.integers(0, 3, rng.integers(1, 9)).tolist() for _ in range(3)]
        words = rng.integers(0, 4, 25).tolist()
        parts = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        automaton = licences.Automaton(sequences)
        for i, (state, length) in enumerate(automaton.statistics(words)):
            assert length == max([n for n in range(i + 2) if tuple(words[i + 1 - n:i + 1]) in parts], default=0)
            ends = {(k, j) for k, s in enumerate(sequences) for j in range(length, len(s) + 1)
                    if length and s[j - length:j] == words[i + 1 - length:i + 1]}
            assert set(automaton.ends[state]) == ends or not length


def test_licence_labels(spark, odd_docs, no_docs):
    rows = [(1, "Foo. Licensed under CC BY-NC 4.0. All Rights, reserved"), (2, "the GNU General-Public License v3"),
            (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing and "
                "associated documentation files"), (4, "rights reserved for all"), (5, None)]
    got = {r.doc_id: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].base_labels, got[1].labels) == ("cc-by,reserved", "cc-by,cc-by-nc,reserved")
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].score) == (2, 3, 8, 1.0)
    assert got[2].labels == "gpl" and got[3].labels == "mit" and 0.6 <= got[3].score < 1
    assert got[4].labels == "" and got[4].n_base == 0
    assert (got[5].n_words, got[5].first_word, got[5].score) == (0, None, 0.0)
    assert licences.scan(odd_docs).count() == odd_docs.count() and licences.scan(no_docs).count() == 0


def test_prefix_hashes():
    rng = np.random.default_rng(2)
    text = "".join(rng.choice(list("abé🙂"), 300))
    p, q = prefix_hash.Prefixes(text), prefix_hash.Prefixes("zz" + text[40:] + "!")
    for _ in range(200):
        i, j, n = rng.integers(0, 250, 3)
        n = int(n) % 50
        assert (p.span(i, n) == p.span(j, n)) == (text[i:i + n] == text[j:j + n])
    assert p.common_extension(40, q, 2) == 260 and p.common_extension(0, q, 0) == 0


def test_fingerprints_follow_the_next_document(spark, odd_docs, no_docs):
    rows = sorted(odd_docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    texts = [r.text or "" for r in rows]
    want = []
    for i, text in enumerate(texts):
        follow, quarter = texts[(i + 1) % len(texts)], len(text) // 4
        changed = text[:len(text) - quarter] + follow[:quarter]
        want.append((rows[i].doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    got = prefix_hash.fingerprints(odd_docs).collect()
    key = lambda t: (t[0] is not None, t[0] or 0, *t[1:])
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=key) == sorted(want, key=key)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].fingerprint == by_id[2].fingerprint != by_id[6].fingerprint and by_id[1].near_next == 1.0
    assert 0.6 < by_id[6].near_edited <= 1 and all(0 <= r.near_edited <= 1 for r in got)
    assert prefix_hash.fingerprints(no_docs).count() == 0
    single = prefix_hash.fingerprints(odd_docs.filter("doc_id = 1")).first()
    assert single.near_next == 1.0


def test_passage_gradients_are_right():
    rng = np.random.default_rng(3)
    how = passages.Training(steps=0)
    x, owners = rng.normal(size=(9, passages.N_FEATURES)), np.array([0, 0, 1, 2, 2, 2, 2, 3, 3])
    y = np.array([1.0, 0, 1, 0])
    model = passages.fit(x, owners, y, how)
    heads = np.flatnonzero(np.diff(owners, prepend=-1))

    def loss(w):
        p = passages.forward(w, x, heads)["p"]
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    f = passages.forward(model.weights, x, heads)
    found = passages.gradients(model.weights, x, heads, f["p"] - y, f)
    for name in ("encode", "v", "u", "w", "out"):
        w = {k: v.copy() for k, v in model.weights.items()}
        at = tuple(0 for _ in w[name].shape)
        w[name][at] += 1e-5
        up = loss(w)
        w[name][at] -= 2e-5
        assert found[name][at] == pytest.approx((up - loss(w)) / 2e-5, rel=1e-3, abs=1e-7)


def test_passage_quality_held_out(spark, real_docs, odd_docs, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = passages.score(docs, labels).join(labels, "doc_id").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(d).encode()) % 5 == 0 for d in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert (held["predicted"] == held["quality"]).mean() > 0.9
    odd = passages.score(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert {r.score for r in passages.score(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert passages.score(no_docs, labels).count() == 0
