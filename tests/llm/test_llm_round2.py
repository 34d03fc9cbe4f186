"""Rules of the corpus stages that the other tests do not reach."""

import random

import corpus_pipeline
from salesloom.llm import templates


def five_word_components(rows):
    """Least doc_id of each group of near copies: five-word shingles, 80 per cent of the union, every pair compared."""
    sets = []
    for r in rows:
        words = (r.text or "").lower().split()
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group[max(root(i), root(j))] = min(root(i), root(j))
    return {rows[root(i)].doc_id for i in range(len(rows))}


def test_near_dedup_stage_takes_five_words(spark):
    random.seed(5)
    rows = []
    for i in range(80):  # pairs; up to a twelfth of the words of the second are edited
        words = [f"w{random.randint(0, 10 ** 6)}" for _ in range(120)]
        rows.append((2 * i, " ".join(words)))
        for at in random.sample(range(120), i % 11):
            words[at] = f"v{random.randint(0, 10 ** 6)}"
        rows.append((2 * i + 1, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(4)
    want = five_word_components(sorted(docs.collect()))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert kept == want and 80 < len(want) < 160


def test_lines_that_two_documents_share_go(spark):
    names = "ann bob cid dan eve fay".split()
    shared = "this passage stands in two documents " + " ".join(f"{'abcdefgh'[i % 8]}{'xyzw' [i % 4]}" for i in range(60))
    rows = [(i, f"{n} tells a tale that no one else has told\nsee {n}\ntable 3 of 7") for i, n in enumerate(names)]
    rows += [(10, f"opening of ten\n{shared}"), (11, f"{shared.upper()}\nend of eleven"),
             (12, f"only here and here again\nonly here and here again\n{shared} 5"), (13, f"{shared} 5"), (14, f"{shared} 6")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.clean_text for r in templates.assess(docs).collect()}
    want = dict(rows)
    # the first copy stays, whatever its case; short lines of numbers and lines of a single document stay
    want.update({11: "end of eleven", 13: ""})
    assert got == want


def test_templates_with_single_variable_words(spark):
    # 16 tokens, one variable word in each of four eighths: 12 are constant
    rows = [(i, "dear reader your {0}a and the {0}b were sent by {0}c to our {0}d in good time".format("abcdefghijkl"[i]))
            for i in range(12)]
    long = "we thank you for " + " ".join(f"{'abcdefgh'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)).replace("e", "{0}")
    rows += [(20 + i, long.format("ijklmnopqrst"[i])) for i in range(12)]
    rows += [(40 + i, "too few words of this {0}a {0}b {0}c {0}d".format("abcdefghijkl"[i] * 3)) for i in range(12)]
    got = {r.doc_id: r.n_dropped for r in templates.assess(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: int(i not in (0, 20) and i < 40) for i, _ in rows}
