"""Keyed merges against a plain replay of the changes in their order."""

import hashlib
import random

import pytest

from salesloom.operators.merge import merge_keyed

BASE = "id long, sku string, barcode string, price long, note string"
CHANGE = "seq long, sku string, barcode string, price long, note string"


def made(kind, key):
    return hashlib.md5(f"{kind}:{key}".encode()).hexdigest()[:24]


def replay(base, changes):
    """One change after the other: by sku, else by barcode, else a new row; set fields overwrite."""
    rows = [{**dict(zip(("id", "sku", "barcode", "price", "note"), r)), "id": str(r[0]), "action": "unchanged"} for r in base]
    rows.sort(key=lambda r: r["id"])
    for seq, *values in sorted(changes, key=lambda c: (c[0], c[1] is None)):
        new = {k: v for k, v in zip(("sku", "barcode", "price", "note"), values) if v is not None}
        key = "sku" if "sku" in new else "barcode" if "barcode" in new else None
        found = next((r for r in rows if key and r[key] == new[key]), None)
        if found is None:
            found = {"id": made(key or "row", new[key] if key else seq), "sku": None, "barcode": None, "price": None,
                     "note": None, "action": "created"}
            rows.append(found)
        elif found["action"] == "unchanged":
            found["action"] = "updated"
        found.update(new)
    return sorted((tuple(r[c] for c in ("id", "sku", "barcode", "price", "note", "action")) for r in rows), key=str)


def merged(spark, base, changes):
    out = merge_keyed(spark.createDataFrame(base, BASE), spark.createDataFrame(changes, CHANGE), "id", ["sku", "barcode"])
    return sorted((tuple(r) for r in out.select("id", "sku", "barcode", "price", "note", "action").collect()), key=str)


def test_barcode_before_the_row_that_takes_it(spark):
    """The first change cannot find the row that the second one makes."""
    changes = [(1, None, "B7", 5, None), (2, "S7", "B7", 6, None), (3, None, "B7", None, "x")]
    got = merged(spark, [], changes)
    assert got == replay([], changes) and len(got) == 2
    assert {r[5] for r in got} == {"created"} and (made("barcode", "B7"), None, "B7", 5, "x", "created") in got


def test_barcode_that_moves_to_another_row(spark):
    base = [(1, "S1", "B1", 1, None), (2, "S2", "B2", 2, None)]
    changes = [(1, None, "B1", 10, None), (2, "S1", "B9", None, None), (3, None, "B1", 11, None), (4, "S2", "B1", None, None),
               (5, None, "B1", 12, "late"), (6, None, "B2", 13, None), (7, "S1", "B1", None, "back"), (8, None, "B1", 14, None)]
    assert merged(spark, base, changes) == replay(base, changes)


@pytest.mark.parametrize("seed", range(4))
def test_random_changes_equal_the_replay(spark, seed):
    rng = random.Random(seed)
    pick = lambda prefix, n, none: None if rng.random() < none else f"{prefix}{rng.randrange(n)}"
    base = [(i, pick("S", 40, 0.2), pick("B", 25, 0.3), i, None) for i in rng.sample(range(10, 99), 30)]
    changes = [(seq, pick("S", 40, 0.5), pick("B", 25, 0.2), rng.choice([None, seq]), rng.choice([None, f"n{seq}"]))
               for seq in rng.sample(range(1000), 300)]
    assert merged(spark, base, changes) == replay(base, changes)


def test_hot_barcode_and_empty_sides(spark):
    changes = [(i, None, "B", i, None) for i in range(500)] + [(600, "S", "B", 1, None)]
    assert merged(spark, [], changes) == replay([], changes)
    assert merged(spark, [(1, "S", "B", 1, None)], []) == [("1", "S", "B", 1, None, "unchanged")]
    assert merged(spark, [], []) == []
