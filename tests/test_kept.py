"""Kept tables: merging, replays, failed attempts, removal of old generations, exact money and sketches."""

import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from salesloom import session
from salesloom.streaming import changes, kept, runner

TABLE = kept.Kept("t", ["k", "s"], ["money"], ["n"], ["high"], ["name"])
DELTA = "k long, s string, money decimal(28,4), n long, high long, name string"


def delta(spark, *rows):
    return spark.createDataFrame([(k, s, Decimal(m), n, h, t) for k, s, m, n, h, t in rows], DELTA)


def rows_of(spark, root, table=TABLE, **how):
    return sorted(tuple(r) for r in kept.read(spark, root, table, **how).drop("updatedAt").collect())


def test_empty_before_the_first_batch(spark):
    root = session.work_folder(spark, "kept")
    kept.merge(delta(spark), -1, root, TABLE)
    empty = kept.read(spark, root, TABLE)
    assert empty.count() == 0 and empty.columns[:6] == TABLE.columns and "updatedAt" in empty.columns


def test_merging_equals_adding_up(spark):
    """Null keys, texts and measures included; every batch touches some parts only."""
    rng, root = random.Random(2), session.work_folder(spark, "kept")
    sums = defaultdict(lambda: [Decimal(0), 0, -1, "z"])
    for batch in range(6):
        rows = {(rng.choice([None, *range(12)]), rng.choice("ab")): None for _ in range(4)}
        change = [(k, s, f"{rng.randrange(10 ** 6)}.{rng.randrange(10 ** 4):04}", rng.randrange(9), rng.randrange(99),
                   rng.choice("pqr")) for k, s in rows]
        changed = kept.merge(delta(spark, *change), batch, root, TABLE, 4)
        assert sorted(map(str, changed.select("k", "s").collect())) == sorted(f"Row(k={k}, s='{s}')" for k, s in rows)
        for k, s, m, n, h, t in change:
            own = sums[k, s]
            sums[k, s] = [own[0] + Decimal(m), own[1] + n, max(own[2], h), min(own[3], t)]
    got = {(r.k, r.s): [r.money, r.n, r.high, r.name] for r in kept.read(spark, root, TABLE).collect()}
    assert got == sums


def test_replay_changes_nothing(spark):
    root = session.work_folder(spark, "kept")
    kept.merge(delta(spark, (1, "a", "1.5", 1, 3, "x"), (2, "a", "2", 1, 1, "y")), 0, root, TABLE, 4)
    for _ in range(3):
        kept.merge(delta(spark, (1, "a", "0.25", 2, 2, "w")), 1, root, TABLE, 4)
        assert [r[:6] for r in rows_of(spark, root)] == [
            (1, "a", Decimal("1.7500"), 3, 3, "w"), (2, "a", Decimal("2.0000"), 1, 1, "y")]
    stamps = {r.k: (r.first_batch, r.batch_id, r.window) for r in kept.read(spark, root, TABLE).collect()}
    assert stamps == {1: (0, 1, "batch_1"), 2: (0, 0, "batch_0")}


def test_unfinished_attempt_is_not_read(spark):
    root = session.work_folder(spark, "kept")
    kept.merge(delta(spark, (1, "a", "1", 1, 3, "x")), 0, root, TABLE, 1)
    before = rows_of(spark, root)
    # what a writer leaves that ends before its marker: a part of batch 1 without _SUCCESS
    spark.read.parquet(f"{root}/t/gen=0/part=0").write.parquet(f"{root}/t/gen=1/part=0")
    assert rows_of(spark, root) == before
    kept.merge(delta(spark, (1, "a", "1", 1, 5, "x")), 1, root, TABLE, 1)
    assert rows_of(spark, root)[0][2:5] == (Decimal("2.0000"), 2, 5)


def test_old_generations_are_removed_while_a_reader_is_open(spark):
    root, parts = session.work_folder(spark, "kept"), 2
    for batch in range(40):
        if batch == 38:
            reader = kept.read(spark, root, TABLE)  # resolved now, read after the next batch
        kept.merge(delta(spark, (batch % 3, "a", "1", 1, batch, "x")), batch, root, TABLE, parts)
        assert len(kept.generations(spark, root, TABLE)) <= parts * kept.GENERATIONS
        if batch == 38:
            assert reader.agg(F.sum("n")).first()[0] == 38
    assert kept.read(spark, root, TABLE).agg(F.sum("n")).first()[0] == 40
    assert sum(len(p) for p in kept.generations(spark, root, TABLE).values()) <= parts * kept.GENERATIONS


def test_money_is_exact_and_too_large_a_sum_fails(spark):
    root = session.work_folder(spark, "kept")
    kept.merge(delta(spark, (1, "a", "1234567890123.4567", 1, 1, "x")), 0, root, TABLE, 1)
    for batch in (1, 2):
        kept.merge(delta(spark, (1, "a", "0.0001", 1, 1, "x")), batch, root, TABLE, 1)
    assert kept.read(spark, root, TABLE).first().money == Decimal("1234567890123.4569")
    largest = "9" * 24 + ".9999"
    kept.merge(delta(spark, (2, "a", largest, 1, 1, "x")), 3, root, TABLE, 1)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC_OVERFLOW"):
        kept.merge(delta(spark, (2, "a", "0.0001", 1, 1, "x")), 4, root, TABLE, 1)


SALES = "saleId long, totalAmount double, companyId string, sector string, region string, saleStatus string, employeeId long"


def test_market_rows_follow_from_company_changes(spark):
    """A company counts once however often it sells or a batch is replayed; its money passes all tables unrounded."""
    root = session.work_folder(spark, "kept")

    def batch(n, *rows):
        sales = [(i, a, c, "s", "r", "completed", e) for i, (a, c, e) in enumerate(rows)]
        changes.keep_sales(spark.createDataFrame(sales, SALES), n, root, 2)

    batch(0, (1234567890123.0, "c1", 1), (0.4567, "c1", 2), (None, "c2", 3))
    for _ in range(2):
        batch(1, (1.5, "c1", 1), (2.5, "c3", None), (7.0, None, 9))
    batch(2)
    got = runner.result_tables(spark, root)
    row = got["market_analytics"]().first()
    assert (row.totalCompanies, row.marketSalesCount, row.marketRevenue) == (3, 5, 1234567890127.4567)
    assert got["sales_by_region"]().first().revenue == 1234567890134.4567
    assert {r.companyId: r.salesCount for r in got["company_analytics"]().collect()} == {"c1": 3, "c2": 1, "c3": 1}
    people = got["market_employee_performance"]().first()
    assert (people.totalEmployees, people.totalSales) == (3, 4)


def test_sketches_of_many_batches_stay_close(spark):
    table = kept.Kept("d", ["k"], sketches=["ids"])
    root, seen = session.work_folder(spark, "kept"), {0: set(), 1: set()}
    for batch in range(5):
        ids = spark.range(batch * 3000, batch * 3000 + 9000).select((F.col("id") % 2).alias("k"), "id")
        seen = {k: v | {i for i in range(batch * 3000, batch * 3000 + 9000) if i % 2 == k} for k, v in seen.items()}
        kept.merge(ids.groupBy("k").agg(F.hll_sketch_agg("id").alias("ids")), batch, root, table, 2)
    for r in kept.read(spark, root, table).select("k", F.hll_sketch_estimate("ids").alias("n")).collect():
        assert abs(r.n - len(seen[r.k])) <= 0.05 * len(seen[r.k])
