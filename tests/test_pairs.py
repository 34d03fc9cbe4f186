"""Items joined with their sales inside the batches: every item once, replays, late rows, and what is stored."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import functions as F

from salesloom import session
from salesloom.catalog.bindings import Tables
from salesloom.catalog.streams import closed_inputs
from salesloom.streaming import kept, pairs, runner, windowed

ITEMS = "saleId long, productId long, quantity int, price double, companyId string, saleTime timestamp"
SALES = "saleId long, saleTime timestamp, companyId string, saleStatus string"
START = dt.datetime(2024, 1, 1)


def at(minute):
    return None if minute is None else START + dt.timedelta(minutes=minute)


def joined(spark, root, n, items, sales, **how):
    """(saleId, productId, headCompany) of the rows that batch n gives out."""
    lines = spark.createDataFrame([(s, p, 1, 1.0, "own", at(t)) for s, p, t in items], ITEMS)
    heads = spark.createDataFrame([(s, at(t), c, "completed") for s, c, t in sales], SALES)
    out = pairs.items_with_company(pairs.items_and_sales(lines, heads), n, root, "2 minutes", "5 minutes", **how)
    return Counter((r.saleId, r.productId, r.headCompany) for r in out.collect())


def test_the_join_of_batches_equals_the_join_of_all_rows(spark):
    """Null ids, times and companies and sales that come twice included; rows arrive up to four minutes late."""
    rng, root = random.Random(5), session.work_folder(spark, "pairs")
    sales = [(s, rng.choice(["a", "b", None]), rng.randrange(40)) for s in range(40) if s % 4]
    sales += [sales[3], (5, "a", None), (None, "a", 7)]
    times = {s: t for s, _, t in sales if t is not None}
    items = [(s, p, times.get(s, 20) + rng.choice([-3, -2, 0, 0, 1, 2, 3])) for s in range(40) for p in range(3)]
    items += [items[0], (None, 1, 7), (7, 9, None)]
    last = [(-1, 0, 99)], [(-1, None, 99)]

    def batch_of(rows):
        return [(0 if r[2] is None else min(r[2] + rng.randrange(5), 43) // 11, r) for r in rows]

    dealt = batch_of(items), batch_of(sales)
    got = Counter()
    for n in range(4):
        mine = [[r for k, r in side if k == n] for side in dealt]
        first = joined(spark, root, n, *mine)
        assert joined(spark, root, n, *mine) == first  # a replay
        got += first
    got += joined(spark, root, 4, *last)

    want = Counter()
    for s, p, t in items:
        heads = [c for h, c, u in sales if h == s is not None and t is not None and u is not None and abs(t - u) <= 2]
        for c in heads or ([None] if t is not None else []):
            want[s, p, c] += 1
    want[-1, 0, None] += 1  # the last item meets its sale
    assert got == want


def test_rows_come_out_as_soon_as_they_are_settled(spark):
    root = session.work_folder(spark, "pairs")
    assert not joined(spark, root, -1, [], [])
    assert not joined(spark, root, 0, [(1, 1, 0), (2, 1, 0)], [])  # no sale yet: nothing has passed
    assert joined(spark, root, 1, [], [(1, "a", 1), (9, "a", 6)]) == {(1, 1, "a"): 1}
    assert joined(spark, root, 2, [(8, 1, 7)], [(9, "a", 7)]) == {(2, 1, None): 1}  # passed: 7 - 5, so 0 + 2 is settled
    assert not joined(spark, root, 3, [(3, 1, 2)], [(8, "b", 1)])  # both too late
    assert joined(spark, root, 4, [(4, 1, 3)], [(8, "b", 8), (4, "c", 4)]) == {(8, 1, "b"): 1, (4, 1, "c"): 1}
    assert len(kept.finished(spark, f"{root}/recent")) == kept.GENERATIONS


def test_hot_sales_give_the_same_rows(spark):
    rows = [(s % 3, p, p % 4) for s in range(6) for p in range(20)], [(0, "a", 1), (1, "b", 1), (7, "c", 30)]
    hot = spark.createDataFrame([(0,)], "saleId long")
    got = [joined(spark, session.work_folder(spark, "pairs"), 0, *rows, **how) for how in ({}, {"hot": hot})]
    assert got[0] == got[1] and got[0]


def test_a_long_batch_leaves_only_recent_rows(spark):
    """A stream join would hold every row of the batch in its state."""
    b = Tables(spark, "/root/testdata/sf0.001")
    root = session.work_folder(spark, "pairs")
    stream, = runner.start_kept(closed_inputs(b), root, True, ["items"], watermark="2 hours", parts=2)
    stream.awaitTermination()
    assert not any(p["stateOperators"] for p in stream.recentProgress)
    stored = spark.read.parquet(f"{root}/recent/gen={max(kept.finished(spark, f'{root}/recent'))}")
    assert stored.count() == 2  # the last sale and the last item
    assert stored.filter(F.coalesce(F.col("item")["saleTime"], F.col("sale")["saleTime"]) < "2099-01-01").count() == 0
    whole = windowed.join_items_sales(b.ev_items, b.ev_sales, how="left")
    revenue = whole.filter("headCompany IS NOT NULL AND brand <> ''").agg(F.sum("subtotal")).first()[0]
    table = runner.result_tables(spark, root, b.products, b.employees)["market_top_brands"]()
    assert table.agg(F.sum("totalRevenue")).first()[0] == revenue
