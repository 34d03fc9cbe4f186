"""The ingest flow in one pass, and listings that go on after a row."""

import json

import pytest
from pyspark.sql import functions as F

from salesloom import session
from salesloom.catalog.bindings import Tables
from salesloom.catalog.foundation import AT, flawed
from salesloom.operators import ingest, listing

FOLDER = "/root/testdata/sf0.001"


def test_rules_run_once(spark):
    """What later steps read are the stored documents: no rule is in their plans."""
    docs = flawed(Tables(spark, FOLDER))
    done = ingest.ingest_batch(docs, source="pos", now=AT)
    assert done.report["total"] == docs.count() == done.report["success"] + done.report["failed"]
    assert (done.accepted.count(), done.rejected.count()) == (done.report["success"], done.report["failed"])
    for df in (done.accepted, done.rejected):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "allowed value" not in plan and "ArrayExists" not in plan and "exists(" not in plan
    assert done.report["failed"] > 0 and "errors" in done.rejected.columns


def test_batches_without_documents_or_without_faults(spark):
    docs = flawed(Tables(spark, FOLDER))
    none = ingest.ingest_batch(docs.limit(0), now=AT)
    assert none.report == {"total": 0, "success": 0, "failed": 0}
    assert none.accepted.count() == none.rejected.count() == 0
    good = ingest.ingest_batch(docs.filter("saleId % 30 <> 0 AND saleId % 50 <> 0 AND saleId % 70 <> 0"), now=AT)
    assert good.rejected.count() == 0 and good.report["failed"] == 0


def test_messages_carry_lines_and_keys(spark):
    b, path = Tables(spark, FOLDER), session.work_folder(spark, "messages")
    docs = flawed(b).filter("saleId < 100")
    done = ingest.ingest_sales(docs, b.products, {"path": path}, now=AT, at=AT)
    sent = spark.read.parquet(path)
    sales = {m["_id"]: m for m in (json.loads(r.value) for r in sent.filter("topic = 'sales'").collect())}
    lines = [json.loads(r.value) for r in sent.filter("topic = 'sale_items'").collect()]
    assert len(sales) == done.report["success"] and lines
    for m in sales.values():
        own = [x for x in lines if x["saleId"] == m["_id"]]
        assert len(own) == len(m.get("items") or [])
        assert sum(x["subtotal"] for x in own) == pytest.approx(m["totalAmount"])
        assert all((x["companyId"], x["sector"]) == (m["companyId"], m["sector"]) for x in own)


def test_a_page_after_a_row_equals_the_numbered_page(spark):
    b = Tables(spark, FOLDER)
    cases = [
        (lambda **k: listing.items_list(b.items, b.sales, b.products, b.categories, size=37, **k), listing.ITEMS_ORDER),
        (lambda **k: listing.clients_list(b.clients, size=11, **k), ["-clientId"]),
        (lambda **k: listing.employees_list(b.employees, size=11, **k), ["-employeeId"]),
        (lambda **k: listing.products_list(b.products, b.categories, size=23, **k), ["-productId"]),
        (lambda **k: listing.payments_list(b.payments, b.sales, size=37, **k), listing.PAYMENTS_ORDER),
    ]
    for listed, order in cases:
        names, after = [c.lstrip("-") for c in order], {}
        for number in (1, 2, 3):
            want = [tuple(r) for r in listed(number=number).select(*names).collect()]
            got = [r for r in listed(after=after).select(*names).collect()]
            assert sorted(map(str, map(tuple, got))) == sorted(map(str, want)) and got
            last = listed(after=after).orderBy(*[F.desc(c[1:]) if c[0] == "-" else F.asc(c) for c in order]).collect()[-1]
            after = {c: last[c] for c in names}
