"""Starting the windowed streams, and keeping the result tables by one stream for each source."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from salesloom.session import work_folder
from salesloom.streaming import changes, pairs
from salesloom.streaming import windowed as w
from salesloom.streaming.changes import result_tables  # noqa: F401
from salesloom.streaming.kept import PARTS, stamp  # noqa: F401
from salesloom.streaming.ledger import Columns, write_batch


@dataclasses.dataclass(frozen=True)
class Inputs:
    sales: DataFrame
    items: DataFrame
    products: DataFrame | None = None
    employees: DataFrame | None = None


@dataclasses.dataclass(frozen=True)
class QuerySpec:
    """One windowed stream: how it is built, emitted, triggered and stored."""

    name: str
    build: Callable[..., DataFrame]
    mode: str
    trigger: str
    columns: Columns


# Output modes and triggers of the ten streams.
SPECS = [
    QuerySpec("sector", lambda i, **o: w.sector_windows(i.sales, **o), "update", "10 seconds",
              Columns(["sector"], ["revenue", "salesCount"])),
    QuerySpec("region", lambda i, **o: w.region_windows(i.sales, **o), "update", "10 seconds",
              Columns(["region", "sector"], ["revenue", "salesCount"])),
    QuerySpec("market_products", lambda i, **o: w.market_product_windows(i.items, i.products, **o), "update",
              "1 minute", Columns(["productId", "sector"], ["totalRevenue", "totalQuantity"],
                                  ["productName", "brand"])),
    QuerySpec("company_products", lambda i, **o: w.company_product_windows(i.items, i.products, **o), "update",
              "1 minute", Columns(["productId", "companyId", "sector"], ["totalRevenue", "totalQuantity"],
                                  ["productName", "brand"])),
    QuerySpec("market_brands", lambda i, **o: w.market_brand_windows(i.items, i.products, **o), "update",
              "1 minute", Columns(["brand", "sector"], ["totalRevenue"])),
    QuerySpec("market_employees", lambda i, **o: w.market_employee_windows(i.sales, **o), "update", "1 minute",
              Columns(["sector"], ["revenue", "totalSales"])),
    QuerySpec("company", lambda i, **o: w.company_windows(i.sales, **o), "append", "10 seconds",
              Columns(["companyId", "sector"], ["revenue", "salesCount"])),
    QuerySpec("market", lambda i, **o: w.market_windows(i.sales, **o), "append", "10 seconds",
              Columns(["sector"], ["marketRevenue", "marketSalesCount"])),
    QuerySpec("company_brands", lambda i, **o: w.company_brand_windows(i.items, i.sales, i.products, **o),
              "append", "1 minute", Columns(["companyId", "sector", "brand"],
                                            ["revenue", "quantity", "listWorth", "pricedQuantity"], ["productName"])),
    QuerySpec("company_employees", lambda i, **o: w.company_employee_windows(i.sales, i.employees, **o),
              "append", "1 minute", Columns(["companyId", "sector", "employeeId"], ["revenue", "salesCount"],
                                            ["employeeName"])),
]
BY_NAME = {spec.name: spec for spec in SPECS}


def start(spec: QuerySpec, inputs: Inputs, root: str, once: bool = False, **options: str) -> StreamingQuery:
    """Start one stream into its ledger; ``once`` takes what is available and ends."""
    df = spec.build(inputs, **options)
    trigger = {"availableNow": True} if once else {"processingTime": spec.trigger}
    return (df.writeStream.queryName(f"{spec.name}-{root.rsplit('/', 1)[-1]}").outputMode(spec.mode)
            .option("checkpointLocation", f"{root}/{spec.name}/checkpoint").trigger(**trigger)
            .foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, f"{root}/{spec.name}"))
            .start())


def start_kept(inputs: Inputs, root: str, once: bool = False, of: Sequence[str] = ("sales", "items"),
               bound: str = w.TWO_MINUTES, watermark: str = w.TWO_MINUTES, parts: int = PARTS,
               hot: DataFrame | None = None) -> list[StreamingQuery]:
    """The streams behind the ten result tables: one over sales, one over items joined with sales.

    Each batch is fanned out to the tables of its stream. A batch that fails is run again under its number. ``hot`` are
    sales of very many lines (see ``join_items_sales``).
    """
    def keep_items(batch: DataFrame, batch_id: int) -> None:
        lines = pairs.items_with_company(batch, batch_id, root, bound, watermark, hot)
        changes.keep_items(lines, batch_id, root, inputs.products, parts)

    both = pairs.items_and_sales(inputs.items, inputs.sales) if "items" in of else None
    kinds = {
        "sales": (inputs.sales, "10 seconds", lambda df, n: changes.keep_sales(df, n, root, parts)),
        "items": (both, "1 minute", keep_items),
    }
    running = []
    for name in of:
        df, trigger, keep = kinds[name]
        keep(df.sparkSession.createDataFrame([], df.schema), -1)  # empty tables, until the first batch
        running.append(
            df.writeStream.queryName(f"keep-{name}-{root.rsplit('/', 1)[-1]}").outputMode("append")
            .option("checkpointLocation", f"{root}/checkpoints/{name}")
            .trigger(**({"availableNow": True} if once else {"processingTime": trigger})).foreachBatch(keep).start())
    return running


def run_all(spark: SparkSession, inputs: Inputs, root: str | None = None) -> str:
    """Keep all result tables until one of the streams ends, then stop the other; errors are raised."""
    root = root or work_folder(spark, "tables")
    running = start_kept(inputs, root)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in running:
            q.stop()
    return root
