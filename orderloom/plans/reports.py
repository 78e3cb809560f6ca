"""The analytic questions and lookups over published tables and documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import audit, documents, lifecycle, revenue
from orderloom.schemas import DOCUMENTS, LISTINGS, ORDER_ITEMS, STATUS_HISTORY, TABLES
from orderloom.sources import layouts
from orderloom.sources.store import TableStore, path_exists


def top_sellers(store: TableStore, x: str = "1") -> DataFrame:
    return revenue.top_sellers(
        store.read(ORDER_ITEMS), store.read(STATUS_HISTORY), store.read(LISTINGS), int(x)
    )


def placed_to_shipped(store: TableStore) -> DataFrame:
    return lifecycle.avg_placed_to_shipped(store.read(STATUS_HISTORY))


def _laid_out(store: TableStore) -> bool:
    return path_exists(store.spark, f"{store.layouts()}/done")


def mom_growth(store: TableStore, start: str | None = None, end: str | None = None) -> DataFrame:
    """Growth over all months, or over deliveries from one time up to another: an item then counts
    in the month of its first delivery between them."""
    log = store.read(STATUS_HISTORY)
    if start is not None:
        if _laid_out(store):
            path = f"{store.layouts()}/log"
            log = layouts.read_log(store.spark, path, start, end, STATUS_HISTORY.struct)
        else:
            at = F.col("status_timestamp")
            log = log.filter(at >= F.lit(start).cast("timestamp_ntz"))
            log = log if end is None else log.filter(at < F.lit(end).cast("timestamp_ntz"))
    return revenue.mom_growth(store.read(ORDER_ITEMS), log)


def category(store: TableStore, name: str, seller_id: str | None = None) -> DataFrame:
    """The listings of a category, or of one of its sellers."""
    if _laid_out(store):
        path = f"{store.layouts()}/catalogue"
        return layouts.read_catalogue(store.spark, path, name, seller_id, LISTINGS.struct)
    found = store.read(LISTINGS).filter(F.col("category") == name)
    return found if seller_id is None else found.filter(F.col("seller_id") == seller_id)


def counts(store: TableStore) -> DataFrame:
    tables = {name: store.read(table) for name, table in TABLES.items()}
    return audit.table_counts({**tables, DOCUMENTS: store.read_documents()})


def order(store: TableStore, order_id: str) -> DataFrame:
    """One document, from its bucket alone."""
    found = store.spark.range(1).select(store.bucket(F.lit(order_id))).first()[0]
    return documents.order_lookup(store.read_documents([found]), order_id)


def customer(store: TableStore, customer_id: str) -> DataFrame:
    return documents.customer_orders(store.read_documents(), customer_id)


def status(store: TableStore, name: str) -> DataFrame:
    return documents.orders_by_status(store.read_documents(), name)


def sql(store: TableStore, statement: str) -> DataFrame:
    """Any query over the published tables and documents."""
    store.register_views()
    return store.spark.sql(statement)


REPORTS: dict[str, Callable[..., DataFrame]] = {
    "top-sellers": top_sellers,
    "placed-to-shipped": placed_to_shipped,
    "mom-growth": mom_growth,
    "category": category,
    "counts": counts,
    "order": order,
    "customer": customer,
    "status": status,
    "sql": sql,
}
