"""One nested document per order, and lookups over the documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.temporal import iso_utc
from orderloom.operators.lifecycle import MILESTONES, order_lifecycle, timeline, with_hours
from orderloom.operators.ranking import ranks
from orderloom.schemas import DOCUMENT

# Fixed values every document carries.
CURRENCY = "SGD"
SOURCE = "mysql-snapshot"

ITEM_TYPE = DOCUMENT["items"].dataType

# What an order's items are sorted by: the parts of the array's elements, one after another.
ITEM_PARTS = ("listing_id", "quantity", "extended_price", "product")


def enrich_items(items: DataFrame, listings: DataFrame) -> DataFrame:
    """Items with their product's name, category and seller; unknown listings leave nulls.

    Row-level lookup: a small catalogue is broadcast, a large one joined by listing with AQE
    splitting the partition of a listing that dominates.
    """
    product = listings.select(
        "listing_id", F.col("product_name").alias("name"), "category", "seller_id"
    )
    return (
        items.select("order_id", "listing_id", "quantity", "price_at_purchase")
        .join(product, "listing_id", "left")
        .withColumn("amount", item_amount())
        .withColumn("extended_price", F.col("amount").cast("double"))
    )


def _item() -> Column:
    price = F.coalesce(F.col("price_at_purchase").cast("double"), F.lit(0.0))
    return F.struct(
        F.col("listing_id").cast("string").alias("listing_id"),
        F.coalesce(F.col("quantity"), F.lit(0)).alias("quantity"),
        "extended_price",
        F.struct("name", "category", "seller_id", price.alias("price_at_purchase")).alias(
            "product"
        ),
    )


def _subtotal() -> Column:
    return F.sum("amount").cast("decimal(38,2)").alias("subtotal")


def item_amount() -> Column:
    """Exact quantity x price, zero when either is missing."""
    return F.coalesce(F.col("quantity") * F.col("price_at_purchase"), F.lit(0))


def order_payment(items: DataFrame) -> DataFrame:
    """Exact subtotal per order with items."""
    return items.withColumn("amount", item_amount()).groupBy("order_id").agg(_subtotal())


def item_arrays(enriched: DataFrame) -> DataFrame:
    """(order_id, items, subtotal): the items of each order by listing (as text).

    One shuffle. A document is one row, so an order's items end in one task, whatever their number.
    """
    items = F.sort_array(F.collect_list(_item())).alias("items")
    return enriched.groupBy("order_id").agg(items, _subtotal())


def order_items_array(items: DataFrame, listings: DataFrame) -> DataFrame:
    """(order_id, items): the item arrays of all orders, sorted by listing."""
    return item_arrays(enrich_items(items, listings)).drop("subtotal")


def item_positions(
    items: DataFrame, listings: DataFrame, write: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """The elements of the item arrays as rows, each with its position in its order.

    For orders too large to be one row: the items are dealt by ranges of (order, listing), so a
    huge order is ranked by many tasks, each within its range. ``write`` puts rows into a table.
    """
    enriched = write(enrich_items(items, listings))
    keyed = enriched.select(
        "order_id", _item().alias("item"), F.monotonically_increasing_id().alias("_row")
    )
    # Rows equal in all elements may change places; the last key lets them spread over ranges.
    order = ["order_id", *(f"item.{part}" for part in ITEM_PARTS), "_row"]
    ranked = ranks(keyed, order, "rank", write).drop("_row")
    # An order's items follow one another: its first rank is the number of items before it.
    counts = ranked.groupBy("order_id").agg(F.min("rank").alias("first"))
    return ranked.join(counts, "order_id").select(
        "order_id", (F.col("rank") - F.col("first")).alias("position"), "item"
    )


def order_snapshot(
    orders: DataFrame, items: DataFrame, listings: DataFrame, history: DataFrame
) -> DataFrame:
    """One document per order, whether or not it has items or events.

    Items, payment and lifecycle are each reduced by order, so all joins are on the order and
    reuse the aggregations' partitioning.
    """
    headers = (
        orders.select("order_id", "customer_id")
        .join(with_hours(order_lifecycle(history)), "order_id", "left")
        .withColumns({name: iso_utc(F.col(name)) for name in MILESTONES})
    )
    order_id = F.col("order_id").cast("string")
    subtotal = F.coalesce(F.col("subtotal").cast("double"), F.lit(0.0))
    arrays = item_arrays(enrich_items(items, listings))
    return headers.join(arrays, "order_id", "left").select(
        order_id.alias("_id"),
        order_id.alias("order_id"),
        F.struct(F.col("customer_id").cast("string").alias("customer_id")).alias("customer"),
        F.coalesce("items", F.array().cast(ITEM_TYPE)).alias("items"),
        timeline().alias("status_timeline"),
        "current_status",
        *MILESTONES,
        F.struct(
            F.lit(CURRENCY).alias("currency"),
            subtotal.alias("subtotal"),
            subtotal.alias("total"),
        ).alias("payment"),
        F.struct("hours_to_ship", "hours_to_deliver").alias("metrics"),
        F.struct(
            F.lit(SOURCE).alias("source"), iso_utc(F.current_timestamp()).alias("snapshot_ts")
        ).alias("audit"),
    )


def flatten(documents: DataFrame) -> DataFrame:
    """Scalar columns of the documents."""
    return documents.select(
        "_id",
        F.col("customer.customer_id").alias("customer_id"),
        F.size("items").alias("item_count"),
        F.size("status_timeline").alias("timeline_length"),
        "current_status",
        *MILESTONES,
        F.col("payment.currency").alias("currency"),
        F.col("payment.subtotal").alias("subtotal"),
        F.col("payment.total").alias("total"),
        F.col("metrics.hours_to_ship").alias("hours_to_ship"),
        F.col("metrics.hours_to_deliver").alias("hours_to_deliver"),
    )


def documents_of(
    orders: DataFrame,
    items: DataFrame,
    listings: DataFrame,
    history: DataFrame,
    ids: DataFrame | None = None,
) -> DataFrame:
    """Documents of a few orders: the other orders' rows are filtered out before any grouping.

    ``ids`` may give the orders' numbers once more, as a scan or broadcast, so that they are not
    taken from the orders again for each table.
    """
    if ids is None:
        ids = orders.select("order_id")
    return order_snapshot(
        orders,
        items.join(ids, "order_id", "left_semi"),
        listings,
        history.join(ids, "order_id", "left_semi"),
    )


def order_document(
    order_id: object,
    orders: DataFrame,
    items: DataFrame,
    listings: DataFrame,
    history: DataFrame,
) -> DataFrame:
    """One order's document; the key filter reaches the scans of all three order tables."""
    wanted = F.col("order_id") == F.lit(order_id)
    return order_snapshot(
        orders.filter(wanted), items.filter(wanted), listings, history.filter(wanted)
    )


def order_lookup(documents: DataFrame, order_id: object) -> DataFrame:
    """One order's document."""
    return documents.filter(F.col("order_id") == str(order_id))


def customer_orders(documents: DataFrame, customer_id: object) -> DataFrame:
    """A customer's orders, newest delivery first, undelivered ones last."""
    return documents.filter(F.col("customer.customer_id") == str(customer_id)).orderBy(
        F.col("delivered_at").desc_nulls_last(), "_id"
    )


def orders_by_status(documents: DataFrame, status: str) -> DataFrame:
    """Orders whose newest event has the given status, newest placement first."""
    return documents.filter(F.col("current_status") == status).orderBy(
        F.col("placed_at").desc_nulls_last(), "_id"
    )
