"""Split the denormalised event feed into orders, items and the status log.

Each output is one aggregation keyed by its primary key that combines on the map side first,
so an item or order holding a large share of all events shrinks before the shuffle, and no
group is ever sorted or collected as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.numeric import to_number, to_quantity
from orderloom.functions.temporal import parse_mixed_datetime
from orderloom.schemas import MONEY


def typed_events(events: DataFrame) -> DataFrame:
    """Quantity defaults to 0, price and time become null when unreadable."""
    timestamp = F.col("event_timestamp")
    if isinstance(events.schema["event_timestamp"].dataType, T.StringType):
        timestamp = parse_mixed_datetime(timestamp)
    return events.withColumns(
        {
            "quantity": to_quantity(F.col("quantity")),
            "price_at_purchase": to_number(F.col("price_at_purchase")).try_cast(MONEY),
            "event_timestamp": timestamp.cast("timestamp_ntz"),
        }
    )


def last_by(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Per key, the values of the row that is last by ``order``; nulls in it come first.

    The values close the ordering, so equal positions resolve the same way on every run.
    """
    position = [
        (F.col(o) if isinstance(o, str) else o).alias(f"_{i}") for i, o in enumerate(order)
    ]
    last = F.max(F.struct(*position, *values)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *(F.col(f"_last.{v}") for v in values))


def newest_last(timestamp: str) -> list[Column]:
    """Ordering in which a missing time counts as the newest."""
    return [F.col(timestamp).isNull(), F.col(timestamp)]


def normalize_orders(events: DataFrame) -> DataFrame:
    """Distinct (order, customer) pairs."""
    return events.select("order_id", "customer_id").distinct()


def normalize_order_items(events: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Quantity and price from the newest event of each item.

    ``order`` names columns that break ties between equal times, e.g. the file order.
    """
    return last_by(
        events,
        ["order_id", "listing_id"],
        ["quantity", "price_at_purchase"],
        [*newest_last("event_timestamp"), *order],
    )


def status_log(events: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Every event as a status-log row, with ``extra`` columns carried along."""
    return events.select(
        "order_id",
        "listing_id",
        F.col("event_timestamp").alias("status_timestamp"),
        "order_status",
        *extra,
    )


def normalize_history(events: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The status log with one status per item and time: the last one delivered by the feed."""
    renamed = events.withColumnRenamed("event_timestamp", "status_timestamp")
    return last_by(
        renamed, ["order_id", "listing_id", "status_timestamp"], ["order_status"], list(order)
    )
