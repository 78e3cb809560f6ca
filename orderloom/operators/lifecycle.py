"""Milestones of items and orders, derived from the status log in single passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.status import DELIVERED, PLACED, SHIPPED, stage
from orderloom.functions.temporal import (
    hours_between,
    whole_hours_between,
    whole_minutes_between,
)

# Milestone columns in lifecycle order.
MILESTONES = {"placed_at": PLACED, "shipped_at": SHIPPED, "delivered_at": DELIVERED}


def _first_times() -> list[Column]:
    return [
        F.min(F.when(F.col("order_status") == status, F.col("status_timestamp"))).alias(name)
        for name, status in MILESTONES.items()
    ]


def _milestones(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    relevant = history.filter(F.col("order_status").isin(*MILESTONES.values()))
    return relevant.groupBy(*keys).agg(*_first_times())


def item_milestones(history: DataFrame) -> DataFrame:
    """First PLACED, SHIPPED and DELIVERED time of each item that has any of them."""
    return _milestones(history, ["order_id", "listing_id"])


def order_milestones(history: DataFrame) -> DataFrame:
    """The same over all items of an order."""
    return _milestones(history, ["order_id"])


def avg_placed_to_shipped(history: DataFrame) -> DataFrame:
    """Mean whole hours and minutes from placement to shipment over items shipped in order.

    One pass over the log pairs the two events. Totals are summed as integers: the mean is
    exact and the same for any partitioning.
    """
    paired = (
        history.filter(F.col("order_status").isin(PLACED, SHIPPED))
        .groupBy("order_id", "listing_id")
        .agg(*_first_times()[:2])
        .filter("shipped_at >= placed_at")
    )
    totals = paired.agg(
        F.sum(whole_hours_between(F.col("placed_at"), F.col("shipped_at"))).alias("hours"),
        F.sum(whole_minutes_between(F.col("placed_at"), F.col("shipped_at"))).alias("minutes"),
        F.count(F.lit(1)).alias("items_count"),
    )

    def mean(total: str) -> Column:
        exact = F.try_divide(F.col(total).cast("decimal(20,0)"), F.col("items_count"))
        return exact.cast("decimal(24,4)")

    return totals.select(
        mean("hours").alias("avg_hours"), mean("minutes").alias("avg_minutes"), "items_count"
    )


def _current_status() -> Column:
    """Status of the newest event; an undated event counts as newest; equal times resolve to
    the later lifecycle stage, then the larger listing."""
    newest = F.max(
        F.struct(
            F.col("status_timestamp").isNull().alias("undated"),
            F.col("status_timestamp").alias("at"),
            stage(F.col("order_status")).alias("stage"),
            F.col("listing_id").alias("listing_id"),
            F.col("order_status").alias("status"),
        )
    )
    return newest["status"].alias("current_status")


def order_current_status(history: DataFrame) -> DataFrame:
    return history.groupBy("order_id").agg(_current_status())


def order_lifecycle(history: DataFrame) -> DataFrame:
    """Milestones and current status of every order in the log, in one aggregation."""
    return history.groupBy("order_id").agg(*_first_times(), _current_status())


def with_hours(lifecycle: DataFrame) -> DataFrame:
    """Fractional hours from placement; unlike the item averages, out-of-order times count."""
    return lifecycle.withColumns(
        {
            "hours_to_ship": hours_between(F.col("placed_at"), F.col("shipped_at")),
            "hours_to_deliver": hours_between(F.col("placed_at"), F.col("delivered_at")),
        }
    )


def order_metrics(history: DataFrame) -> DataFrame:
    return with_hours(order_milestones(history)).select(
        "order_id", "hours_to_ship", "hours_to_deliver"
    )


def timeline() -> Column:
    """Array of the reached milestones, always in lifecycle order; expects them as text."""
    steps = [
        F.when(
            F.col(name).isNotNull(),
            F.struct(F.lit(status).alias("status"), F.col(name).alias("at")),
        )
        for name, status in MILESTONES.items()
    ]
    return F.array_compact(F.array(*steps))
