"""Delivered revenue: per seller and category, top sellers, month over month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.status import DELIVERED
from orderloom.functions.temporal import month_start

ITEM_KEY = ["order_id", "listing_id"]
REVENUE = "decimal(38,2)"


def item_revenue() -> Column:
    return F.col("quantity") * F.col("price_at_purchase")


def delivered_items(history: DataFrame) -> DataFrame:
    """Items with a DELIVERED event at any time, even if something happened to them later."""
    return history.filter(F.col("order_status") == DELIVERED).select(*ITEM_KEY).distinct()


def seller_category_revenue(
    items: DataFrame, history: DataFrame, listings: DataFrame
) -> DataFrame:
    """Delivered revenue per category and seller.

    The distinct keeps the semi join one row per item whatever the number of events, and it
    shares the join's exchange. Revenue is summed per listing before listings are joined: a
    best-seller reaches that join as one row instead of a third of all items, and far fewer
    rows travel.
    """
    sold = items.join(delivered_items(history), ITEM_KEY, "left_semi")
    per_listing = sold.groupBy("listing_id").agg(
        F.sum(item_revenue()).cast(REVENUE).alias("revenue")
    )
    return (
        per_listing.join(listings.select("listing_id", "category", "seller_id"), "listing_id")
        .groupBy("category", "seller_id")
        .agg(F.sum("revenue").cast(REVENUE).alias("revenue"))
    )


def ranked_sellers(revenue: DataFrame, x: int | None = None) -> DataFrame:
    """Each seller's position ``rn`` in its category, ties by seller; with ``x`` the first ``x``.

    The rank bound sits on the window, so each task keeps only its own top ``x`` per category
    before the shuffle and a category with most of the sellers stays small.
    """
    best_first = Window.partitionBy("category").orderBy(
        F.col("revenue").desc_nulls_last(), "seller_id"
    )
    ranked = revenue.withColumn("rn", F.row_number().over(best_first))
    return ranked if x is None else ranked.filter(F.col("rn") <= x)


def top_sellers(
    items: DataFrame, history: DataFrame, listings: DataFrame, x: int = 1
) -> DataFrame:
    revenue = seller_category_revenue(items, history, listings)
    return (
        ranked_sellers(revenue, x)
        .select("category", "seller_id", "revenue")
        .orderBy("category", F.col("revenue").desc_nulls_last(), "seller_id")
    )


def category_revenue_ci(
    items: DataFrame, history: DataFrame, listings: DataFrame
) -> DataFrame:
    """Delivered revenue per category, taking spellings that differ in case or accent as one.

    Exact spellings are summed first, so the collation is compared for a few labels only. The
    smallest spelling names the group.
    """
    per_label = (
        seller_category_revenue(items, history, listings)
        .groupBy("category")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_label.groupBy(F.collate("category", "UNICODE_CI_AI").alias("_label"))
        .agg(F.min("category").alias("category"), F.sum("revenue").cast(REVENUE).alias("revenue"))
        .select("category", "revenue")
    )


def monthly_revenue(items: DataFrame, history: DataFrame) -> DataFrame:
    """Revenue by the month of each item's first delivery."""
    arrivals = (
        history.filter(F.col("order_status") == DELIVERED)
        .groupBy(*ITEM_KEY)
        .agg(month_start(F.min("status_timestamp")).alias("month_start"))
    )
    return (
        items.join(arrivals, ITEM_KEY)
        .groupBy("month_start")
        .agg(F.sum(item_revenue()).cast(REVENUE).alias("monthly_revenue"))
    )


def mom_growth(items: DataFrame, history: DataFrame) -> DataFrame:
    """Monthly revenue, the previous present month's revenue, and the relative change.

    The window has no partition key: its input is one row per month.
    """
    previous = F.lag("monthly_revenue").over(Window.orderBy("month_start"))
    change = F.try_divide(F.col("monthly_revenue") - F.col("prev_revenue"), F.col("prev_revenue"))
    return (
        monthly_revenue(items, history)
        .withColumn("prev_revenue", previous)
        .withColumn("mom_growth_ratio", change)
        .orderBy("month_start")
    )
