"""Copies of published tables laid out for other questions than lookups by key.

What an index is to a database, a second layout is here: the status log by status and month, for
questions about a stretch of time, and the catalogue by category and seller. Rows are dealt by
ranges of what they are sorted by, so each file covers a narrow range, and a huge month, status or
category is written by many tasks. Reads prune whole folders by month and status, and within files
row groups by their smallest and largest value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import LISTINGS, STATUS_HISTORY

#: Folder derived from the time of an event; events without a time lie in the last.
MONTH = "status_month"
NO_MONTH = "none"

LOG_ORDER = ["order_status", MONTH, "status_timestamp", "order_id", "listing_id"]
CATALOGUE_ORDER = ["category", "seller_id", "listing_id"]


def month_of(timestamp: Column) -> Column:
    return F.coalesce(F.date_format(timestamp, "yyyy-MM"), F.lit(NO_MONTH))


def write_log_by_month(log: DataFrame, path: str) -> None:
    """The status log in folders by status and month, by time inside each file."""
    dated = log.withColumn(MONTH, month_of(F.col("status_timestamp")))
    ranged = dated.repartitionByRange(*LOG_ORDER).sortWithinPartitions(*LOG_ORDER)
    ranged.write.mode("overwrite").partitionBy("order_status", MONTH).parquet(path)


def read_log(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Log rows from a time on, up to but not including another ('2021-03-01', with or without a
    time of day); only folders of months between them are read. A log that may be empty needs its
    schema."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())]))
    log, at, month = reader.parquet(path), F.col("status_timestamp"), F.col(MONTH)
    if start is not None:
        log = log.filter((month >= start[:7]) & (month != NO_MONTH))
        log = log.filter(at >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        log = log.filter((month <= end[:7]) & (at < F.lit(end).cast("timestamp_ntz")))
    return log.select(*STATUS_HISTORY.columns)


def write_catalogue(listings: DataFrame, path: str) -> None:
    """Listings by category and seller: a filter on either skips row groups."""
    ranged = listings.repartitionByRange(*CATALOGUE_ORDER).sortWithinPartitions(*CATALOGUE_ORDER)
    ranged.write.mode("overwrite").parquet(path)


def read_catalogue(
    spark: SparkSession,
    path: str,
    category: str | None = None,
    seller_id: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    listings = reader.parquet(path).select(*LISTINGS.columns)
    for column, value in (("category", category), ("seller_id", seller_id)):
        if value is not None:
            listings = listings.filter(F.col(column) == value)
    return listings
