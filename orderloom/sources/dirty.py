"""Raw-feed renderings of the clean tables: the same rows as messy text.

Every row of a table is rendered; its key only picks which kind of mess it gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.sources.marketplace import Marketplace


def date_text(day: str, key: str) -> str:
    """SQL for a date as ISO, slashes, month name, or month name with a comma."""
    return f"""CASE {key} % 4
        WHEN 0 THEN date_format({day}, 'yyyy-MM-dd')
        WHEN 1 THEN date_format({day}, 'MM/dd/yyyy')
        WHEN 2 THEN date_format({day}, 'MMM dd yyyy')
        ELSE date_format({day}, 'MMM dd, yyyy') END"""


def datetime_text(ts: str, key: str) -> str:
    """SQL for a time as ISO, with a zone, slashes, 12-hour clock, or a missing-value token."""
    return f"""CASE {key} % 8
        WHEN 0 THEN date_format({ts}, 'yyyy-MM-dd HH:mm:ss')
        WHEN 1 THEN date_format({ts}, 'MM/dd/yyyy  HH:mm:ss')
        WHEN 2 THEN date_format({ts}, 'h:mm a MMM dd, yyyy')
        WHEN 3 THEN ' N/A '
        WHEN 4 THEN concat(date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss"), 'Z')
        WHEN 5 THEN concat(date_format({ts}, "yyyy-MM-dd'T'HH:mm:ss"), '+00:00')
        WHEN 6 THEN date_format({ts}, 'MM/dd/yyyy hh:mm a')
        ELSE date_format({ts}, 'MMM dd, yyyy h:mm a') END"""


def status_text(status: str, key: str) -> str:
    """SQL for a status with the misspellings of its kind."""
    return f"""CASE {key} % 3
        WHEN 0 THEN {status}
        WHEN 1 THEN CASE {status} WHEN 'PLACED' THEN ' placedd' WHEN 'SHIPPED' THEN 'Shiped'
            WHEN 'DELIVERED' THEN 'deliverd ' ELSE 'Canceld' END
        ELSE CASE {status} WHEN 'PLACED' THEN 'replaced' WHEN 'SHIPPED' THEN 'SHIPPD'
            WHEN 'DELIVERED' THEN 'delvd' ELSE 'shipment cancelled' END END"""


def quantity_text(quantity: str, key: str) -> str:
    return f"""CASE {key} % 6
        WHEN 0 THEN cast({quantity} AS string)
        WHEN 1 THEN concat({quantity}, '.7')
        WHEN 2 THEN 'abc'
        WHEN 3 THEN ' '
        WHEN 4 THEN '1e3'
        ELSE concat(' ', {quantity}, '.0 ') END"""


def customer_lines(m: Marketplace) -> DataFrame:
    """(row_key, line): comma dates, missing cells, padded, quoted and null-token cells."""
    day = "date_add(date'2020-01-01', cast(c_custkey % 1500 AS int))"
    line = f"""concat_ws(',',
        concat('c', c_custkey),
        CASE c_custkey % 3 WHEN 0 THEN '  First ' WHEN 1 THEN '"First"' ELSE 'First' END,
        CASE c_custkey % 10 WHEN 9 THEN 'Na' ELSE replace(c_name, '#', ' ') END,
        CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'N/A'
            ELSE concat('user', c_custkey, '@example.com') END,
        CASE WHEN c_custkey % 13 = 0 THEN date_format({day}, 'MMM, dd, yyyy')
            ELSE {date_text(day, 'c_custkey')} END,
        CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN ' nan'
            WHEN c_custkey % 6 = 1 THEN concat(' ', lower(c_mktsegment), ' ')
            ELSE c_mktsegment END)"""
    return m.table("customer").select(
        F.col("c_custkey").alias("row_key"), F.expr(line).alias("line")
    )


def listing_lines(m: Marketplace) -> DataFrame:
    """(row_key, line): quoted currency, thousands commas, inch marks, trailing comma dates."""
    day = "date_add(date'2021-01-01', cast(p_partkey % 700 AS int))"
    price = "cast(cast(p_retailprice AS decimal(10,2)) AS string)"
    line = f"""concat_ws(',',
        concat('L', p_partkey),
        CASE WHEN p_partkey % 9 = 0 THEN concat(p_name, ' 27"') ELSE p_name END,
        CASE p_partkey % 4 WHEN 0 THEN concat(' ', lower(p_type), ' ') ELSE p_type END,
        CASE p_partkey % 5 WHEN 0 THEN concat('" ', p_brand, ' "') ELSE p_brand END,
        CASE WHEN p_partkey % 17 = 0 THEN concat('"$1,', {price}, '"')
            WHEN p_partkey % 10 = 0 THEN concat('" $', {price}, ' "')
            ELSE concat('"$', {price}, '"') END,
        CASE p_partkey % 8 WHEN 7 THEN 'none' ELSE cast(p_size AS string) END,
        {date_text(day, 'p_partkey')})"""
    return m.table("part").select(
        F.col("p_partkey").alias("row_key"), F.expr(line).alias("line")
    )


def raw_events(m: Marketplace) -> DataFrame:
    """The order feed as text: mixed time formats, misspelt statuses, dirty numbers."""
    return m.events.select(
        F.col("order_id").cast("string").alias("order_id"),
        F.concat(F.lit(" c"), F.col("customer_id"), F.lit(" ")).alias("customer_id"),
        F.concat(F.lit("L"), F.col("listing_id")).alias("listing_id"),
        F.expr(quantity_text("quantity", "(listing_id * 2 + listing_id % 2)")).alias("quantity"),
        F.expr(
            "CASE order_id % 9 WHEN 0 THEN 'NULL' ELSE cast(price_at_purchase AS string) END"
        ).alias("price_at_purchase"),
        F.expr(datetime_text("event_timestamp", "order_id")).alias("event_timestamp"),
        F.expr(status_text("order_status", "listing_id")).alias("order_status"),
    )


def event_lines(m: Marketplace) -> DataFrame:
    """The raw feed as CSV records: quoted times, some records too long, some too short."""
    time = F.concat(F.lit('"'), F.col("event_timestamp"), F.lit('"'))
    status = F.expr("CASE WHEN order_id % 5 <> 2 THEN order_status END")
    surplus = F.expr("CASE WHEN order_id % 5 = 1 THEN 'extra' END")
    cells = ["order_id", "customer_id", "listing_id", "quantity", "price_at_purchase"]
    return raw_events(m).select(F.concat_ws(",", *cells, time, status, surplus).alias("line"))


def write_lines(lines: DataFrame, header: str, path: str) -> None:
    """Text files that each start with a header line; the lines are written as they are."""
    lines.select(F.col("line").alias(header)).write.mode("overwrite").csv(
        path,
        header=True,
        sep="\u0001",
        quote="\u0002",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
