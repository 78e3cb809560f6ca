"""Marketplace-shaped views over the star-schema Parquet tables.

Order lines stand in for the order feed: each line is placed, and depending on its flags also
shipped, delivered or cancelled. All views are lazy; a query pays only for what it reads.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.normalize import last_by
from orderloom.session import configure, deal_out
from orderloom.sources.files import size_of


@dataclass(frozen=True)
class Marketplace:
    spark: SparkSession
    folder: str

    def __post_init__(self):
        configure(self.spark)
        deal_out(self.spark, size_of(self.spark, f"{self.folder}/lineitem.parquet"))

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
            F.lower(F.concat("c_name", F.lit("@example.com"))).alias("email"),
            F.expr("date_add(date'2020-01-01', cast(c_custkey % 1500 as int))").alias("join_date"),
            F.col("c_mktsegment").alias("city"),
        )

    @cached_property
    def listings(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("listing_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("seller_id"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
            F.col("p_size").alias("stock_quantity"),
            F.expr("date_add(date'2021-01-01', cast(p_partkey % 700 as int))").alias(
                "listing_date"
            ),
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Order lines with the times of their possible events.

        Both sides are shuffled by order, as large ones are anyway: the events of a single large
        file are then made by many tasks, and what is grouped by order needs no other shuffle.
        """
        lineitem, orders = self.table("lineitem"), self.table("orders").hint("merge")
        return lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_partkey").alias("listing_id"),
            F.col("l_quantity").cast("int").alias("quantity"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("price_at_purchase"),
            F.expr("o_orderdate + INTERVAL '1' MINUTE * (l_linenumber * 7 + 13)").alias("t_placed"),
            F.expr("l_shipdate + INTERVAL '1' MINUTE * (l_suppkey * 61 + 5)").alias("t_shipped"),
            (F.col("l_linestatus") == "F").alias("shipped"),
            (F.col("l_returnflag") == "N").alias("delivered"),
            (F.col("l_returnflag") == "R").alias("cancelled"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """The order feed: one pass over the lines, up to four events each."""

        def event(happened, at: str, status: str):
            return F.when(
                happened, F.struct(F.expr(at).alias("at"), F.lit(status).alias("status"))
            )

        happened = F.explode(
            F.array(
                event(F.lit(True), "t_placed", "PLACED"),
                event(F.col("shipped"), "t_shipped", "SHIPPED"),
                event(F.col("delivered"), "t_shipped + INTERVAL '3' DAY", "DELIVERED"),
                event(F.col("cancelled"), "t_shipped + INTERVAL '1' DAY", "CANCELLED"),
            )
        )
        base = ["order_id", "customer_id", "listing_id", "quantity", "price_at_purchase"]
        return (
            self.lines.select(*base, happened.alias("e"))
            .filter("e IS NOT NULL")
            .select(
                *base,
                F.col("e.at").alias("event_timestamp"),
                F.col("e.status").alias("order_status"),
            )
        )

    @cached_property
    def history(self) -> DataFrame:
        return self.events.select(
            "order_id",
            "listing_id",
            F.col("event_timestamp").alias("status_timestamp"),
            "order_status",
        )

    @cached_property
    def items(self) -> DataFrame:
        """Quantity and price as of each item's newest event.

        A line repeats them on all its events, so its newest event time is enough; the order is
        the same as over the events themselves.
        """
        newest = F.greatest(
            "t_placed",
            F.when(F.col("shipped"), F.col("t_shipped")),
            F.when(F.col("delivered"), F.expr("t_shipped + INTERVAL '3' DAY")),
            F.when(F.col("cancelled"), F.expr("t_shipped + INTERVAL '1' DAY")),
        )
        return last_by(
            self.lines.withColumn("newest", newest),
            ["order_id", "listing_id"],
            ["quantity", "price_at_purchase"],
            ["newest"],
        )
