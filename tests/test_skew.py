"""Keys that hold a third of all rows: results stay whole and the work is split."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators import audit, documents, normalize, revenue, upsert

SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_partitions(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    for key, value in SMALL_PARTITIONS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def hot_listing(spark):
    """30,000 items, a third of them of listing 0."""
    return spark.range(0, 30_000, 1, 8).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500).alias("listing_id"),
        F.lit(2).alias("quantity"),
        F.lit(1.5).cast("decimal(10,2)").alias("price_at_purchase"),
    )


@pytest.fixture
def catalogue(spark):
    return spark.range(500).select(
        F.col("id").alias("listing_id"),
        F.concat(F.lit("product "), F.repeat(F.col("id").cast("string"), 5)).alias("product_name"),
        F.lit("CAT").alias("category"),
        (F.col("id") % 7).alias("seller_id"),
    )


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_row_level_lookup_splits_the_hot_listing(spark, small_partitions, hot_listing, catalogue):
    rows, plan = final_plan(documents.enrich_items(hot_listing, catalogue))
    assert "skew=true" in plan
    assert len(rows) == 30_000 and all(r.name is not None for r in rows)


def test_revenue_joins_listings_after_summing(spark, small_partitions, hot_listing, catalogue):
    log = hot_listing.select(
        "order_id",
        "listing_id",
        F.lit("DELIVERED").alias("order_status"),
        F.current_timestamp().cast("timestamp_ntz").alias("status_timestamp"),
    )
    rows, _ = final_plan(revenue.seller_category_revenue(hot_listing, log, catalogue))
    assert sum(r.revenue for r in rows) == 90_000
    plan = revenue.seller_category_revenue(hot_listing, log, catalogue)
    tree = plan._jdf.queryExecution().optimizedPlan().toString()
    # Reading upwards, an aggregate by listing sits below the join with the listings.
    assert tree.index("Join Inner") < tree.index("Aggregate [listing_id")


def test_hot_item_shrinks_before_the_shuffle(spark):
    """One item with 100,000 of the events leaves every task as one row."""
    events = spark.range(0, 100_000, 1, 8).select(
        F.lit(1).alias("order_id"),
        F.lit(1).alias("listing_id"),
        F.col("id").cast("int").alias("quantity"),
        F.lit(1).cast("decimal(10,2)").alias("price_at_purchase"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("event_timestamp"),
        F.lit("PLACED").alias("order_status"),
    )
    last = normalize.normalize_order_items(events)
    assert [tuple(r)[:3] for r in last.collect()] == [(1, 1, 99_999)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan


def test_orphans_are_counted_per_value(spark, hot_listing, catalogue):
    known = catalogue.filter("listing_id <> 0")
    assert [tuple(r) for r in audit.orphan_keys(hot_listing, known, ["listing_id"]).collect()] == [
        (0, 10_000 + len([i for i in range(30_000) if i % 3 and i % 500 == 0]))
    ]


def test_collated_keys_match_without_case_or_accents(spark):
    """Keys under a case- and accent-insensitive collation upsert as one key."""
    schema = "k string, v int"

    def collated(rows):
        return spark.createDataFrame(rows, schema).withColumn("k", F.collate("k", "UNICODE_CI_AI"))

    merged = upsert.upsert(
        collated([("c001", 1), ("café", 1), ("x", 1)]), collated([("C001", 2), ("CAFE", 3)]), ["k"]
    )
    assert sorted((r.k.lower(), r.v) for r in merged.collect()) == [
        ("c001", 2), ("cafe", 3), ("x", 1),
    ]


def test_a_giant_order_is_ranked_by_many_tasks(spark, small_partitions, catalogue, tmp_path):
    """Three quarters of all items are one order's; no task ranks more than its range of them."""
    items = spark.range(0, 20_000, 1, 8).select(
        F.when(F.col("id") % 4 == 0, F.col("id")).otherwise(F.lit(-1)).alias("order_id"),
        F.concat(F.lit("L"), F.lpad((F.col("id") * 7919 % 20_000).cast("string"), 6, "0")).alias("listing_id"),
        F.lit(2).alias("quantity"),
        F.lit(1.5).cast("decimal(10,2)").alias("price_at_purchase"),
    )
    listings = catalogue.withColumn("listing_id", F.concat(F.lit("L"), "listing_id"))
    written = []

    def write(df):
        path = str(tmp_path / f"w{len(written)}")
        df.write.parquet(path)
        written.append(path)
        return spark.read.schema(df.schema).parquet(path)

    ranked = documents.item_positions(items, listings, write)
    found = {(r.order_id, r.item.listing_id): r.position for r in ranked.collect()}
    ranges = spark.read.parquet(written[-1]).groupBy("_range").count().collect()
    assert len(ranges) >= 8 and max(r["count"] for r in ranges) < 20_000 / 4
    orders = {}
    for order_id, listing_id in found:
        orders.setdefault(order_id, []).append(listing_id)
    assert len(orders[-1]) == 15_000
    assert found == {(o, n): i for o, names in orders.items() for i, n in enumerate(sorted(names))}
    whole = documents.item_arrays(documents.enrich_items(items, listings)).filter("order_id = -1").first()
    assert [i.listing_id for i in whole["items"]] == sorted(orders[-1])
