"""Named queries over the star-schema tables, one per operator.

Each takes (spark, folder) and returns a lazy DataFrame. Results are flat where the operator
allows it, so they can be compared value by value with a SQL engine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions import numeric, status, temporal, text
from orderloom.operators import audit, cleaning, documents, lifecycle, normalize, revenue, upsert
from orderloom.plans import jobs
from orderloom.session import shared_folder
from orderloom.sources import delimited, dirty, layouts, lines, store
from orderloom.sources.marketplace import Marketplace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CUSTOMER_COLUMNS = schemas.CUSTOMERS.columns
LISTING_COLUMNS = schemas.LISTINGS.columns

# The order and customer the lookups ask for.
LOOKUP_ORDER = 7
LOOKUP_CUSTOMER = 11


def query(build: Callable[[Marketplace], DataFrame]) -> Callable[[Marketplace], DataFrame]:
    QUERIES[build.__name__] = lambda spark, folder: build(Marketplace(spark, folder))
    return build


# --- scans, layout, upserts -------------------------------------------------------------------


@query
def scan_orders(m):
    """The four column-pruned reads behind the documents, one for each table."""
    return m.orders.select("order_id", "customer_id")


@query
def scan_items(m):
    return m.items.select("order_id", "listing_id", "quantity", "price_at_purchase")


@query
def scan_listings(m):
    return m.listings.select("listing_id", "product_name", "category", "seller_id")


@query
def scan_history(m):
    """The log as rows and how often it repeats them: one line of an order may come twice."""
    columns = ["order_id", "listing_id", "order_status", "status_timestamp"]
    return m.history.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))


def _new_folder(m, name: str) -> str:
    return f"{shared_folder(m.spark)}/{name}-{uuid.uuid4().hex}"


def _written(m, name: str, df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read back, as jobs hand over."""
    path = _new_folder(m, name)
    df.write.parquet(path)
    return m.spark.read.schema(df.schema).parquet(path)


@query
def scan_customer_lines(m):
    """Lines written to files with headers, read back and repaired."""
    path = _new_folder(m, "customer_lines")
    dirty.write_lines(dirty.customer_lines(m), ",".join(CUSTOMER_COLUMNS), path)
    return lines.read_repaired(m.spark, path, cleaning.CUSTOMER_DATE_INDEX)


@query
def scan_listing_lines(m):
    path = _new_folder(m, "listing_lines")
    dirty.write_lines(dirty.listing_lines(m), ",".join(LISTING_COLUMNS), path)
    return lines.read_repaired(m.spark, path, cleaning.LISTING_DATE_INDEX)


@query
def scan_event_records(m):
    """Quoted records read back: too long ones are gone, short ones padded."""
    path = _new_folder(m, "event_lines")
    dirty.write_lines(dirty.event_lines(m), ",".join(schemas.EVENT_COLUMNS), path)
    return delimited.read_events_csv(m.spark, path)


@query
def load_tables(m):
    """All feeds written as raw files, cleaned, loaded twice, and read back as published."""
    folder = _new_folder(m, "load")
    listings = m.listings.withColumn("price", F.concat(F.lit("$"), "price"))
    feeds = {
        "customers": m.customers,
        "listings": listings,
        # File order decides between events of one item and time: an order's events lie in one
        # file, sorted in it.
        "orders": m.events.repartition("order_id")
        .sortWithinPartitions("quantity", "price_at_purchase", "order_status")
        .withColumn("order_status", F.lower("order_status")),
    }
    for name, df in feeds.items():
        # The events are in many files already; the other feeds' few files must be split to be read.
        compression = "gzip" if name == "orders" else None
        delimited.write_csv(df, f"{folder}/raw/{jobs.RAW_FILES[name]}", compression)
    jobs.clean_files(m.spark, f"{folder}/raw", f"{folder}/clean", compression="gzip")
    for _ in range(2):
        jobs.load_tables(m.spark, f"{folder}/clean", f"{folder}/store")
    published = store.TableStore(m.spark, f"{folder}/store")
    return audit.union_all(
        published.read(table).select(
            F.lit(name).alias("table_name"), F.concat_ws("|", *table.columns).alias("row")
        )
        for name, table in schemas.TABLES.items()
    )


def _twice(df: DataFrame) -> DataFrame:
    """A batch that names every key two times; ``seq`` tells the versions apart."""
    return df.withColumn("seq", F.explode(F.array(F.lit(1), F.lit(2))))


@query
def upsert_customers(m):
    """Half of the batch renews stored customers, the other half is new."""
    batch = _twice(m.customers).withColumns(
        {
            "customer_id": F.col("customer_id") * 2,
            "email": F.when(F.col("seq") == 1, F.col("email")),
            "city": F.concat_ws("-", "city", "seq"),
        }
    )
    return upsert.upsert(m.customers, batch, schemas.CUSTOMERS.key, ["seq"])


@query
def upsert_listings(m):
    """The batch brings prices and stock as text."""
    batch = _twice(m.listings).withColumns(
        {
            "listing_id": F.col("listing_id") * 2,
            "price": F.concat((F.col("price") + F.col("seq")).cast("string"), F.lit("4")),
            "stock_quantity": (F.col("stock_quantity") + F.col("seq")).cast("string"),
        }
    )
    return upsert.upsert(
        m.listings, upsert.cast_listings(batch), schemas.LISTINGS.key, ["seq"]
    )


@query
def upsert_orders(m):
    batch = _twice(m.orders).withColumns(
        {"order_id": F.col("order_id") * 2, "customer_id": F.col("customer_id") + F.col("seq")}
    )
    return upsert.upsert(m.orders, batch, schemas.ORDERS.key, ["seq"])


@query
def upsert_order_items(m):
    batch = _twice(m.items).withColumns(
        {
            "order_id": F.col("order_id") * 2,
            "quantity": F.col("quantity") + F.col("seq"),
            "price_at_purchase": F.when(F.col("seq") == 1, F.col("price_at_purchase")),
        }
    )
    return upsert.upsert(m.items, batch, schemas.ORDER_ITEMS.key, ["seq"])


@query
def upsert_status_history(m):
    """Two statuses for one item and time: the later one in the batch stays."""
    stored = normalize.normalize_history(m.events)
    batch = _twice(m.history).withColumns(
        {
            "order_id": F.col("order_id") * 2,
            "order_status": F.when(F.col("seq") == 2, F.lit("CANCELLED")).otherwise(
                F.col("order_status")
            ),
        }
    )
    return upsert.upsert(stored, batch, schemas.STATUS_HISTORY.key, ["seq"])


@query
def upsert_metrics(m):
    batch = m.orders.withColumn("order_id", F.col("order_id") * 2)
    return upsert.upsert_metrics(m.orders, batch, schemas.ORDERS.key)


@query
def snapshot_upsert(m):
    """Renewed documents replace stored ones by order; the others stay."""
    stored = _written(m, "documents", _documents(m))
    renumbered = (F.col("order_id").cast("bigint") * 2).cast("string")
    fresh = stored.withColumns(
        {"_id": renumbered, "order_id": renumbered, "current_status": F.lit("CANCELLED")}
    )
    return documents.flatten(upsert.snapshot_upsert(stored, fresh))


def _published(m, *names: str) -> store.TableStore:
    """A store with some of the five tables published, as declared."""
    views = {**_five(m), "order_item_status_history": normalize.normalize_history(m.events)}
    tables = store.TableStore(m.spark, _new_folder(m, "store"))
    tables.publish({n: tables.stage_table(schemas.TABLES[n], _declared(views[n], n)) for n in names})
    return tables


def _declared(rows: DataFrame, name: str) -> DataFrame:
    return rows.select(*(F.col(f.name).cast(f.type).alias(f.name) for f in schemas.TABLES[name].fields))


def _replace(tables: store.TableStore, batches: dict[str, DataFrame]) -> None:
    """Merge batches, unique by key, into their buckets and publish."""
    staged = {}
    for name, batch in batches.items():
        table = schemas.TABLES[name]
        fresh, touched = tables.stage_keys(f"_load/{name}", batch, table.key[0])
        merged = upsert.replace_rows(tables.read(table, touched), fresh, table.key)
        staged[name] = tables.stage_table(table, merged, touched)
    tables.publish(staged)


#: A small load: so many orders change hands, and so many listings their name.
EVERY_ORDER, EVERY_LISTING = 499, 701


def _small_load(m) -> dict[str, DataFrame]:
    orders = m.orders.filter(F.col("order_id") % EVERY_ORDER == 0)
    listings = m.listings.filter(F.col("listing_id") % EVERY_LISTING == 0)
    return {
        "orders": _declared(orders.withColumn("customer_id", F.col("customer_id") + 1), "orders"),
        "listings": _declared(
            listings.withColumn("product_name", F.concat("product_name", F.lit(" II"))), "listings"
        ),
    }


@query
def merge_buckets(m):
    """Items of a few orders merged into the published table: only their buckets are read and
    written."""
    tables = _published(m, "order_items")
    few = m.items.filter(F.col("order_id") % EVERY_ORDER == 0)
    batch = few.withColumn("quantity", F.col("quantity") + 1)
    moved = few.withColumn("listing_id", -F.col("listing_id"))
    _replace(tables, {"order_items": _declared(batch.unionByName(moved), "order_items")})
    return tables.read(schemas.ORDER_ITEMS)


def _snapshot_twice(m) -> store.TableStore:
    """Documents built, a small load, and documents brought up to date."""
    tables = _published(m, *schemas.TABLES)
    jobs.snapshot_orders(m.spark, tables.root)
    tables.refresh()
    _replace(tables, _small_load(m))
    return tables


@query
def changed_orders(m):
    """The orders that a small load touches: by themselves, or through a listing they hold."""
    tables = _snapshot_twice(m)
    return jobs.changed_orders(tables, tables.current.built_from)


@query
def snapshot_incremental(m):
    """All documents after only the changed orders were built again."""
    tables = _snapshot_twice(m)
    jobs.snapshot_orders(m.spark, tables.root)
    tables.refresh()
    return _written_out(tables.read_documents())


@query
def history_by_status(m):
    """Write the log by status, read one status back from its folder alone."""
    path = _new_folder(m, "history_by_status")
    store.write_table(m.history, schemas.STATUS_HISTORY, path)
    return m.spark.read.parquet(path).filter("order_status = 'DELIVERED'")


#: The stretch of time asked for.
SPAN = ("1995-03-10", "1995-07-01")


def _log_by_month(m) -> str:
    path = _new_folder(m, "log_by_month")
    layouts.write_log_by_month(m.history, path)
    return path


@query
def history_by_month(m):
    """Write the log by status and month, read a stretch of time from its folders alone."""
    return layouts.read_log(m.spark, _log_by_month(m), *SPAN)


@query
def mom_growth_of_a_span(m):
    """Growth over the deliveries of a stretch of time."""
    log = layouts.read_log(m.spark, _log_by_month(m), *SPAN)
    return revenue.mom_growth(m.items, log).withColumn(
        "mom_growth_ratio", F.col("mom_growth_ratio").cast("double")
    )


@query
def listings_by_category(m):
    """Write the catalogue by category and seller, read one seller's listings of one kind."""
    path = _new_folder(m, "catalogue")
    layouts.write_catalogue(m.listings, path)
    return layouts.read_catalogue(m.spark, path, seller_id="Brand#13")


# --- text repair and parsing ------------------------------------------------------------------


def _repaired_customers(m):
    return text.repair_line(
        dirty.customer_lines(m), "line", CUSTOMER_COLUMNS, cleaning.CUSTOMER_DATE_INDEX
    )


def _repaired_listings(m):
    return text.repair_line(
        dirty.listing_lines(m), "line", LISTING_COLUMNS, cleaning.LISTING_DATE_INDEX
    )


@query
def repair_customer_rows(m):
    return _repaired_customers(m)


@query
def repair_listing_rows(m):
    return _repaired_listings(m)


@query
def normalize_cells(m):
    return text.normalize_cells(_repaired_customers(m)).drop("field_count")


@query
def clean_customers(m):
    return cleaning.clean_customers(_repaired_customers(m)).drop("field_count")


@query
def clean_listings(m):
    return cleaning.clean_listings(_repaired_listings(m)).drop("field_count")


@query
def clean_orders(m):
    raw = dirty.raw_events(m).withColumn(lines.FILE_ORDER, F.monotonically_increasing_id())
    cleaned = _written(m, "clean_orders", cleaning.clean_orders(raw, sort=False))
    return cleaning.sort_events(cleaned).drop(lines.FILE_ORDER)


def _set_aside(m, judged: DataFrame) -> DataFrame:
    """As the job does it: the judged rows are written once, and both outputs read from there."""
    return cleaning.quarantined(_written(m, "judged", judged)).drop("field_count")


@query
def quarantine_customers(m):
    """Rows with cells that could not be read, as text, with the reasons."""
    return _set_aside(m, cleaning.judge(_repaired_customers(m), cleaning.CUSTOMER_RULES))


@query
def quarantine_listings(m):
    return _set_aside(m, cleaning.judge(_repaired_listings(m), cleaning.LISTING_RULES))


@query
def quarantine_orders(m):
    return _set_aside(m, cleaning.judge(dirty.raw_events(m), cleaning.EVENT_RULES, quotes=False))


@query
def cleaning_counts(m):
    """What the pass over each feed counts: rows, repaired lines, rows set aside, cells by reason."""
    feeds = {
        "customers": (cleaning.judge(_repaired_customers(m), cleaning.CUSTOMER_RULES), 6),
        "listings": (cleaning.judge(_repaired_listings(m), cleaning.LISTING_RULES), 7),
        "orders": (cleaning.judge(dirty.raw_events(m), cleaning.EVENT_RULES, quotes=False), None),
    }
    frames = []
    for name, (judged, width) in feeds.items():
        counts = cleaning.judgement_counts(judged, width)
        row = judged.agg(*(count.alias(what) for what, count in counts.items()))
        frames.append(
            row.unpivot([], list(counts), "counted", "rows").select(F.lit(name).alias("feed"), "counted", "rows")
        )
    return audit.union_all(frames)


@query
def parse_mixed_date(m):
    shown = F.expr(dirty.date_text("o_orderdate", "o_orderkey"))
    return m.table("orders").select(
        F.col("o_orderkey").alias("order_id"),
        temporal.parse_mixed_date(shown).alias("parsed"),
    )


@query
def parse_mixed_datetime(m):
    shown = F.expr(dirty.datetime_text("event_timestamp", "order_id"))
    return m.events.select(
        "order_id",
        "listing_id",
        "order_status",
        temporal.parse_mixed_datetime(shown).alias("parsed"),
    )


@query
def normalize_status(m):
    shown = F.expr(dirty.status_text("order_status", "listing_id"))
    return m.events.select(
        "order_id", "listing_id", "event_timestamp", status.normalize_status(shown).alias("status")
    )


@query
def parse_price(m):
    shown = F.concat(F.lit(' "$'), F.format_number("l_extendedprice", 2), F.lit(' " '))
    return m.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        numeric.parse_price(text.clean_cell(shown)).alias("price"),
    )


@query
def coerce_numeric(m):
    shown = F.expr(dirty.quantity_text("cast(l_quantity AS int)", "(l_orderkey + l_linenumber)"))
    return m.table("lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        numeric.to_number(shown).alias("number"),
        numeric.to_whole_number(shown).alias("whole_number"),
        numeric.to_quantity(shown).alias("quantity"),
    )


# --- normalisation ----------------------------------------------------------------------------


@query
def normalize_orders(m):
    return normalize.normalize_orders(normalize.typed_events(m.events))


@query
def normalize_order_items(m):
    return normalize.normalize_order_items(normalize.typed_events(m.events), ["order_status"])


@query
def normalize_history(m):
    return normalize.normalize_history(normalize.typed_events(m.events))


@query
def split_dirty_events(m):
    """The dirty feed cleaned and split: quantity and price of every item's newest event."""
    events = cleaning.clean_orders(dirty.raw_events(m), sort=False)
    return normalize.normalize_order_items(normalize.typed_events(events))


# --- analytics --------------------------------------------------------------------------------


@query
def delivered_items(m):
    return m.items.join(revenue.delivered_items(m.history), revenue.ITEM_KEY, "left_semi")


@query
def seller_category_revenue(m):
    return revenue.seller_category_revenue(m.items, m.history, m.listings)


@query
def ranked_sellers(m):
    return revenue.ranked_sellers(
        revenue.seller_category_revenue(m.items, m.history, m.listings)
    )


@query
def top_sellers(m):
    return revenue.top_sellers(m.items, m.history, m.listings)


@query
def top5_sellers(m):
    return revenue.top_sellers(m.items, m.history, m.listings, x=5)


@query
def category_revenue_ci(m):
    """Listings spell their category in mixed case; one group per category results."""
    listings = m.listings.withColumn(
        "category", F.expr("IF(listing_id % 2 = 0, category, initcap(category))")
    )
    return revenue.category_revenue_ci(m.items, m.history, listings).withColumn(
        "category", F.upper("category")
    )


@query
def item_milestones(m):
    return lifecycle.item_milestones(m.history)


@query
def avg_placed_to_shipped(m):
    return lifecycle.avg_placed_to_shipped(m.history)


@query
def monthly_revenue(m):
    return revenue.monthly_revenue(m.items, m.history)


@query
def mom_growth(m):
    return revenue.mom_growth(m.items, m.history).withColumn(
        "mom_growth_ratio", F.col("mom_growth_ratio").cast("double")
    )


# --- documents --------------------------------------------------------------------------------


def _documents(m):
    return documents.order_snapshot(m.orders, m.items, m.listings, m.history)


@query
def order_items_enriched(m):
    return documents.enrich_items(m.items, m.listings).drop("amount")


def _item_columns() -> list[Column]:
    return [
        F.col("item.listing_id").alias("listing_id"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.extended_price").alias("extended_price"),
        F.col("item.product.name").alias("product_name"),
        F.col("item.product.category").alias("category"),
        F.col("item.product.seller_id").alias("seller_id"),
        F.col("item.product.price_at_purchase").alias("price_at_purchase"),
    ]


def _unrolled_items(arrays: DataFrame) -> DataFrame:
    """One row per array element, with its position in the order."""
    elements = arrays.select("order_id", F.posexplode("items").alias("position", "item"))
    return elements.select("order_id", "position", *_item_columns())


@query
def order_items_array(m):
    """The item arrays, unrolled again."""
    return _unrolled_items(documents.order_items_array(m.items, m.listings))


@query
def order_item_positions(m):
    """The same rows ranked by ranges of (order, listing), without any array."""
    ranked = documents.item_positions(
        m.items, m.listings, lambda df: _written(m, "item_positions", df)
    )
    return ranked.select("order_id", F.col("position").cast("int").alias("position"), *_item_columns())


@query
def order_milestones(m):
    return lifecycle.order_milestones(m.history).withColumns(
        {name: temporal.iso_utc(F.col(name)) for name in lifecycle.MILESTONES}
    )


@query
def order_current_status(m):
    return lifecycle.order_current_status(m.history)


@query
def order_metrics(m):
    return lifecycle.order_metrics(m.history)


@query
def order_payment(m):
    return documents.order_payment(m.items)


def _unrolled_timeline(df: DataFrame, steps: Column) -> DataFrame:
    return df.select("order_id", F.posexplode(steps).alias("position", "step")).select(
        "order_id", "position", "step.status", "step.at"
    )


@query
def status_timeline(m):
    """The timeline arrays, unrolled again."""
    return _unrolled_timeline(order_milestones(m), lifecycle.timeline())


def _written_out(docs: DataFrame) -> DataFrame:
    """Documents without the time they were taken, nested parts written out as text."""
    money = "decimal(20,2)"

    def item(i: Column) -> Column:
        product = i["product"]
        return F.concat_ws(
            "|",
            i["listing_id"],
            i["quantity"].cast("string"),
            i["extended_price"].cast(money).cast("string"),
            product["name"],
            product["category"],
            product["seller_id"],
            product["price_at_purchase"].cast(money).cast("string"),
        )

    def step(s: Column) -> Column:
        return F.concat_ws("|", s["status"], s["at"])

    return docs.select(
        "_id",
        "order_id",
        "customer.customer_id",
        F.array_join(F.transform("items", item), ";").alias("items"),
        F.array_join(F.transform("status_timeline", step), ";").alias("status_timeline"),
        "current_status",
        *lifecycle.MILESTONES,
        "payment.currency",
        "payment.subtotal",
        "payment.total",
        "metrics.hours_to_ship",
        "metrics.hours_to_deliver",
        "audit.source",
    )


@query
def order_snapshot(m):
    """Whole documents."""
    return _written_out(_documents(m))


@query
def order_snapshot_items(m):
    """The items inside the finished documents."""
    return _unrolled_items(_documents(m))


@query
def order_snapshot_timeline(m):
    """The timelines inside the finished documents."""
    return _unrolled_timeline(_documents(m), F.col("status_timeline"))


@query
def order_snapshot_flat(m):
    return documents.flatten(_documents(m))


@query
def order_lookup(m):
    return documents.flatten(
        documents.order_document(LOOKUP_ORDER, m.orders, m.items, m.listings, m.history)
    )


@query
def customer_orders(m):
    theirs = m.orders.filter(F.col("customer_id") == LOOKUP_CUSTOMER)
    found = documents.documents_of(theirs, m.items, m.listings, m.history)
    return documents.flatten(documents.customer_orders(found, LOOKUP_CUSTOMER))


@query
def orders_by_status(m):
    return documents.flatten(documents.orders_by_status(_documents(m), status.DELIVERED))


# --- audits -----------------------------------------------------------------------------------


def _five(m, history=None):
    return dict(
        zip(schemas.TABLES, (m.customers, m.listings, m.orders, m.items, history or m.history))
    )


@query
def table_counts(m):
    return audit.table_counts({**_five(m), "documents": _documents(m)})


@query
def audit_pk(m):
    """The raw log is audited too: it holds several events per item and time."""
    return audit.union_all(
        audit.audit_pk(df, schemas.TABLES[name]) for name, df in _five(m).items()
    )


@query
def audit_fk(m):
    """References that would break if indebted customers, large listings and closed orders
    were gone."""
    five = _five(m)
    balance = m.table("customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
    open_orders = m.table("orders").filter("o_orderstatus <> 'F'")
    parents = {
        "customers": balance.filter("c_acctbal >= 0"),
        "listings": m.listings.filter("stock_quantity <= 45"),
        "orders": open_orders.select(F.col("o_orderkey").alias("order_id")),
        "order_items": m.items.filter("quantity > 1"),
    }
    return audit.union_all(
        audit.audit_fk(five[t.name], parents[ref.parent], t, ref)
        for t in schemas.TABLES.values()
        for ref in t.references
    )


@query
def audit_nulls(m):
    """All five tables; the order tables lose some of their values first."""
    finished = F.col("order_status") != "CANCELLED"
    return audit.union_all(
        [
            audit.audit_nulls(clean_customers(m), schemas.CUSTOMERS),
            audit.audit_nulls(clean_listings(m), schemas.LISTINGS),
            audit.audit_nulls(
                m.orders.withColumn("customer_id", F.expr("nullif(customer_id % 5, 0)")),
                schemas.ORDERS,
            ),
            audit.audit_nulls(
                m.items.withColumn("quantity", F.expr("nullif(quantity, 7)")), schemas.ORDER_ITEMS
            ),
            audit.audit_nulls(
                m.history.withColumn("order_status", F.when(finished, F.col("order_status"))),
                schemas.STATUS_HISTORY,
            ),
        ]
    )


@query
def audit_domain(m):
    """Widths and types of the repaired but uncleaned text of all five tables."""
    events = text.normalize_cells(dirty.raw_events(m), quotes=False)
    padded = F.concat(F.lit("customer-"), F.lpad(F.col("customer_id").cast("string"), 9, "0"))
    at = F.expr("if(order_id % 7 = 0, 'soon', cast(event_timestamp AS string))")
    log = m.events.withColumn("status_timestamp", at)
    return audit.union_all(
        [
            audit.audit_domain(normalize_cells(m), schemas.CUSTOMERS),
            audit.audit_domain(
                text.normalize_cells(_repaired_listings(m)).drop("field_count"), schemas.LISTINGS
            ),
            audit.audit_domain(
                m.orders.withColumn("customer_id", padded), schemas.ORDERS
            ),
            audit.audit_domain(
                events.select("order_id", "listing_id", "quantity", "price_at_purchase"),
                schemas.ORDER_ITEMS,
            ),
            audit.audit_domain(
                log.select("order_id", "listing_id", "status_timestamp", "order_status"),
                schemas.STATUS_HISTORY,
            ),
        ]
    )


@query
def judge_rows(m):
    """Every cleaned customer with the rules it breaks, if any."""
    return audit.judge(clean_customers(m), schemas.CUSTOMERS)


@query
def cascade_delete(m):
    """What is left of the order tables once finished orders are deleted."""
    doomed = m.table("orders").filter("o_orderstatus = 'F'")
    left = audit.cascade_delete(
        m.orders, m.items, m.history, doomed.select(F.col("o_orderkey").alias("order_id"))
    )
    names = ("orders", "order_items", "order_item_status_history")
    return audit.union_all(
        df.agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("rows"),
            F.sum("order_id").alias("order_id_sum"),
        )
        for name, df in zip(names, left)
    )


@query
def audit_restrict(m):
    """Deletes that must be refused: customers with orders and listings with items."""
    indebted = m.table("customer").filter("c_acctbal < 0")
    large = m.listings.filter("stock_quantity > 45")
    blocked = (
        ("customers", "customer_id", m.orders,
         indebted.select(F.col("c_custkey").alias("customer_id"))),
        ("listings", "listing_id", m.items, large),
    )
    return audit.union_all(
        audit.blocked_deletes(doomed, child, [key]).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), "rows"
        )
        for name, key, child, doomed in blocked
    )


@query
def audit_restrict_updates(m):
    """Key changes that must be refused: renumbered customers with orders, listings with items."""
    customers = m.customers.withColumn("new_id", F.expr("customer_id + customer_id % 3"))
    listings = m.listings.withColumn("new_id", F.expr("if(stock_quantity > 40, 0, listing_id)"))
    blocked = (
        ("customers", "customer_id", m.orders, customers),
        ("listings", "listing_id", m.items, listings),
    )
    return audit.union_all(
        audit.blocked_key_updates(changes, child, key, "new_id").select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), "rows"
        )
        for name, key, child, changes in blocked
    )
