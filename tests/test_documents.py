"""Documents against a brute-force builder, and lookups."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from orderloom.operators import documents, upsert
from orderloom.schemas import DOCUMENT, LISTINGS, ORDER_ITEMS, ORDERS, STATUS_HISTORY

STATUSES = ["PLACED", "SHIPPED", "DELIVERED", "CANCELLED"]
RANK = {s: i for i, s in enumerate(["UNKNOWN", *STATUSES])}


def random_shop(seed, n_orders=40, hot_items=0):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    names = [f"L{i:04}" for i in range(max(30, hot_items))]
    listings = [
        (n, f"product {n}", "CAT", f"s{i % 3}", Decimal("1.00"), 1, dt.date(2024, 1, 1))
        for i, n in enumerate(names)
    ]
    orders, items, history = [], [], []
    for o in range(1, n_orders + 1):
        orders.append((o, f"c{rng.randint(1, 9)}"))
        count = hot_items if o == 1 and hot_items else rng.randint(0, 5)
        for name in [*rng.sample(names, count), *(["gone"] if o % 7 == 0 else [])]:
            items.append((o, name, rng.randint(0, 4), Decimal(rng.randint(0, 9999)) / 100))
            for at in rng.sample(range(2000), rng.randint(0, 3)):
                history.append((o, name, start + dt.timedelta(minutes=at), rng.choice(STATUSES)))
    history = list({h[:3]: h for h in history}.values())
    return orders, items, listings, history


def frames(spark, shop):
    tables = (ORDERS, ORDER_ITEMS, LISTINGS, STATUS_HISTORY)
    return [spark.createDataFrame(data, t.struct) for data, t in zip(shop, tables)]


def expected(shop):
    """One plain dict per order, built by looking at every row."""
    orders, items, listings, history = shop
    products = {l[0]: {"name": l[1], "category": l[2], "seller_id": l[3]} for l in listings}
    nothing = {"name": None, "category": None, "seller_id": None}
    result = {}
    for order_id, customer_id in orders:
        lines = []
        total = Decimal(0)
        for o, listing, quantity, price in sorted(items):
            if o == order_id:
                total += quantity * price
                product = {**products.get(listing, nothing), "price_at_purchase": float(price)}
                lines.append(
                    {
                        "listing_id": listing,
                        "quantity": quantity,
                        "extended_price": float(quantity * price),
                        "product": product,
                    }
                )
        log = [h for h in history if h[0] == order_id]
        first = {s: min((h[2] for h in log if h[3] == s), default=None) for s in STATUSES}
        shown = {s: t and t.isoformat() + "+00:00" for s, t in first.items()}

        def hours(end):
            if first["PLACED"] is None or first[end] is None:
                return None
            return pytest.approx((first[end] - first["PLACED"]).total_seconds() / 3600)

        newest = max(log, key=lambda h: (h[2], RANK[h[3]], h[1]), default=(None,) * 4)
        result[str(order_id)] = {
            "_id": str(order_id),
            "order_id": str(order_id),
            "customer": {"customer_id": customer_id},
            "items": lines,
            "status_timeline": [
                {"status": s, "at": shown[s]} for s in STATUSES[:3] if shown[s] is not None
            ],
            "current_status": newest[3],
            "placed_at": shown["PLACED"],
            "shipped_at": shown["SHIPPED"],
            "delivered_at": shown["DELIVERED"],
            "payment": {"currency": "SGD", "subtotal": float(total), "total": float(total)},
            "metrics": {"hours_to_ship": hours("SHIPPED"), "hours_to_deliver": hours("DELIVERED")},
        }
    return result


def as_dicts(df):
    found = {}
    for row in df.collect():
        doc = row.asDict(recursive=True)
        assert doc["audit"].pop("snapshot_ts").endswith("+00:00")
        assert doc.pop("audit") == {"source": "mysql-snapshot"}
        assert doc["_id"] not in found
        found[doc["_id"]] = doc
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_documents_match_brute_force(spark, seed):
    shop = random_shop(seed)
    assert as_dicts(documents.order_snapshot(*frames(spark, shop))) == expected(shop)


def test_document_type(spark):
    docs = documents.order_snapshot(*frames(spark, random_shop(1, n_orders=2)))
    assert docs.schema.simpleString() == DOCUMENT.simpleString()


def test_crowded_orders_are_one_document(spark):
    shop = random_shop(3, hot_items=300)
    docs = documents.order_snapshot(*frames(spark, shop))
    want = expected(shop)
    assert as_dicts(docs) == want
    flat = {r._id: (r.item_count, r.subtotal) for r in documents.flatten(docs).collect()}
    assert flat == {k: (len(d["items"]), d["payment"]["subtotal"]) for k, d in want.items()}


def test_snapshot_counters(spark):
    shop = random_shop(7, hot_items=90)
    orders, items, listings, history = shop
    changed = [(o, n, q + (o == 1 and n == items[0][1]), p) for o, n, q, p in items]
    fresh = ([*orders, (99, "c1")], changed, listings, history)
    old, new = (documents.order_snapshot(*frames(spark, s)).drop("audit") for s in (shop, fresh))
    row = upsert.snapshot_metrics(old, new).first()
    assert (row.batch_keys, row.inserted, row.matched, row.modified) == (41, 1, 40, 1)
    vanished = upsert.snapshot_metrics(new, old).first()
    assert (vanished.batch_keys, vanished.inserted, vanished.matched) == (40, 0, 40)


def test_no_job_runs_while_documents_are_planned(spark):
    tables = frames(spark, random_shop(1, n_orders=3))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    try:
        documents.order_snapshot(*tables)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_items_of_missing_orders_make_no_documents(spark):
    orders, items, listings, history = random_shop(4, hot_items=100)
    shop = ([o for o in orders if o[0] != 1], items, listings, history)
    found = as_dicts(documents.order_snapshot(*frames(spark, shop)))
    assert found == expected(shop)


def test_lookups(spark):
    shop = random_shop(5)
    orders, items, listings, history = frames(spark, shop)
    docs = documents.order_snapshot(orders, items, listings, history)
    want = expected(shop)
    assert as_dicts(documents.order_lookup(docs, 7)) == {"7": want["7"]}
    assert as_dicts(documents.order_document(7, orders, items, listings, history)) == {"7": want["7"]}
    theirs = [r._id for r in documents.customer_orders(docs, "c1").collect()]
    assert sorted(theirs) == sorted(k for k, d in want.items() if d["customer"]["customer_id"] == "c1")
    deliveries = [want[i]["delivered_at"] or "" for i in theirs]
    assert deliveries == sorted(deliveries, reverse=True)
    few = documents.documents_of(orders.filter("customer_id = 'c1'"), items, listings, history)
    assert sorted(as_dicts(few)) == sorted(theirs)
    delivered = [r._id for r in documents.orders_by_status(docs, "DELIVERED").collect()]
    assert sorted(delivered) == sorted(k for k, d in want.items() if d["current_status"] == "DELIVERED")


def test_snapshot_upsert_keeps_vanished_orders(spark):
    schema = "_id string, order_id string, v int"
    stored = spark.createDataFrame([("1", "1", 0), ("2", "2", 0)], schema)
    fresh = spark.createDataFrame([("1", "1", 9), ("3", "3", 9)], schema)
    merged = upsert.snapshot_upsert(stored, fresh)
    assert sorted((r._id, r.v) for r in merged.collect()) == [("1", 9), ("2", 0), ("3", 9)]
