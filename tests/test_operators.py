import datetime as dt
from decimal import Decimal

import pytest

from orderloom import schemas
from orderloom.operators import audit, cleaning, lifecycle, normalize, ranking, revenue, upsert

EVENTS = (
    "order_id string, customer_id string, listing_id string, quantity string, "
    "price_at_purchase string, event_timestamp string, order_status string"
)
HISTORY = "order_id int, listing_id string, status_timestamp timestamp_ntz, order_status string"
ITEMS = "order_id int, listing_id string, quantity int, price_at_purchase decimal(10,2)"


def at(text):
    return dt.datetime.fromisoformat(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def history(spark, *events):
    return spark.createDataFrame([(o, l, at(t) if t else None, s) for o, l, t, s in events], HISTORY)


def items(spark, *data):
    return spark.createDataFrame([(o, l, q, Decimal(p)) for o, l, q, p in data], ITEMS)


# --- cleaning ---------------------------------------------------------------------------------


def test_clean_customers(spark):
    raw = spark.createDataFrame(
        [("c1", " Ann ", "Na", "", "Mar 05 2023", " kuala lumpur"), ("c2", "Bo", "X", "e", "soon", "nan")],
        ["customer_id", "first_name", "last_name", "email", "join_date", "city"],
    )
    assert rows(cleaning.clean_customers(raw)) == [
        ("c1", "Ann", None, None, "2023-03-05", "KUALA LUMPUR"),
        ("c2", "Bo", "X", "e", None, None),
    ]


def test_clean_listings(spark):
    raw = spark.createDataFrame(
        [("L1", 'Monitor 27"', '" Home "', " s ", '" $25.00 "', "2.5", "01/02/2023")],
        ["listing_id", "product_name", "category", "seller_id", "price", "stock_quantity", "listing_date"],
    )
    assert rows(cleaning.clean_listings(raw)) == [
        ("L1", "Monitor 27", "HOME", "s", 25.0, None, "2023-01-02")
    ]


def test_clean_orders_sorts_text_keys_with_null_times_last(spark):
    raw = spark.createDataFrame(
        [
            ("9", "c", "L1", "1", "2.5", "2024-01-01 00:00:00", "placed"),
            ("10", "c", "L1", "1", "x", "bad", "shiped"),
            ("10", "c", "L1", "1.5", "2", "01/02/2024 03:04:05", "delvd"),
        ],
        EVENTS,
    )
    cleaned = [tuple(r) for r in cleaning.clean_orders(raw).collect()]
    assert cleaned == [
        ("10", "c", "L1", None, 2.0, "2024-01-02 03:04:05", "UNKNOWN"),
        ("10", "c", "L1", 1, None, None, "SHIPPED"),
        ("9", "c", "L1", 1, 2.5, "2024-01-01 00:00:00", "PLACED"),
    ]


def test_cleaning_tolerates_absent_optional_columns(spark):
    raw = spark.createDataFrame([(" 1 ", "placed")], ["order_id", "order_status"])
    assert rows(cleaning.clean_orders(raw)) == [("1", "PLACED")]


# --- normalisation ----------------------------------------------------------------------------


def test_last_event_wins_and_undated_events_count_as_newest(spark):
    events = normalize.typed_events(
        spark.createDataFrame(
            [
                ("1", "c", "A", "1", "1.00", "2024-01-01 00:00:00", "PLACED"),
                ("1", "c", "A", "2.9", "2.00", "2024-01-02 00:00:00", "SHIPPED"),
                ("1", "c", "B", "5", "5.00", None, "PLACED"),
                ("1", "c", "B", "6", "6.00", "2024-01-02 00:00:00", "SHIPPED"),
                ("2", "d", "A", "abc", "x", "2024-01-01 00:00:00", "PLACED"),
            ],
            EVENTS,
        )
    )
    assert rows(normalize.normalize_order_items(events)) == [
        ("1", "A", 2, Decimal("2.00")),
        ("1", "B", 5, Decimal("5.00")),
        ("2", "A", 0, None),
    ]
    assert rows(normalize.normalize_orders(events)) == [("1", "c"), ("2", "d")]
    assert normalize.status_log(events).count() == 5


def test_ties_follow_the_given_order(spark):
    events = spark.createDataFrame(
        [("1", "A", 9, 1.0, None, "PLACED", 1), ("1", "A", 2, 1.0, None, "SHIPPED", 2)],
        "order_id string, listing_id string, quantity int, price_at_purchase double, "
        "event_timestamp timestamp_ntz, order_status string, seq int",
    )
    assert rows(normalize.normalize_order_items(events, ["seq"])) == [("1", "A", 2, 1.0)]
    assert rows(normalize.normalize_history(events, ["seq"])) == [("1", "A", None, "SHIPPED")]


# --- upsert -----------------------------------------------------------------------------------


def test_upsert_replaces_whole_rows(spark):
    stored = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "z")], "k int, v string, w string")
    batch = spark.createDataFrame(
        [(2, "B", None, 2), (2, "b1", "y1", 1), (4, "d", "q", 1), (3, "c", "z", 1)],
        "k int, v string, w string, seq int",
    )
    assert rows(upsert.upsert(stored, batch, ["k"], ["seq"])) == [
        (1, "a", "x"), (2, "B", None), (3, "c", "z"), (4, "d", "q"),
    ]
    metrics = upsert.upsert_metrics(stored, batch, ["k"], ["seq"]).first()
    assert tuple(metrics) == (3, 1, 2, 1)


def test_upsert_of_key_only_table(spark):
    stored = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(upsert.upsert(stored, spark.createDataFrame([(2,), (2,), (3,)], "k int"), ["k"])) == [
        (1,), (2,), (3,),
    ]


def test_empty_batch_metrics(spark):
    stored = spark.createDataFrame([(1, "a")], "k int, v string")
    assert tuple(upsert.upsert_metrics(stored, stored.limit(0), ["k"]).first()) == (0, 0, 0, 0)


# --- audits -----------------------------------------------------------------------------------


def test_keys_and_references(spark):
    parent = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    child = spark.createDataFrame(
        [(1, "c1"), (2, "c9"), (3, "c9"), (4, None), (1, "c1")], "order_id int, customer_id string"
    )
    assert rows(audit.audit_pk(child, schemas.ORDERS)) == [("orders", 1, 1)]
    found = audit.audit_fk(child, parent, schemas.ORDERS, schemas.ORDERS.references[0])
    assert rows(found) == [("orders", "customers", 1, 2)]
    assert rows(audit.blocked_deletes(parent, child, ["customer_id"])) == [("c1", 2)]


def test_key_updates_are_blocked_while_referenced(spark):
    child = spark.createDataFrame([(1, "c1")], "order_id int, customer_id string")
    changes = spark.createDataFrame(
        [("c1", "c1"), ("c2", "c3")], "customer_id string, new_id string"
    )
    assert rows(audit.blocked_key_updates(changes, child, "customer_id", "new_id")) == []
    moved = spark.createDataFrame([("c1", "c4")], "customer_id string, new_id string")
    assert rows(audit.blocked_key_updates(moved, child, "customer_id", "new_id")) == [("c1", 1)]


def test_column_rules_split_rows(spark):
    raw = spark.createDataFrame(
        [
            ("L1", "n", "c", "s", "12.345", "7", "2024-01-01", "a"),
            ("L2", "n" * 256, "c", "s", "1", "7", "2024-01-01", "b"),
            ("L3", "n", None, "s", "123456789.00", "7.5", "2024-02-30", "c"),
            ("L4", "", "", "", "", "99999999999", "", "d"),
        ],
        [*schemas.LISTINGS.columns, "tag"],
    )
    valid, rejected = audit.split_valid(audit.judge(raw, schemas.LISTINGS), schemas.LISTINGS)
    assert rows(valid) == [
        ("L1", "n", "c", "s", Decimal("12.35"), 7, dt.date(2024, 1, 1), "a")
    ]
    reasons = {r.listing_id: r.reject_reasons for r in rejected.collect()}
    assert reasons == {
        "L2": "product_name:too_long",
        "L3": "category:missing,price:not_decimal(10,2),stock_quantity:not_int,listing_date:not_date",
        "L4": "price:missing,stock_quantity:not_int,listing_date:missing",
    }
    bad = {(r.column_name, r.rule): r.bad_rows for r in audit.audit_domain(raw, schemas.LISTINGS).collect()}
    assert bad[("stock_quantity", "not_int")] == 2 and bad[("product_name", "too_long")] == 1
    nulls = {r.column_name: r.null_rows for r in audit.audit_nulls(raw, schemas.LISTINGS).collect()}
    assert nulls["category"] == 1 and nulls["price"] == 0


def test_cascade(spark):
    orders = spark.createDataFrame([(1, "c"), (2, "c")], "order_id int, customer_id string")
    left = audit.cascade_delete(
        orders,
        items(spark, (1, "A", 1, "1"), (2, "A", 1, "1")),
        history(spark, (1, "A", "2024-01-01", "PLACED"), (2, "A", "2024-01-01", "PLACED")),
        spark.createDataFrame([(1,), (1,)], "order_id int"),
    )
    assert [[r.order_id for r in df.collect()] for df in left] == [[2], [2], [2]]


# --- analytics --------------------------------------------------------------------------------


@pytest.fixture
def shop(spark):
    sold = items(
        spark,
        (1, "A", 2, "10.00"),
        (1, "B", 1, "20.00"),
        (2, "A", 1, "10.00"),
        (3, "C", 1, "5.00"),
        (4, "D", 1, "99.00"),
    )
    log = history(
        spark,
        (1, "A", "2024-01-05", "DELIVERED"),
        (1, "A", "2024-02-05", "DELIVERED"),
        (1, "B", "2024-01-31T23:59:59", "DELIVERED"),
        (2, "A", "2024-03-01", "DELIVERED"),
        (2, "A", "2024-03-02", "CANCELLED"),
        (3, "C", "2024-06-01", "SHIPPED"),
        (4, "D", "2024-06-01", "DELIVERED"),
    )
    catalogue = spark.createDataFrame(
        [("A", "Tech", "s2"), ("B", "tech", "s1"), ("C", "Tech", "s3")],
        "listing_id string, category string, seller_id string",
    )
    return sold, log, catalogue


def test_revenue_counts_items_ever_delivered_and_known_listings(shop):
    assert rows(revenue.seller_category_revenue(*shop)) == [
        ("Tech", "s2", Decimal("30.00")),
        ("tech", "s1", Decimal("20.00")),
    ]
    assert rows(revenue.category_revenue_ci(*shop)) == [("Tech", Decimal("50.00"))]


def test_ties_rank_by_seller(spark):
    tied = spark.createDataFrame(
        [("T", "s2", Decimal(5)), ("T", "s1", Decimal(5)), ("T", "s3", Decimal(9))],
        "category string, seller_id string, revenue decimal(38,2)",
    )
    assert [(r.seller_id, r.rn) for r in revenue.ranked_sellers(tied, 2).orderBy("rn").collect()] == [
        ("s3", 1), ("s1", 2),
    ]


def test_growth_over_present_months(shop):
    sold, log, _ = shop
    assert [tuple(r) for r in revenue.mom_growth(sold, log).collect()] == [
        ("2024-01-01", Decimal("40.00"), None, None),
        ("2024-03-01", Decimal("10.00"), Decimal("40.00"), Decimal("-0.750000")),
        ("2024-06-01", Decimal("99.00"), Decimal("10.00"), Decimal("8.900000")),
    ]


def test_growth_after_a_month_without_revenue_is_null(spark):
    sold = items(spark, (1, "A", 0, "1"), (2, "A", 1, "1"))
    log = history(spark, (1, "A", "2024-01-01", "DELIVERED"), (2, "A", "2024-02-01", "DELIVERED"))
    assert [r.mom_growth_ratio for r in revenue.mom_growth(sold, log).collect()] == [None, None]


def test_placed_to_shipped(spark):
    log = history(
        spark,
        (1, "A", "2024-01-01T00:00:00", "PLACED"),
        (1, "A", "2024-01-03T00:00:00", "PLACED"),
        (1, "A", "2024-01-01T01:59:59", "SHIPPED"),
        (1, "B", "2024-01-01T00:00:00", "PLACED"),
        (1, "B", "2024-01-01T04:30:00", "SHIPPED"),
        (2, "A", "2024-01-02T00:00:00", "PLACED"),
        (2, "A", "2024-01-01T00:00:00", "SHIPPED"),
        (3, "A", "2024-01-01T00:00:00", "SHIPPED"),
    )
    assert rows(lifecycle.avg_placed_to_shipped(log)) == [
        (Decimal("2.5000"), Decimal("194.5000"), 2)
    ]
    assert rows(lifecycle.avg_placed_to_shipped(log.limit(0))) == [(None, None, 0)]


def test_current_status(spark):
    log = history(
        spark,
        (1, "A", "2024-01-01", "PLACED"),
        (1, "B", "2024-01-02", "DELIVERED"),
        (1, "A", "2024-01-02", "SHIPPED"),
        (2, "A", None, "PLACED"),
        (2, "A", "2024-01-02", "SHIPPED"),
    )
    assert rows(lifecycle.order_current_status(log)) == [(1, "DELIVERED"), (2, "PLACED")]


def test_ranks_are_numbered_by_the_write_that_sorts(spark, tmp_path):
    frame = spark.createDataFrame([(i % 3, (i * 37) % 101) for i in range(101)], "k int, v int")
    written = []

    def write(df):
        path = str(tmp_path / f"ranks-{len(written)}")
        df.write.parquet(path)
        written.append(spark.read.parquet(path))
        return written[-1]

    found = rows(ranking.ranks(frame, ["k", "v"], "rank", write))
    expected = sorted((i % 3, (i * 37) % 101) for i in range(101))
    assert found == sorted(((*row, i) for i, row in enumerate(expected)), key=str)
    assert len(written) == 1 and "rank" in written[0].columns
