"""SQL twins of the named queries, in the DuckDB dialect, for value-by-value comparison.

They state the expected result on their own terms (windows, joins, list functions) rather than
following the DataFrame plans.
"""

from __future__ import annotations

import re

from orderloom.plans.queries import LOOKUP_CUSTOMER, LOOKUP_ORDER, SPAN

ORACLES: dict[str, str] = {}

# --- shared relations -------------------------------------------------------------------------

BASE = """
base AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS listing_id,
         CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS price_at_purchase,
         o_orderdate + INTERVAL '1' MINUTE * (l_linenumber * 7 + 13) AS t_placed,
         l_shipdate + INTERVAL '1' MINUTE * (l_suppkey * 61 + 5) AS t_shipped,
         l_linestatus AS ls, l_returnflag AS rf
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
order_events AS (
  SELECT order_id, customer_id, listing_id, quantity, price_at_purchase,
         t_placed AS event_timestamp, 'PLACED' AS order_status FROM base
  UNION ALL SELECT order_id, customer_id, listing_id, quantity, price_at_purchase,
         t_shipped, 'SHIPPED' FROM base WHERE ls = 'F'
  UNION ALL SELECT order_id, customer_id, listing_id, quantity, price_at_purchase,
         t_shipped + INTERVAL '3' DAY, 'DELIVERED' FROM base WHERE rf = 'N'
  UNION ALL SELECT order_id, customer_id, listing_id, quantity, price_at_purchase,
         t_shipped + INTERVAL '1' DAY, 'CANCELLED' FROM base WHERE rf = 'R'),
history AS (
  SELECT order_id, listing_id, event_timestamp AS status_timestamp, order_status
  FROM order_events),
items AS (
  SELECT order_id, listing_id, quantity, price_at_purchase FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, listing_id
      ORDER BY event_timestamp DESC, quantity DESC, price_at_purchase DESC,
               order_status DESC) AS rn
    FROM order_events) z
  WHERE rn = 1),
listings AS (
  SELECT p_partkey AS listing_id, p_name AS product_name, p_type AS category,
         p_brand AS seller_id, CAST(p_retailprice AS DECIMAL(10,2)) AS price,
         p_size AS stock_quantity,
         CAST(DATE '2021-01-01' + CAST(p_partkey % 700 AS INT) AS DATE) AS listing_date
  FROM part),
customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, lower(c_name || '@example.com') AS email,
         CAST(DATE '2020-01-01' + CAST(c_custkey % 1500 AS INT) AS DATE) AS join_date,
         c_mktsegment AS city
  FROM customer),
order_heads AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders)"""

SOLD = """
delivered AS (SELECT DISTINCT order_id, listing_id FROM history WHERE order_status = 'DELIVERED'),
seller_revenue AS (
  SELECT category, seller_id, CAST(SUM(quantity * price_at_purchase) AS DECIMAL(38,2)) AS revenue
  FROM items JOIN delivered USING (order_id, listing_id) JOIN listings USING (listing_id)
  GROUP BY category, seller_id),
ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY category ORDER BY revenue DESC, seller_id) AS rn
  FROM seller_revenue)"""

# An item's last event carries its quantity and price; its month is that of its first delivery.
MONTHLY = """
monthly AS (
  SELECT month_start, CAST(SUM(amount) AS DECIMAL(38,2)) AS monthly_revenue FROM (
    SELECT strftime(MIN(event_timestamp) FILTER (order_status = 'DELIVERED'), '%Y-%m-01')
             AS month_start,
           arg_max(quantity * price_at_purchase,
                   {'at': event_timestamp, 'q': quantity, 'p': price_at_purchase}) AS amount
    FROM order_events GROUP BY order_id, listing_id)
  WHERE month_start IS NOT NULL GROUP BY month_start)"""


def _iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+00:00'"


def _hours(start: str, end: str) -> str:
    return f"(epoch_us({end}) - epoch_us({start})) / 3.6e9"


STAGE = "list_position(['UNKNOWN', 'PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED'], order_status)"

ORDERS_FLAT = f"""
first_times AS (
  SELECT order_id,
         MIN(CASE WHEN order_status = 'PLACED' THEN status_timestamp END) AS placed,
         MIN(CASE WHEN order_status = 'SHIPPED' THEN status_timestamp END) AS shipped,
         MIN(CASE WHEN order_status = 'DELIVERED' THEN status_timestamp END) AS delivered
  FROM history GROUP BY order_id),
newest AS (
  SELECT order_id, order_status AS current_status FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id
      ORDER BY status_timestamp DESC, {STAGE} DESC, listing_id DESC) AS rn FROM history) z
  WHERE rn = 1),
totals AS (
  SELECT order_id, CAST(SUM(quantity * price_at_purchase) AS DECIMAL(38,2)) AS subtotal,
         CAST(COUNT(*) AS INT) AS item_count
  FROM items GROUP BY order_id),
flat AS (
  SELECT CAST(order_id AS VARCHAR) AS _id, CAST(customer_id AS VARCHAR) AS customer_id,
         COALESCE(item_count, 0) AS item_count,
         CAST((placed IS NOT NULL)::INT + (shipped IS NOT NULL)::INT
              + (delivered IS NOT NULL)::INT AS INT) AS timeline_length,
         current_status, {_iso('placed')} AS placed_at, {_iso('shipped')} AS shipped_at,
         {_iso('delivered')} AS delivered_at, 'SGD' AS currency,
         COALESCE(CAST(subtotal AS DOUBLE), 0.0) AS subtotal,
         COALESCE(CAST(subtotal AS DOUBLE), 0.0) AS total,
         {_hours('placed', 'shipped')} AS hours_to_ship,
         {_hours('placed', 'delivered')} AS hours_to_deliver
  FROM order_heads LEFT JOIN totals USING (order_id) LEFT JOIN first_times USING (order_id)
       LEFT JOIN newest USING (order_id))"""


def _oracle(name: str, body: str, *relations: str) -> None:
    ORACLES[name] = (f"WITH {','.join(relations)}\n" if relations else "") + body


# --- scans, layout, upserts -------------------------------------------------------------------

_oracle("scan_orders", "SELECT o_orderkey AS order_id, o_custkey AS customer_id FROM orders")
_oracle("scan_items", "SELECT * FROM items", BASE)
_oracle(
    "scan_listings", "SELECT listing_id, product_name, category, seller_id FROM listings", BASE
)
_oracle(
    "scan_history",
    "SELECT order_id, listing_id, order_status, status_timestamp, COUNT(*) AS rows FROM history GROUP BY ALL",
    BASE,
)


def _upsert(name: str, stored: str, batch: str, keys: str) -> None:
    """Stored rows without a batch key, plus the batch's second version."""
    match = " AND ".join(f"b.{k} = s.{k}" for k in keys.split(", "))
    _oracle(
        name,
        f"""SELECT s.* FROM ({stored}) s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE {match})
            UNION ALL SELECT * FROM batch""",
        BASE,
        f" batch AS ({batch})",
    )


_upsert(
    "upsert_customers",
    "SELECT * FROM customers",
    """SELECT customer_id * 2 AS customer_id, first_name, last_name, CAST(NULL AS VARCHAR) AS email,
              join_date, city || '-2' AS city FROM customers""",
    "customer_id",
)
_upsert(
    "upsert_listings",
    "SELECT * FROM listings",
    """SELECT listing_id * 2 AS listing_id, product_name, category, seller_id,
              CAST(price + 2 AS DECIMAL(10,2)) AS price,
              CAST(stock_quantity + 2 AS INT) AS stock_quantity, listing_date FROM listings""",
    "listing_id",
)
_upsert(
    "upsert_orders",
    "SELECT * FROM order_heads",
    "SELECT order_id * 2 AS order_id, customer_id + 2 AS customer_id FROM order_heads",
    "order_id",
)
_upsert(
    "upsert_order_items",
    "SELECT * FROM items",
    """SELECT order_id * 2 AS order_id, listing_id, quantity + 2 AS quantity,
              CAST(NULL AS DECIMAL(10,2)) AS price_at_purchase FROM items""",
    "order_id, listing_id",
)
_oracle(
    "upsert_status_history",
    """SELECT order_id, listing_id, status_timestamp,
              COALESCE(MAX(order_status) FILTER (fresh), MAX(order_status)) AS order_status
       FROM (SELECT order_id, listing_id, status_timestamp, order_status, false AS fresh FROM history
             UNION ALL SELECT order_id * 2, listing_id, status_timestamp, 'CANCELLED', true FROM history)
       GROUP BY order_id, listing_id, status_timestamp""",
    BASE,
)
_oracle(
    "merge_buckets",
    """SELECT CAST(order_id AS INT) AS order_id, CAST(listing_id AS VARCHAR) AS listing_id,
              CAST(quantity + (order_id % 499 = 0)::INT AS INT) AS quantity, price_at_purchase FROM items
       UNION ALL SELECT CAST(order_id AS INT), CAST(-listing_id AS VARCHAR), quantity, price_at_purchase
       FROM items WHERE order_id % 499 = 0""",
    BASE,
)
_oracle(
    "history_by_month",
    f"SELECT * FROM history WHERE status_timestamp >= '{SPAN[0]}' AND status_timestamp < '{SPAN[1]}'",
    BASE,
)
_oracle("listings_by_category", "SELECT * FROM listings WHERE seller_id = 'Brand#13'", BASE)
_oracle(
    "changed_orders",
    """SELECT CAST(o_orderkey AS INT) AS order_id FROM orders WHERE o_orderkey % 499 = 0
       UNION SELECT CAST(l_orderkey AS INT) FROM lineitem WHERE l_partkey % 701 = 0""",
)

_oracle(
    "upsert_metrics",
    """SELECT COUNT(*) AS batch_keys, COUNT(*) FILTER (s.order_id IS NULL) AS inserted,
              COUNT(s.order_id) AS matched,
              COUNT(*) FILTER (s.order_id IS NOT NULL AND s.customer_id <> b.customer_id)
                AS modified
       FROM (SELECT order_id * 2 AS order_id, customer_id FROM order_heads) b
       LEFT JOIN order_heads s ON s.order_id = b.order_id""",
    BASE,
)

_oracle(
    "snapshot_upsert",
    """SELECT * FROM flat WHERE _id NOT IN (SELECT CAST(order_id * 2 AS VARCHAR) FROM order_heads)
       UNION ALL SELECT * REPLACE (CAST(CAST(_id AS BIGINT) * 2 AS VARCHAR) AS _id,
                                   'CANCELLED' AS current_status) FROM flat""",
    BASE,
    ORDERS_FLAT,
)

_oracle("history_by_status", "SELECT * FROM history WHERE order_status = 'DELIVERED'", BASE)

# --- text repair and parsing ------------------------------------------------------------------


def _date_text(day: str, key: str) -> str:
    return f"""CASE {key} % 4
        WHEN 0 THEN strftime({day}, '%Y-%m-%d') WHEN 1 THEN strftime({day}, '%m/%d/%Y')
        WHEN 2 THEN strftime({day}, '%b %d %Y') ELSE strftime({day}, '%b %d, %Y') END"""


def _datetime_text(ts: str, key: str) -> str:
    return f"""CASE {key} % 8
        WHEN 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S')
        WHEN 1 THEN strftime({ts}, '%m/%d/%Y  %H:%M:%S')
        WHEN 2 THEN strftime({ts}, '%-I:%M %p %b %d, %Y')
        WHEN 3 THEN ' N/A '
        WHEN 4 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || 'Z'
        WHEN 5 THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') || '+00:00'
        WHEN 6 THEN strftime({ts}, '%m/%d/%Y %I:%M %p')
        ELSE strftime({ts}, '%b %d, %Y %-I:%M %p') END"""


def _status_text(status: str, key: str) -> str:
    return f"""CASE {key} % 3
        WHEN 0 THEN {status}
        WHEN 1 THEN CASE {status} WHEN 'PLACED' THEN ' placedd' WHEN 'SHIPPED' THEN 'Shiped'
            WHEN 'DELIVERED' THEN 'deliverd ' ELSE 'Canceld' END
        ELSE CASE {status} WHEN 'PLACED' THEN 'replaced' WHEN 'SHIPPED' THEN 'SHIPPD'
            WHEN 'DELIVERED' THEN 'delvd' ELSE 'shipment cancelled' END END"""


def _quantity_text(quantity: str, key: str) -> str:
    return f"""CASE {key} % 6
        WHEN 0 THEN CAST({quantity} AS VARCHAR) WHEN 1 THEN {quantity} || '.7'
        WHEN 2 THEN 'abc' WHEN 3 THEN ' ' WHEN 4 THEN '1e3' ELSE ' ' || {quantity} || '.0 ' END"""


def _parse_date(cell: str) -> str:
    formats = "['%Y-%m-%d', '%m/%d/%Y', '%b %d %Y', '%b %d, %Y']"
    return f"CAST(try_strptime(regexp_replace(trim({cell}), '\\s+', ' ', 'g'), {formats}) AS DATE)"


def _parse_datetime(cell: str) -> str:
    formats = """['%Y-%m-%d %H:%M:%S', '%m/%d/%Y %H:%M:%S', '%I:%M %p %b %d, %Y',
        '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S+00:00', '%m/%d/%Y %I:%M %p', '%b %d, %Y %I:%M %p']"""
    return f"try_strptime(regexp_replace(trim({cell}), '\\s+', ' ', 'g'), {formats})"


def _parse_status(cell: str) -> str:
    return f"""CASE WHEN regexp_matches(lower({cell}), 'cancel') THEN 'CANCELLED'
        WHEN regexp_matches(lower({cell}), 'ship') THEN 'SHIPPED'
        WHEN regexp_matches(lower({cell}), 'deliv') THEN 'DELIVERED'
        WHEN regexp_matches(lower({cell}), 'plac') THEN 'PLACED' ELSE 'UNKNOWN' END"""


def _number(cell: str) -> str:
    return f"try_cast(trim({cell}) AS DOUBLE)"


def _whole(cell: str) -> str:
    n = _number(cell)
    return f"CASE WHEN {n} = floor({n}) THEN CAST({n} AS BIGINT) END"


def _quantity(cell: str) -> str:
    return f"CAST(trunc(COALESCE({_number(cell)}, 0)) AS INT)"


def _not_token(cell: str) -> str:
    return f"""CASE WHEN regexp_matches({cell}, '(?i)^\\s*(nan|na|n/a|null|none)?\\s*$')
        THEN NULL ELSE {cell} END"""


def _cell(cell: str) -> str:
    return _not_token(f"trim(trim({cell}), '\"')")


_CUSTOMER_DAY = "(DATE '2020-01-01' + CAST(c_custkey % 1500 AS INT))"
CUSTOMER_LINES = f"""
lines AS (SELECT c_custkey AS row_key, concat_ws(',',
    'c' || c_custkey,
    CASE c_custkey % 3 WHEN 0 THEN '  First ' WHEN 1 THEN '"First"' ELSE 'First' END,
    CASE c_custkey % 10 WHEN 9 THEN 'Na' ELSE replace(c_name, '#', ' ') END,
    CASE c_custkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'N/A'
        ELSE 'user' || c_custkey || '@example.com' END,
    CASE WHEN c_custkey % 13 = 0 THEN strftime({_CUSTOMER_DAY}, '%b, %d, %Y')
        ELSE {_date_text(_CUSTOMER_DAY, 'c_custkey')} END,
    CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN ' nan'
        WHEN c_custkey % 6 = 1 THEN ' ' || lower(c_mktsegment) || ' '
        ELSE c_mktsegment END) AS line
  FROM customer)"""

_LISTING_DAY = "(DATE '2021-01-01' + CAST(p_partkey % 700 AS INT))"
LISTING_LINES = f"""
lines AS (SELECT p_partkey AS row_key, concat_ws(',',
    'L' || p_partkey,
    CASE WHEN p_partkey % 9 = 0 THEN p_name || ' 27"' ELSE p_name END,
    CASE p_partkey % 4 WHEN 0 THEN ' ' || lower(p_type) || ' ' ELSE p_type END,
    CASE p_partkey % 5 WHEN 0 THEN '" ' || p_brand || ' "' ELSE p_brand END,
    CASE WHEN p_partkey % 17 = 0
        THEN '"$1,' || CAST(p_retailprice AS DECIMAL(10,2))::VARCHAR || '"'
        WHEN p_partkey % 10 = 0
        THEN '" $' || CAST(p_retailprice AS DECIMAL(10,2))::VARCHAR || ' "'
        ELSE '"$' || CAST(p_retailprice AS DECIMAL(10,2))::VARCHAR || '"' END,
    CASE p_partkey % 8 WHEN 7 THEN 'none' ELSE CAST(p_size AS VARCHAR) END,
    {_date_text(_LISTING_DAY, 'p_partkey')}) AS line
  FROM part)"""


def _repair(columns: list[str], date_index: int) -> str:
    """List-based repair: pieces between the fixed left and right columns form the date."""
    width, tail = len(columns), len(columns) - date_index - 1
    picks = ", ".join(f"trim(f[{i + 1}]) AS {c}" for i, c in enumerate(columns))
    right = f"p[len(p) - {tail - 1}:]" if tail else "[]::VARCHAR[]"
    return f"""
parts AS (
  SELECT row_key, list_transform(string_split(line, ','), lambda x: trim(x)) AS p FROM lines),
fixed AS (
  SELECT row_key, CAST(len(p) AS INT) AS field_count,
         CASE WHEN len(p) <= {width} THEN list_resize(p, {width}, '')
              ELSE list_concat(p[1:{date_index}],
                   [array_to_string(p[{date_index + 1}:len(p) - {tail}], ' ')], {right}) END AS f
  FROM parts),
repaired AS (SELECT row_key, {picks}, field_count FROM fixed)"""


_CUSTOMER = ["customer_id", "first_name", "last_name", "email", "join_date", "city"]
_LISTING = [
    "listing_id", "product_name", "category", "seller_id", "price", "stock_quantity",
    "listing_date",
]
CUSTOMERS_REPAIRED = (CUSTOMER_LINES, _repair(_CUSTOMER, 4))
LISTINGS_REPAIRED = (LISTING_LINES, _repair(_LISTING, 6))

_oracle("repair_customer_rows", "SELECT * FROM repaired", *CUSTOMERS_REPAIRED)
_oracle("repair_listing_rows", "SELECT * FROM repaired", *LISTINGS_REPAIRED)

_oracle("scan_customer_lines", "SELECT * EXCLUDE (row_key) FROM repaired", *CUSTOMERS_REPAIRED)
_oracle("scan_listing_lines", "SELECT * EXCLUDE (row_key) FROM repaired", *LISTINGS_REPAIRED)

CUSTOMER_CELLS = f"""
cells AS (SELECT row_key, {', '.join(f'{_cell(c)} AS {c}' for c in _CUSTOMER)} FROM repaired)"""
LISTING_CELLS = f"""
cells AS (SELECT row_key, {', '.join(f'{_cell(c)} AS {c}' for c in _LISTING)} FROM repaired)"""

CLEAN_CUSTOMERS = f"""
clean_customers AS (
  SELECT row_key, customer_id, first_name, last_name, email,
         strftime({_parse_date('join_date')}, '%Y-%m-%d') AS join_date, upper(city) AS city
  FROM cells)"""
CLEAN_LISTINGS = f"""
clean_listings AS (
  SELECT row_key, listing_id, trim(product_name) AS product_name, upper(trim(category)) AS category,
         trim(seller_id) AS seller_id, {_number("replace(replace(price, '$', ''), ',', '')")}
         AS price, {_whole('stock_quantity')} AS stock_quantity,
         strftime({_parse_date('listing_date')}, '%Y-%m-%d') AS listing_date
  FROM cells)"""

_oracle("normalize_cells", "SELECT * FROM cells", *CUSTOMERS_REPAIRED, CUSTOMER_CELLS)
_oracle(
    "clean_customers",
    "SELECT * FROM clean_customers",
    *CUSTOMERS_REPAIRED, CUSTOMER_CELLS, CLEAN_CUSTOMERS,
)
_oracle(
    "clean_listings",
    "SELECT * FROM clean_listings",
    *LISTINGS_REPAIRED, LISTING_CELLS, CLEAN_LISTINGS,
)

RAW_EVENTS = f"""
raw_events AS (
  SELECT CAST(order_id AS VARCHAR) AS order_id, ' c' || customer_id || ' ' AS customer_id,
         'L' || listing_id AS listing_id,
         {_quantity_text('quantity', '(listing_id * 2 + listing_id % 2)')} AS quantity,
         CASE order_id % 9 WHEN 0 THEN 'NULL' ELSE CAST(price_at_purchase AS VARCHAR) END
           AS price_at_purchase,
         {_datetime_text('event_timestamp', 'order_id')} AS event_timestamp,
         {_status_text('order_status', 'listing_id')} AS order_status
  FROM order_events)"""
CLEAN_ORDERS = f"""
clean_orders AS (
  SELECT order_id, trim(customer_id) AS customer_id, listing_id, {_whole('quantity')} AS quantity,
         {_number('price_at_purchase')} AS price_at_purchase,
         strftime({_parse_datetime('event_timestamp')}, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
         {_parse_status('order_status')} AS order_status
  FROM (SELECT * REPLACE (CASE WHEN quantity LIKE '%.7' THEN NULL ELSE quantity END AS quantity)
        FROM raw_events))"""
_oracle("clean_orders", "SELECT * FROM clean_orders", BASE, RAW_EVENTS, CLEAN_ORDERS)



def _problem(column: str, reason: str, unread: str) -> str:
    return f"CASE WHEN {unread} THEN '{column}:{reason}' END"


def _quarantine(name: str, relations: tuple, source: str, columns: list[str], problems: list[str]) -> None:
    """Cells as text of rows with problems, and the problems; the counts are taken from them."""
    QUARANTINED[name] = f"""judged_{name} AS (
      SELECT {', '.join(columns)}, concat_ws(',', {', '.join(problems)}) AS problems FROM ({source}))"""
    _oracle(
        f"quarantine_{name}",
        f"SELECT * FROM judged_{name} WHERE problems <> ''",
        *relations, QUARANTINED[name],
    )


QUARANTINED: dict[str, str] = {}
_quarantine(
    "customers",
    (*CUSTOMERS_REPAIRED, CUSTOMER_CELLS),
    "SELECT * FROM cells",
    ["row_key", *_CUSTOMER],
    [_problem("join_date", "not_a_date", f"join_date IS NOT NULL AND {_parse_date('join_date')} IS NULL")],
)
_LISTING_PRICE = _number("replace(replace(price, '$', ''), ',', '')")
_quarantine(
    "listings",
    (*LISTINGS_REPAIRED, LISTING_CELLS),
    "SELECT * FROM cells",
    ["row_key", *_LISTING],
    [
        _problem("price", "not_a_number", f"price IS NOT NULL AND {_LISTING_PRICE} IS NULL"),
        _problem(
            "stock_quantity",
            "not_a_whole_number",
            f"stock_quantity IS NOT NULL AND {_whole('stock_quantity')} IS NULL",
        ),
        _problem(
            "listing_date", "not_a_date", f"listing_date IS NOT NULL AND {_parse_date('listing_date')} IS NULL"
        ),
    ],
)
_EVENT = [
    "order_id", "customer_id", "listing_id", "quantity", "price_at_purchase", "event_timestamp",
    "order_status",
]
_EVENT_CELLS = ", ".join(f"{_not_token(f'trim({c})')} AS {c}" for c in _EVENT)
_quarantine(
    "orders",
    (BASE, RAW_EVENTS),
    f"SELECT {_EVENT_CELLS} FROM raw_events",
    _EVENT,
    [
        _problem("order_status", "not_a_status", f"order_status IS NOT NULL AND {_parse_status('order_status')} = 'UNKNOWN'"),
        _problem(
            "event_timestamp",
            "not_a_time",
            f"event_timestamp IS NOT NULL AND {_parse_datetime('event_timestamp')} IS NULL",
        ),
        _problem(
            "quantity", "not_a_whole_number", f"quantity IS NOT NULL AND {_whole('quantity')} IS NULL"
        ),
        _problem(
            "price_at_purchase",
            "not_a_number",
            f"price_at_purchase IS NOT NULL AND {_number('price_at_purchase')} IS NULL",
        ),
    ],
)


def _feed_counts(name: str, reasons: list[str], width: int | None = None) -> str:
    counted = {"rows": "true", "quarantined": "problems <> ''"}
    counted |= {r: f"contains(problems, '{r}')" for r in reasons}
    shown = [
        f"SELECT '{name}' AS feed, '{what}' AS counted, COUNT(*) FILTER ({test}) AS rows FROM judged_{name}"
        for what, test in counted.items()
    ]
    if width:
        shown += [
            f"SELECT '{name}', '{what}', COUNT(*) FILTER (len(string_split(line, ',')) {sign} {width}) FROM {name}_lines"
            for what, sign in (("merged", ">"), ("padded", "<"))
        ]
    return " UNION ALL ".join(shown)


def _renamed(relations: tuple, name: str) -> list[str]:
    """The relations of one text feed under names of their own."""
    words = {w: f"{name}_{w}" for w in ("lines", "parts", "fixed", "repaired", "cells")}
    pattern = re.compile(r"\b(" + "|".join(words) + r")\b(?=\s+AS \(|\)|\s*$)|(?<=FROM )(" + "|".join(words) + r")\b")
    return [pattern.sub(lambda m: words[m[0]], r) for r in relations]


_oracle(
    "cleaning_counts",
    " UNION ALL ".join(
        [
            _feed_counts("customers", ["join_date:not_a_date"], 6),
            _feed_counts(
                "listings",
                ["listing_date:not_a_date", "price:not_a_number", "stock_quantity:not_a_whole_number"],
                7,
            ),
            _feed_counts(
                "orders",
                [
                    "event_timestamp:not_a_time", "order_status:not_a_status",
                    "price_at_purchase:not_a_number", "quantity:not_a_whole_number",
                ],
            ),
        ]
    ),
    *_renamed((*CUSTOMERS_REPAIRED, CUSTOMER_CELLS, QUARANTINED["customers"]), "customers"),
    *_renamed((*LISTINGS_REPAIRED, LISTING_CELLS, QUARANTINED["listings"]), "listings"),
    BASE, RAW_EVENTS, QUARANTINED["orders"],
)

_oracle(
    "scan_event_records",
    """SELECT * REPLACE (CASE WHEN order_id::BIGINT % 5 <> 2 THEN order_status END AS order_status,
                         NULLIF(price_at_purchase, 'NULL') AS price_at_purchase)
       FROM raw_events WHERE order_id::BIGINT % 5 <> 1""",
    BASE, RAW_EVENTS,
)
_oracle(
    "load_tables",
    """SELECT 'customers' AS table_name,
              concat_ws('|', customer_id, first_name, last_name, email, join_date, city) AS row
       FROM customers
       UNION ALL SELECT 'listings', concat_ws('|', listing_id, product_name, category, seller_id,
                                              price, stock_quantity, listing_date) FROM listings
       UNION ALL SELECT DISTINCT 'orders', concat_ws('|', order_id, customer_id) FROM order_events
       UNION ALL SELECT 'order_items',
                        concat_ws('|', order_id, listing_id, quantity, price_at_purchase) FROM items
       UNION ALL SELECT DISTINCT 'order_item_status_history',
                        concat_ws('|', order_id, listing_id, status_timestamp, order_status)
       FROM history""",
    BASE,
)

_oracle(
    "parse_mixed_date",
    "SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS parsed FROM orders",
)
_oracle(
    "parse_mixed_datetime",
    f"""SELECT order_id, listing_id, order_status,
               {_parse_datetime(_datetime_text('event_timestamp', 'order_id'))} AS parsed
        FROM order_events""",
    BASE,
)
_oracle(
    "normalize_status",
    f"""SELECT order_id, listing_id, event_timestamp,
               {_parse_status('shown')} AS status
        FROM (SELECT *, {_status_text('order_status', 'listing_id')} AS shown
              FROM order_events)""",
    BASE,
)
_oracle(
    "parse_price",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_number,
              CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS DOUBLE) AS price FROM lineitem""",
)
_oracle(
    "coerce_numeric",
    f"""SELECT order_id, line_number, {_number('shown')} AS number,
               {_whole('shown')} AS whole_number, {_quantity('shown')} AS quantity
        FROM (SELECT l_orderkey AS order_id, l_linenumber AS line_number,
                     {_quantity_text('CAST(l_quantity AS INT)', '(l_orderkey + l_linenumber)')}
                       AS shown
              FROM lineitem)""",
)

# --- normalisation ----------------------------------------------------------------------------

_oracle("normalize_orders", "SELECT DISTINCT order_id, customer_id FROM order_events", BASE)
_oracle("normalize_order_items", "SELECT * FROM items", BASE)
_oracle(
    "normalize_history",
    """SELECT order_id, listing_id, status_timestamp, MAX(order_status) AS order_status
       FROM history GROUP BY order_id, listing_id, status_timestamp""",
    BASE,
)
_oracle(
    "split_dirty_events",
    """SELECT order_id, listing_id, quantity, price_at_purchase FROM (
         SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, listing_id
           ORDER BY event_timestamp DESC NULLS FIRST, quantity DESC,
                    price_at_purchase DESC NULLS LAST) AS rn
         FROM (SELECT order_id, listing_id, event_timestamp,
                      CAST(COALESCE(quantity, 0) AS INT) AS quantity,
                      CAST(price_at_purchase AS DECIMAL(10,2)) AS price_at_purchase
               FROM clean_orders))
       WHERE rn = 1""",
    BASE, RAW_EVENTS, CLEAN_ORDERS,
)

# --- analytics --------------------------------------------------------------------------------

_oracle("delivered_items", "SELECT items.* FROM items JOIN delivered USING (order_id, listing_id)",
        BASE, SOLD)
_oracle("seller_category_revenue", "SELECT * FROM seller_revenue", BASE, SOLD)
_oracle("ranked_sellers", "SELECT * REPLACE (CAST(rn AS INT) AS rn) FROM ranked",
        BASE, SOLD)
for _name, _x in (("top_sellers", 1), ("top5_sellers", 5)):
    _oracle(
        _name,
        f"""SELECT category, seller_id, revenue FROM ranked WHERE rn <= {_x}
            ORDER BY category, revenue DESC, seller_id""",
        BASE, SOLD,
    )
_oracle(
    "category_revenue_ci",
    """SELECT category, CAST(SUM(revenue) AS DECIMAL(38,2)) AS revenue
       FROM seller_revenue GROUP BY category""",
    BASE, SOLD,
)
_oracle(
    "item_milestones",
    """SELECT order_id, listing_id,
              MIN(status_timestamp) FILTER (order_status = 'PLACED') AS placed_at,
              MIN(status_timestamp) FILTER (order_status = 'SHIPPED') AS shipped_at,
              MIN(status_timestamp) FILTER (order_status = 'DELIVERED') AS delivered_at
       FROM history WHERE order_status <> 'CANCELLED' GROUP BY order_id, listing_id""",
    BASE,
)
_oracle(
    "avg_placed_to_shipped",
    """SELECT CAST(AVG(date_sub('hour', started, left_at)) AS DECIMAL(24,4)) AS avg_hours,
              CAST(AVG(date_sub('minute', started, left_at)) AS DECIMAL(24,4)) AS avg_minutes,
              COUNT(*) AS items_count
       FROM (SELECT MIN(event_timestamp) FILTER (order_status = 'PLACED') AS started,
                    MIN(event_timestamp) FILTER (order_status = 'SHIPPED') AS left_at
             FROM order_events GROUP BY order_id, listing_id HAVING left_at >= started)""",
    BASE,
)
_oracle("monthly_revenue", "SELECT * FROM monthly", BASE, MONTHLY)
_oracle(
    "mom_growth",
    """SELECT *, round(CAST(monthly_revenue - prev_revenue AS DOUBLE)
                       / NULLIF(CAST(prev_revenue AS DOUBLE), 0), 6) AS mom_growth_ratio
       FROM (SELECT *, LAG(monthly_revenue) OVER (ORDER BY month_start) AS prev_revenue
             FROM monthly)
       ORDER BY month_start""",
    BASE, MONTHLY,
)

_oracle(
    "mom_growth_of_a_span",
    ORACLES["mom_growth"][ORACLES["mom_growth"].rindex("SELECT *, round(") :],
    BASE,
    MONTHLY.replace(
        "order_status = 'DELIVERED'",
        f"order_status = 'DELIVERED' AND event_timestamp >= '{SPAN[0]}' AND event_timestamp < '{SPAN[1]}'",
    ),
)

# --- documents --------------------------------------------------------------------------------

ENRICHED = """
enriched AS (
  SELECT order_id, listing_id, quantity, price_at_purchase, product_name AS name, category,
         seller_id, CAST(quantity * price_at_purchase AS DOUBLE) AS extended_price
  FROM items LEFT JOIN listings USING (listing_id))"""

_oracle("order_items_enriched", "SELECT * FROM enriched", BASE, ENRICHED)
ITEM_ROWS = """
item_rows AS (
  SELECT order_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY order_id
                                 ORDER BY CAST(listing_id AS VARCHAR)) - 1 AS INT) AS position,
         CAST(listing_id AS VARCHAR) AS listing_id, quantity, extended_price,
         name AS product_name, category, seller_id,
         CAST(price_at_purchase AS DOUBLE) AS price_at_purchase
  FROM enriched)"""
_oracle("order_items_array", "SELECT * FROM item_rows", BASE, ENRICHED, ITEM_ROWS)
_oracle("order_item_positions", "SELECT * FROM item_rows", BASE, ENRICHED, ITEM_ROWS)
_oracle(
    "order_snapshot_items",
    "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id) FROM item_rows",
    BASE, ENRICHED, ITEM_ROWS,
)
_oracle(
    "order_milestones",
    f"""SELECT order_id, {_iso('placed')} AS placed_at, {_iso('shipped')} AS shipped_at,
               {_iso('delivered')} AS delivered_at FROM first_times""",
    BASE, ORDERS_FLAT,
)
_oracle("order_current_status", "SELECT * FROM newest", BASE, ORDERS_FLAT)
_oracle(
    "order_metrics",
    f"""SELECT order_id, {_hours('placed', 'shipped')} AS hours_to_ship,
               {_hours('placed', 'delivered')} AS hours_to_deliver FROM first_times""",
    BASE, ORDERS_FLAT,
)
_oracle("order_payment", "SELECT order_id, subtotal FROM totals", BASE, ORDERS_FLAT)
TIMELINE_ROWS = f"""
timeline_rows AS (
  SELECT order_id,
         CAST(ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY step) - 1 AS INT) AS position,
         status, {_iso('ts')} AS at
  FROM (SELECT order_id, 1 AS step, 'PLACED' AS status, placed AS ts FROM first_times
        UNION ALL SELECT order_id, 2, 'SHIPPED', shipped FROM first_times
        UNION ALL SELECT order_id, 3, 'DELIVERED', delivered FROM first_times)
  WHERE ts IS NOT NULL)"""
_oracle("status_timeline", "SELECT * FROM timeline_rows", BASE, ORDERS_FLAT, TIMELINE_ROWS)
_oracle(
    "order_snapshot_timeline",
    "SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id) FROM timeline_rows",
    BASE, ORDERS_FLAT, TIMELINE_ROWS,
)
_oracle("order_snapshot_flat", "SELECT * FROM flat", BASE, ORDERS_FLAT)
WHOLE_DOCUMENTS = """SELECT flat.* EXCLUDE (item_count, timeline_length), flat._id AS order_id,
              COALESCE(lines.items, '') AS items, COALESCE(steps.timeline, '') AS status_timeline,
              'mysql-snapshot' AS source
       FROM flat
       LEFT JOIN (SELECT CAST(order_id AS VARCHAR) AS _id, string_agg(concat_ws('|',
                    listing_id, quantity, CAST(extended_price AS DECIMAL(20,2)), name, category,
                    seller_id, CAST(price_at_purchase AS DECIMAL(20,2))), ';'
                    ORDER BY CAST(listing_id AS VARCHAR)) AS items
                  FROM enriched GROUP BY order_id) lines USING (_id)
       LEFT JOIN (SELECT CAST(order_id AS VARCHAR) AS _id,
                         string_agg(concat_ws('|', status, "at"), ';' ORDER BY position) AS timeline
                  FROM timeline_rows GROUP BY order_id) steps USING (_id)"""
_oracle("order_snapshot", WHOLE_DOCUMENTS, BASE, ORDERS_FLAT, TIMELINE_ROWS, ENRICHED)

# The tables as a small load leaves them, with one status for each item and time.
AFTER_LOAD = (
    BASE.replace(
        "p_name AS product_name", "p_name || CASE WHEN p_partkey % 701 = 0 THEN ' II' ELSE '' END AS product_name"
    )
    .replace(
        "order_heads AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id",
        "order_heads AS (SELECT o_orderkey AS order_id, o_custkey + (o_orderkey % 499 = 0)::INT AS customer_id",
    )
    .replace(
        "SELECT order_id, listing_id, event_timestamp AS status_timestamp, order_status\n  FROM order_events)",
        """SELECT order_id, listing_id, event_timestamp AS status_timestamp, MAX(order_status) AS order_status
  FROM order_events GROUP BY order_id, listing_id, event_timestamp)""",
    )
)
_oracle("snapshot_incremental", WHOLE_DOCUMENTS, AFTER_LOAD, ORDERS_FLAT, TIMELINE_ROWS, ENRICHED)
_oracle("order_lookup", f"SELECT * FROM flat WHERE _id = '{LOOKUP_ORDER}'", BASE, ORDERS_FLAT)
_oracle(
    "customer_orders",
    f"""SELECT * FROM flat WHERE customer_id = '{LOOKUP_CUSTOMER}'
        ORDER BY delivered_at DESC NULLS LAST, _id""",
    BASE, ORDERS_FLAT,
)
_oracle(
    "orders_by_status",
    """SELECT * FROM flat WHERE current_status = 'DELIVERED'
       ORDER BY placed_at DESC NULLS LAST, _id""",
    BASE, ORDERS_FLAT,
)

# --- audits -----------------------------------------------------------------------------------

_oracle(
    "table_counts",
    """SELECT 'customers' AS table_name, COUNT(*) AS rows FROM customers
       UNION ALL SELECT 'listings', COUNT(*) FROM listings
       UNION ALL SELECT 'orders', COUNT(*) FROM order_heads
       UNION ALL SELECT 'order_items', COUNT(*) FROM items
       UNION ALL SELECT 'order_item_status_history', COUNT(*) FROM history
       UNION ALL SELECT 'documents', COUNT(DISTINCT order_id) FROM order_heads""",
    BASE,
)


def _pk(name: str, relation: str, keys: str) -> str:
    return f"""SELECT '{name}' AS table_name, COUNT(*) AS duplicate_keys,
                      CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
               FROM (SELECT COUNT(*) AS n FROM {relation} GROUP BY {keys} HAVING COUNT(*) > 1)"""


_oracle(
    "audit_pk",
    " UNION ALL ".join(
        [
            _pk("customers", "customers", "customer_id"),
            _pk("listings", "listings", "listing_id"),
            _pk("orders", "order_heads", "order_id"),
            _pk("order_items", "items", "order_id, listing_id"),
            _pk("order_item_status_history", "history", "order_id, listing_id, status_timestamp"),
        ]
    ),
    BASE,
)


def _fk(name: str, child: str, parent_name: str, parent: str, keys: str) -> str:
    match = " AND ".join(f"p.{k} = c.{k}" for k in keys.split(", "))
    return f"""SELECT '{name}' AS table_name, '{parent_name}' AS parent_name,
                      COUNT(DISTINCT ({keys})) AS orphan_keys, COUNT(*) AS orphan_rows
               FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})"""


_oracle(
    "audit_fk",
    " UNION ALL ".join(
        [
            _fk("orders", "order_heads", "customers",
                "(SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal >= 0)",
                "customer_id"),
            _fk("order_items", "items", "orders",
                "(SELECT o_orderkey AS order_id FROM orders WHERE o_orderstatus <> 'F')",
                "order_id"),
            _fk("order_items", "items", "listings",
                "(SELECT * FROM listings WHERE stock_quantity <= 45)", "listing_id"),
            _fk("order_item_status_history", "history", "order_items",
                "(SELECT * FROM items WHERE quantity > 1)", "order_id, listing_id"),
        ]
    ),
    BASE,
)


def _nulls(name: str, relation: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{c}' AS column_name,
                   COUNT(*) FILTER ({c} IS NULL) AS null_rows FROM {relation}"""
        for c in columns
    )


ORACLES["audit_nulls"] = " UNION ALL ".join(
    f"SELECT * FROM (WITH {','.join(relations)} {_nulls(name, f'clean_{name}', columns)})"
    for name, relations, columns in (
        (
            "customers",
            (*CUSTOMERS_REPAIRED, CUSTOMER_CELLS, CLEAN_CUSTOMERS),
            ["customer_id", "first_name", "last_name", "join_date"],
        ),
        ("listings", (*LISTINGS_REPAIRED, LISTING_CELLS, CLEAN_LISTINGS), _LISTING),
        (
            "orders",
            (BASE, """clean_orders AS (
               SELECT order_id, NULLIF(customer_id % 5, 0) AS customer_id FROM order_heads)"""),
            ["order_id", "customer_id"],
        ),
        (
            "order_items",
            (BASE, """clean_order_items AS (
               SELECT * REPLACE (NULLIF(quantity, 7) AS quantity) FROM items)"""),
            ["order_id", "listing_id", "quantity", "price_at_purchase"],
        ),
        (
            "order_item_status_history",
            (BASE, """clean_order_item_status_history AS (
               SELECT * REPLACE (NULLIF(order_status, 'CANCELLED') AS order_status) FROM history)"""),
            ["order_id", "listing_id", "status_timestamp", "order_status"],
        ),
    )
)


def _domain(table: str, relation: str, column: str, rule: str, test: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, '{rule}' AS rule,
                      COUNT(*) FILTER ({test}) AS bad_rows FROM {relation}"""


_WIDTHS = {"customer_id": 16, "first_name": 80, "last_name": 80, "email": 255, "city": 64}
_LISTING_WIDTHS = {"listing_id": 16, "product_name": 255, "category": 64, "seller_id": 64}
_NOT_ISO = "{0} IS NOT NULL AND NOT regexp_matches({0}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
_DOMAINS = {
    "customers": (
        (*CUSTOMERS_REPAIRED, CUSTOMER_CELLS),
        [
            *(("cells", c, "too_long", f"length({c}) > {n}") for c, n in _WIDTHS.items()),
            ("cells", "join_date", "not_date", _NOT_ISO.format("join_date")),
        ],
    ),
    "listings": (
        (*LISTINGS_REPAIRED, LISTING_CELLS),
        [
            *(("cells", c, "too_long", f"length({c}) > {n}") for c, n in _LISTING_WIDTHS.items()),
            ("cells", "price", "not_decimal(10,2)",
             "NOT regexp_matches(price, '^[0-9]+[.]?[0-9]*$')"),
            ("cells", "stock_quantity", "not_int",
             "NOT regexp_matches(stock_quantity, '^[0-9]+$')"),
            ("cells", "listing_date", "not_date", _NOT_ISO.format("listing_date")),
        ],
    ),
    "orders": (
        (BASE,),
        [
            ("order_heads", "order_id", "not_int", "order_id > 2147483647"),
            ("order_heads", "customer_id", "too_long", "true"),
        ],
    ),
    "order_items": (
        (BASE, RAW_EVENTS),
        [
            ("raw_events", "order_id", "not_int", "try_cast(order_id AS INT) IS NULL"),
            ("raw_events", "listing_id", "too_long", "length(listing_id) > 16"),
            ("raw_events", "quantity", "not_int",
             "trim(quantity) <> '' AND NOT regexp_matches(trim(quantity), '^[0-9]+$')"),
            ("raw_events", "price_at_purchase", "not_decimal(10,2)",
             "price_at_purchase <> 'NULL' AND "
             "try_cast(price_at_purchase AS DECIMAL(10,2)) IS NULL"),
        ],
    ),
    "order_item_status_history": (
        (BASE,),
        [
            ("history", "order_id", "not_int", "order_id > 2147483647"),
            ("history", "listing_id", "too_long", "length(CAST(listing_id AS VARCHAR)) > 16"),
            ("history", "status_timestamp", "not_timestamp_ntz", "order_id % 7 = 0"),
            ("history", "order_status", "too_long", "length(order_status) > 32"),
        ],
    ),
}
ORACLES["audit_domain"] = " UNION ALL ".join(
    f"SELECT * FROM (WITH {','.join(relations)} "
    + " UNION ALL ".join(_domain(table, *rule) for rule in rules)
    + ")"
    for table, (relations, rules) in _DOMAINS.items()
)
_oracle(
    "judge_rows",
    """SELECT *, concat_ws(',', CASE WHEN first_name IS NULL THEN 'first_name:missing' END,
                           CASE WHEN last_name IS NULL THEN 'last_name:missing' END,
                           CASE WHEN join_date IS NULL THEN 'join_date:missing' END)
              AS reject_reasons
       FROM clean_customers""",
    *CUSTOMERS_REPAIRED, CUSTOMER_CELLS, CLEAN_CUSTOMERS,
)

_KEPT = """(SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')"""
_oracle(
    "cascade_delete",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, COUNT(*) AS rows,
                   CAST(SUM(order_id) AS BIGINT) AS order_id_sum
            FROM {relation} WHERE order_id IN {_KEPT}"""
        for name, relation in (
            ("orders", "order_heads"),
            ("order_items", "items"),
            ("order_item_status_history", "history"),
        )
    ),
    BASE,
)
_oracle(
    "audit_restrict",
    """SELECT 'customers' AS table_name, customer_id AS key, COUNT(*) AS rows
       FROM order_heads WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
       GROUP BY customer_id
       UNION ALL SELECT 'listings', listing_id, COUNT(*)
       FROM items WHERE listing_id IN (SELECT p_partkey FROM part WHERE p_size > 45)
       GROUP BY listing_id""",
    BASE,
)

_oracle(
    "audit_restrict_updates",
    """SELECT 'customers' AS table_name, customer_id AS key, COUNT(*) AS rows FROM order_heads
       WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)
       GROUP BY customer_id
       UNION ALL SELECT 'listings', listing_id, COUNT(*) FROM items
       WHERE listing_id IN (SELECT p_partkey FROM part WHERE p_size > 40) GROUP BY listing_id""",
    BASE,
)
