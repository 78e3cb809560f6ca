"""The five keyed tables: columns, keys, references and widths in one place.

Scans, casts, audits and the load job all read these declarations, so a rule is stated once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = True
    max_chars: int | None = None


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    on_delete: str  # "restrict" or "cascade"


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    # Storage layout: columns that become folders, and columns looked up by value.
    folders: tuple[str, ...] = ()
    lookups: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, not f.required) for f in self.fields])


def _text(name: str, width: int, required: bool = True) -> Field:
    return Field(name, T.StringType(), required, width)


CUSTOMERS = Table(
    "customers",
    (
        _text("customer_id", 16),
        _text("first_name", 80),
        _text("last_name", 80),
        _text("email", 255, required=False),
        Field("join_date", T.DateType()),
        _text("city", 64, required=False),
    ),
    key=("customer_id",),
    lookups=("customer_id", "email"),
)

LISTINGS = Table(
    "listings",
    (
        _text("listing_id", 16),
        _text("product_name", 255),
        _text("category", 64),
        _text("seller_id", 64),
        Field("price", MONEY),
        Field("stock_quantity", T.IntegerType()),
        Field("listing_date", T.DateType()),
    ),
    key=("listing_id",),
    lookups=("listing_id", "seller_id"),
)

ORDERS = Table(
    "orders",
    (Field("order_id", T.IntegerType()), _text("customer_id", 16)),
    key=("order_id",),
    references=(Reference(("customer_id",), "customers", "restrict"),),
    lookups=("order_id", "customer_id"),
)

ORDER_ITEMS = Table(
    "order_items",
    (
        Field("order_id", T.IntegerType()),
        _text("listing_id", 16),
        Field("quantity", T.IntegerType()),
        Field("price_at_purchase", MONEY),
    ),
    key=("order_id", "listing_id"),
    references=(
        Reference(("order_id",), "orders", "cascade"),
        Reference(("listing_id",), "listings", "restrict"),
    ),
    lookups=("order_id", "listing_id"),
)

STATUS_HISTORY = Table(
    "order_item_status_history",
    (
        Field("order_id", T.IntegerType()),
        _text("listing_id", 16),
        Field("status_timestamp", T.TimestampNTZType()),
        _text("order_status", 32),
    ),
    key=("order_id", "listing_id", "status_timestamp"),
    references=(Reference(("order_id", "listing_id"), "order_items", "cascade"),),
    # The analytic questions each concern one or two statuses.
    folders=("order_status",),
    lookups=("order_id",),
)

# Parents come before children: this is also the load order.
TABLES: dict[str, Table] = {
    t.name: t for t in (CUSTOMERS, LISTINGS, ORDERS, ORDER_ITEMS, STATUS_HISTORY)
}

# One row per status event, as delivered by the order feed.
EVENT_COLUMNS = (
    "order_id",
    "customer_id",
    "listing_id",
    "quantity",
    "price_at_purchase",
    "event_timestamp",
    "order_status",
)

DOCUMENTS = "order_documents"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_STRING, _DOUBLE = T.StringType(), T.DoubleType()

_PRODUCT = _struct(
    name=_STRING, category=_STRING, seller_id=_STRING, price_at_purchase=_DOUBLE
)
_ITEM = _struct(
    listing_id=_STRING, quantity=T.IntegerType(), extended_price=_DOUBLE, product=_PRODUCT
)

# One order with its items, milestones and totals.
DOCUMENT = _struct(
    _id=_STRING,
    order_id=_STRING,
    customer=_struct(customer_id=_STRING),
    items=T.ArrayType(_ITEM),
    status_timeline=T.ArrayType(_struct(status=_STRING, at=_STRING)),
    current_status=_STRING,
    placed_at=_STRING,
    shipped_at=_STRING,
    delivered_at=_STRING,
    payment=_struct(currency=_STRING, subtotal=_DOUBLE, total=_DOUBLE),
    metrics=_struct(hours_to_ship=_DOUBLE, hours_to_deliver=_DOUBLE),
    audit=_struct(source=_STRING, snapshot_ts=_STRING),
)
