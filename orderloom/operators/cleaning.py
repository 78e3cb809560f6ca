"""Cleaning of the three raw feeds. Every input row is kept; what cannot be read becomes null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.numeric import parse_price, to_number, to_whole_number
from orderloom.functions.status import UNKNOWN, normalize_status
from orderloom.functions.temporal import (
    iso_date,
    iso_seconds,
    parse_mixed_date,
    parse_mixed_datetime,
)
from orderloom.functions.text import normalize_cells, strip, upper_label
from orderloom.sources.lines import FILE_ORDER

# Position of the date column that may hold unquoted commas.
CUSTOMER_DATE_INDEX = 4
LISTING_DATE_INDEX = 6

EVENT_SORT = ("order_id", "listing_id", "event_timestamp")


Rules = dict[str, Callable[[Column], Column]]

CUSTOMER_RULES: Rules = {"join_date": lambda c: iso_date(parse_mixed_date(c)), "city": F.upper}
LISTING_RULES: Rules = {
    "category": upper_label,
    "price": parse_price,
    "stock_quantity": to_whole_number,
    "listing_date": lambda c: iso_date(parse_mixed_date(c)),
    "product_name": strip,
    "seller_id": strip,
}
EVENT_RULES: Rules = {
    "order_status": normalize_status,
    "event_timestamp": lambda c: iso_seconds(parse_mixed_datetime(c)),
    "quantity": to_whole_number,
    "price_at_purchase": to_number,
}

# Why a cell with text cannot be read, by column.
REASONS = {
    "join_date": "not_a_date",
    "listing_date": "not_a_date",
    "price": "not_a_number",
    "stock_quantity": "not_a_whole_number",
    "event_timestamp": "not_a_time",
    "quantity": "not_a_whole_number",
    "price_at_purchase": "not_a_number",
    "order_status": "not_a_status",
}

#: Columns of a judged feed beside its own: the cells as text, and the reasons, '' for a good row.
CELLS, PROBLEMS = "_cells", "problems"


def _apply(df: DataFrame, rules: Rules) -> DataFrame:
    """Rewrite the columns that exist; a feed may lack optional ones."""
    return df.withColumns({c: rule(F.col(c)) for c, rule in rules.items() if c in df.columns})


def clean_customers(raw: DataFrame) -> DataFrame:
    return _apply(normalize_cells(raw), CUSTOMER_RULES)


def clean_listings(raw: DataFrame) -> DataFrame:
    return _apply(normalize_cells(raw), LISTING_RULES)


def clean_orders(raw: DataFrame, sort: bool = True) -> DataFrame:
    """Clean the event feed; ``sort`` orders it by its text keys, nulls last.

    The sort is a range shuffle on the composite key, so one huge order still spreads over many
    ranges. File order, when the scan recorded it, breaks ties.
    """
    events = _apply(normalize_cells(raw, quotes=False), EVENT_RULES)
    return sort_events(events) if sort else events


def judge(raw: DataFrame, rules: Rules, quotes: bool = True) -> DataFrame:
    """The cleaned feed with, for each row, its cells as text and what could not be read in them.

    ``problems`` lists ``column:reason`` for every cell that holds text which its rule makes null
    (a status: unknown); rows without any keep no cells as text. Cleaning is done once for both outputs: write the result, then take
    ``accepted`` and ``quarantined`` from what was written.
    """
    cells = normalize_cells(raw, quotes=quotes)
    checked = [c for c in rules if c in cells.columns and c in REASONS]
    held = cells.withColumn(CELLS, F.struct(*(F.col(c) for c in raw.columns if c != FILE_ORDER)))
    cleaned = _apply(held, rules)

    def lost(column: str) -> Column:
        unread = F.col(column).isNull()
        if rules[column] is normalize_status:
            unread = F.col(column) == UNKNOWN
        return F.col(f"{CELLS}.{column}").isNotNull() & unread

    found = [F.when(lost(c), F.lit(f"{c}:{REASONS[c]}")) for c in checked]
    judged = cleaned.withColumn(PROBLEMS, F.concat_ws(",", *found))
    # Good rows do not carry their text a second time.
    return judged.withColumn(CELLS, F.when(F.col(PROBLEMS) != "", F.col(CELLS)))


def accepted(judged: DataFrame) -> DataFrame:
    """The cleaned feed: all rows, unreadable cells null."""
    return judged.drop(CELLS, PROBLEMS)


def quarantined(judged: DataFrame) -> DataFrame:
    """Rows with unreadable cells: the cells as text, and what is wrong with which."""
    return judged.filter(F.col(PROBLEMS) != "").select(f"{CELLS}.*", PROBLEMS)


def judgement_counts(judged: DataFrame, width: int | None = None) -> dict[str, Column]:
    """Counters for the pass that writes a judged feed: rows, rows repaired, rows and cells not
    read. ``width`` is the number of fields a line should have."""
    counts = {"rows": F.count(F.lit(1)), "quarantined": F.count_if(F.col(PROBLEMS) != "")}
    if width is not None and "field_count" in judged.columns:
        counts["merged"] = F.count_if(F.col("field_count") > width)
        counts["padded"] = F.count_if(F.col("field_count") < width)
    for column, reason in REASONS.items():
        if column in judged.columns:
            problem = f"{column}:{reason}"
            counts[problem] = F.count_if(F.array_contains(F.split(PROBLEMS, ","), problem))
    return counts


def sort_events(events: DataFrame) -> DataFrame:
    """Cleaned events by their text keys, nulls last, then by file order.

    Sorting samples its input first: a scan of written rows is cheaper to sample than the parsing.
    """
    keys = [F.col(c).asc_nulls_last() for c in (*EVENT_SORT, FILE_ORDER) if c in events.columns]
    return events.orderBy(*keys) if keys else events
