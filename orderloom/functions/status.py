"""Canonical item statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACED, SHIPPED, DELIVERED, CANCELLED, UNKNOWN = (
    "PLACED",
    "SHIPPED",
    "DELIVERED",
    "CANCELLED",
    "UNKNOWN",
)

# The first stem found anywhere in the text decides.
STEMS = (("cancel", CANCELLED), ("ship", SHIPPED), ("deliv", DELIVERED), ("plac", PLACED))

# Later stages win when several events of an order carry the same time.
STAGES = (UNKNOWN, PLACED, SHIPPED, DELIVERED, CANCELLED)


def normalize_status(cell: Column) -> Column:
    text = F.lower(cell)
    found = [F.when(text.contains(stem), F.lit(name)) for stem, name in STEMS]
    return F.coalesce(*found, F.lit(UNKNOWN))


def stage(status: Column) -> Column:
    """Position in the lifecycle; 0 for a status outside it."""
    return F.coalesce(F.array_position(F.array(*map(F.lit, STAGES)), status), F.lit(0))
