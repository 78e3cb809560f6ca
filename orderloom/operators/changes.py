"""What changed between two versions of keyed tables, and which orders that concerns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def changed_rows(
    old: DataFrame, new: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None
) -> DataFrame:
    """Keys whose row was inserted, deleted or updated, with the kind of change.

    Keys are unique on both sides. ``values`` limits the comparison to some columns.
    """
    kept = [c for c in new.columns if c not in keys] if values is None else list(values)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(F.lit(True), *kept).alias(name))

    both = side(old, "_old").join(side(new, "_new"), list(keys), "full")
    kind = (
        F.when(F.col("_old").isNull(), "inserted")
        .when(F.col("_new").isNull(), "deleted")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "updated")
    )
    return both.select(*keys, kind.alias("change")).where("change IS NOT NULL")


def touched_orders(changes: dict[str, DataFrame], items: DataFrame) -> DataFrame:
    """Distinct orders whose document may differ, given the changed rows of each table.

    A changed listing concerns the orders that hold it. Changes are reduced to distinct orders
    before they are put together, so a busy order counts once in each table.
    """
    found = []
    for name, rows in changes.items():
        if name == "listings":
            rows = items.join(rows.select("listing_id"), "listing_id", "left_semi")
        found.append(rows.select("order_id").distinct())
    union = found[0]
    for rows in found[1:]:
        union = union.unionByName(rows)
    return union.distinct()
