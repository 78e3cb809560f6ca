"""Ranks and running totals over rows in a total order, without one task that sees them all.

Rows are dealt into ranges of the order and each range is written and summed; the totals of the
earlier ranges, one row per range, are what a range adds to the running totals of its own rows.
So one order, source or key that holds a third of all rows is ranked by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANGE = "_range"


#: Of the ids that Spark numbers rows with, the part that counts within a partition.
_WITHIN = (1 << 33) - 1


def _before(name: str, window) -> Column:
    return F.coalesce(F.sum(name).over(window), F.lit(0))


def _bases(ranged: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    """What the earlier ranges add up to; as many rows as there are ranges, that is, shuffle
    partitions."""
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy(RANGE).agg(*(value.alias(n) for n, value in sums.items()))
    return bases.select(RANGE, *(_before(n, earlier).alias(f"_base_{n}") for n in sums))


def ranks(
    rows: DataFrame,
    order: Sequence[Column | str],
    name: str,
    write: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The rows with the number of earlier rows as ``name``, under the same terms.

    A range is sorted and its rows numbered as they are written, so they are shuffled once.
    """
    ranged = write(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns(
            {
                RANGE: F.spark_partition_id(),
                name: F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)),
            }
        )
    )
    bases = _bases(ranged, {name: F.count(F.lit(1))})
    return ranged.join(F.broadcast(bases), RANGE).select(
        *rows.columns, (F.col(name) + F.col(f"_base_{name}")).alias(name)
    )


def running_totals(
    rows: DataFrame,
    order: Sequence[Column | str],
    totals: Mapping[str, Column],
    write: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The rows with, for each name in ``totals``, the sum of its column over all earlier rows.

    ``order`` should tell all rows apart: rows equal in it lie in one range, in any order.
    ``write`` puts a frame into a table that all executors share and reads it back; the ranges are
    read from it twice, so they must not be drawn anew. ``rows`` should be cheap to read, since
    its order is sampled first.
    """
    ranged = write(
        rows.withColumns({f"_add_{name}": value for name, value in totals.items()})
        .repartitionByRange(*order)
        .withColumn(RANGE, F.spark_partition_id())
    )
    within = Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)

    bases = _bases(ranged, {n: F.sum(f"_add_{n}") for n in totals})
    ranked = ranged.withColumns({n: _before(f"_add_{n}", within) for n in totals})
    return ranked.join(F.broadcast(bases), RANGE).select(
        *rows.columns, *((F.col(n) + F.col(f"_base_{n}")).alias(n) for n in totals)
    )
