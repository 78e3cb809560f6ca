"""Tolerant number parsing: bad text becomes null instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Guards the cast, which trims blanks itself but also accepts literals such as "1d" or "2F".
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

LONG_SAFE = 2.0**63


def to_number(cell: Column) -> Column:
    text = cell.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_whole_number(cell: Column) -> Column:
    """Nullable integer; a fractional or out-of-range value has no integer form."""
    number = to_number(cell)
    fits = (number == F.floor(number)) & (F.abs(number) < LONG_SAFE)
    return F.when(fits, number.try_cast("bigint"))


def to_quantity(cell: Column) -> Column:
    """Integer that defaults to zero; fractions are cut off."""
    number = F.coalesce(to_number(cell), F.lit(0.0))
    return number.try_cast("int")


def parse_price(cell: Column) -> Column:
    """Amount from text such as ' $1,299.00 '."""
    return to_number(F.translate(cell, "$,", ""))
