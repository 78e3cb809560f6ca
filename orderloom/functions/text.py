"""Column expressions for raw text cells and for lines with stray separators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as blank at the edge of a cell (plain trim() removes only ' ').
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
ASCII_BLANKS = "".join(c for c in BLANKS if c.isascii())

# A whole cell holding one of these, in any case, means "no value".
NULL_TOKENS = ("", "nan", "na", "n/a", "null", "none")
_LONGEST_TOKEN = max(map(len, NULL_TOKENS))
_NULL_CELL = rf"(?iU)^\s*({'|'.join(NULL_TOKENS)})\s*$"


def strip(cell: Column) -> Column:
    """Trim all blanks; cells of plain ASCII, nearly all of them, take a four times faster trim."""
    is_ascii = F.octet_length(cell) == F.char_length(cell)
    return F.when(is_ascii, F.btrim(cell, F.lit(ASCII_BLANKS))).otherwise(
        F.btrim(cell, F.lit(BLANKS))
    )


def strip_quotes(cell: Column) -> Column:
    return F.btrim(cell, F.lit('"'))


def null_if_token(cell: Column, stripped: bool = False) -> Column:
    """Null for a "no value" token. A stripped cell is compared directly, mostly by its length."""
    if stripped:
        is_word = F.octet_length(cell) > _LONGEST_TOKEN
        return F.when(is_word | ~F.lower(cell).isin(*NULL_TOKENS), cell)
    return F.when(~cell.rlike(_NULL_CELL), cell)


def clean_cell(cell: Column, quotes: bool = True) -> Column:
    """Trim, drop stray quotes, then map "no value" tokens to null - in that order.

    Blanks that sat inside quotes survive on purpose; the column's own rule trims them.
    """
    if quotes:
        return null_if_token(strip_quotes(strip(cell)))
    return null_if_token(strip(cell), stripped=True)


def normalize_cells(df: DataFrame, quotes: bool = True) -> DataFrame:
    return df.select(
        *(
            clean_cell(F.col(f.name), quotes).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def upper_label(cell: Column) -> Column:
    return F.upper(strip(cell))


def repair_line(df: DataFrame, line: str, columns: Sequence[str], date_index: int) -> DataFrame:
    """Cut ``line`` at every comma into ``columns``, healing a date that contained commas.

    Surplus pieces are taken to belong to the date at ``date_index``: columns before it are
    counted from the left, columns after it from the right, and what lies between becomes the
    date with blanks for commas. Missing cells become ``''``. ``field_count`` is the number of
    pieces found, so callers can see which rows were repaired. Only string functions are used,
    which keeps the projection inside generated code (array lambdas would not be).
    """
    width = len(columns)
    after_date = width - date_index - 1
    pieces = df.withColumn("_pieces", F.split(F.col(line), ",", -1)).withColumn(
        "field_count", F.size("_pieces")
    )
    surplus = F.col("field_count") > width

    def piece(position) -> Column:
        return F.coalesce(F.get(F.col("_pieces"), position), F.lit(""))

    # The date's text runs from the end of the left columns to the start of the right ones.
    left = F.length(F.substring_index(F.col(line), ",", date_index)) + (1 if date_index else 0)
    if after_date:
        right = F.length(F.substring_index(F.col(line), ",", -after_date)) + 1
    else:
        right = F.lit(0)
    date_text = F.substring(F.col(line), left + 1, F.length(F.col(line)) - left - right)
    date_text = F.regexp_replace(date_text, r"(?U)\s*,\s*", " ")

    cells = []
    for i, name in enumerate(columns):
        if i < date_index:
            cell = piece(F.lit(i))
        elif i == date_index:
            cell = F.when(surplus, date_text).otherwise(piece(F.lit(i)))
        else:
            cell = F.when(surplus, piece(F.col("field_count") - (width - i))).otherwise(
                piece(F.lit(i))
            )
        cells.append(strip(cell).alias(name))
    keep = [c for c in df.columns if c != line]
    return pieces.select(*keep, *cells, "field_count")
