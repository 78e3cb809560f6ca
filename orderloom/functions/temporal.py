"""Mixed-format date and time parsing, and time arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted formats. Each bracket is an optional section of one pattern, tried
# at the current position, so any mix is parsed in a single pass. Trying the formats one by one
# would raise and catch an exception per miss. Slash dates are month-first; the day-first twin
# applies only when the month-first reading is impossible.
CLOCK = "[h:m a ]"
DATES = (
    "[yyyy-M-d]"
    "[M/d/yyyy]"
    "[MMM d[,] yyyy]"
    "[MMMM d[,] yyyy]"
    "[yyyy/M/d]"
    "[d MMM yyyy]"
    "[d MMMM yyyy]"
)
TIMES = "[ h:m[:s] a][ H:m[:s[.SSSSSS][.SSS]]]['T'H:m[:s[.SSSSSS][.SSS]]][ XXX][XXX][XX]"
# A year: every accepted date has one, no time of day does.
DATED = "(^|[^0-9.:])[0-9]{4}([^0-9]|$)"
DAY_FIRST = "d/M/yyyy"
DAY_FIRST_SHAPE = "^(1[3-9]|2[0-9]|3[01])/"
# Full times in their usual spellings. A text of one of these shapes is read by its own
# format, which costs a fraction of one with optional sections.
_DATE_TIME = (
    r"\A(?:([0-9]{2})/([0-9]{2})/([1-9][0-9]{3}) +|([1-9][0-9]{3})-([0-9]{2})-([0-9]{2})[ T])"
    r"([0-9]{2}:[0-9]{2}:[0-9]{2})(?:Z|[+]00:00)?\z"
)
_AS_ISO = "$3$4-$1$5-$2$6 $7"
_TWELVE = "(?:0?[1-9]|1[0-2]):[0-9]{2} [AP]M"
_NAMED = "(?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) [0-9]{2}, [1-9][0-9]{3}"
USUAL_CLOCKS = (
    (rf"\A{_NAMED} {_TWELVE}\z", "MMM d, yyyy h:m a"),
    (rf"\A{_TWELVE} {_NAMED}\z", "h:m a MMM d, yyyy"),
    (rf"\A[0-9]{{2}}/[0-9]{{2}}/[1-9][0-9]{{3}} {_TWELVE}\z", "M/d/yyyy h:m a"),
)


def _parse(text: Column) -> Column:
    parsed = F.coalesce(
        F.try_to_timestamp(text, F.lit(CLOCK + DATES + TIMES)),
        F.when(
            text.rlike(DAY_FIRST_SHAPE), F.try_to_timestamp(text, F.lit(DAY_FIRST + TIMES))
        ),
    )
    # Every section is optional, so an empty text or a bare time would match. A zone suffix makes
    # an instant, which the session's UTC clock shows.
    return F.when(text.rlike(DATED), parsed).cast("timestamp_ntz")


def _usual(cell: Column) -> Column:
    """The time in a text of a usual shape; null for any other text, and for times there are not.

    Kept short: the JVM compiles only methods of limited size, and Spark puts a projection into one.
    """
    shapes = [(_DATE_TIME, F.regexp_replace(cell, _DATE_TIME, _AS_ISO).try_cast("timestamp_ntz"))]
    for shape, form in USUAL_CLOCKS:
        shapes.append((shape, F.try_to_timestamp(cell, F.lit(form)).cast("timestamp_ntz")))
    return F.coalesce(*(F.when(cell.rlike(shape), time) for shape, time in shapes))


def parse_mixed_datetime(cell: Column) -> Column:
    """Zone-less timestamp from any accepted format; a bare date means midnight; else null."""
    other = _parse(F.trim(F.regexp_replace(cell, r"(?U)\s+", " ")))
    return F.coalesce(_usual(cell), other)


def parse_mixed_date(cell: Column) -> Column:
    """Date from any accepted format; a date-time text yields its date; else null."""
    return parse_mixed_datetime(cell).cast("date")


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def iso_seconds(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss")


def iso_utc(value: Column) -> Column:
    """ISO-8601 text with the UTC offset, e.g. 2024-01-12T06:01:07+00:00.

    The fraction shows only when there is one.
    """
    whole = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(value, "SSSSSS")
    return F.concat(whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""),
                    F.lit("+00:00"))


def month_start(value: Column) -> Column:
    """First day of the month as text, which also sorts chronologically."""
    return F.date_format(value, "yyyy-MM-01")


def whole_hours_between(start: Column, end: Column) -> Column:
    """Complete hours, truncated toward zero."""
    return F.timestamp_diff("HOUR", start, end)


def whole_minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def _micros(value: Column) -> Column:
    return F.unix_micros(value.cast("timestamp"))


def hours_between(start: Column, end: Column) -> Column:
    """Fractional hours; null when either side is missing, negative when out of order."""
    return (_micros(end) - _micros(start)) / F.lit(3.6e9)
