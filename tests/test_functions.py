import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderloom.functions import numeric, status, temporal, text

CUSTOMER = ["customer_id", "first_name", "last_name", "email", "join_date", "city"]
LISTING = ["listing_id", "product_name", "category", "seller_id", "price", "stock", "listing_date"]


def repaired(spark, lines, columns, date_index):
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    rows = text.repair_line(df, "line", columns, date_index).orderBy("i").collect()
    return [[r[c] for c in columns] for r in rows], [r.field_count for r in rows]


def test_customer_lines_are_repaired_around_the_date(spark):
    lines = [
        "c1,A,B,a@x.org,2023-01-15,Oslo",
        "c2, A ,B,,Mar 05, 2023,  Oslo ",
        "c3,A,B,e,Mar,05 , ,2023,Oslo",
        "c4,A,B",
        "",
        ",,,,,,,,",
    ]
    cells, counts = repaired(spark, lines, CUSTOMER, 4)
    assert cells == [
        ["c1", "A", "B", "a@x.org", "2023-01-15", "Oslo"],
        ["c2", "A", "B", "", "Mar 05 2023", "Oslo"],
        ["c3", "A", "B", "e", "Mar 05  2023", "Oslo"],
        ["c4", "A", "B", "", "", ""],
        ["", "", "", "", "", ""],
        ["", "", "", "", "", ""],
    ]
    assert counts == [6, 7, 9, 3, 1, 9]


def test_listing_lines_merge_the_tail_into_the_date(spark):
    lines = [
        'L1,Lamp,Home,S1,"$9.99",5,2023-01-15',
        'L2,Monitor 27",Tech,S1,"$9.99",5,Mar 01, 2023',
        'L3,Lamp,Home,S1,"$1,299.00",5,2023-01-15',
        "L4,Lamp,Home",
    ]
    cells, _ = repaired(spark, lines, LISTING, 6)
    assert cells[1][6] == "Mar 01 2023"
    # A thousands comma shifts everything behind it; the date swallows the overflow.
    assert cells[2][4:] == ['"$1', '299.00"', "5 2023-01-15"]
    assert cells[3] == ["L4", "Lamp", "Home", "", "", "", ""]


def test_cells_are_trimmed_then_unquoted_then_nulled(column):
    given = [' "x" ', '" $25.00 "', 'Monitor 27"', '"', "\t x ", '" nan "', "　N/A "]
    assert column(text.clean_cell, given) == ["x", " $25.00 ", "Monitor 27", None, "x", None, None]


@pytest.mark.parametrize("token", ["", "  ", "nan", "NaN", "N/A", "na", "Null", "none", " NONE\t"])
def test_null_tokens(column, token):
    assert column(text.null_if_token, [token]) == [None]


def test_words_that_contain_tokens_survive(column):
    assert column(text.null_if_token, ["Nancy", "none such", "n a"]) == ["Nancy", "none such", "n a"]


def test_strip_matches_python(column):
    cells = ["".join(p) for p in (" a ", "\x1ca\x1f", " a b ", "é ", "a　b")]
    assert column(text.strip, cells) == [c.strip() for c in cells]


def test_mixed_dates(column):
    cases = {
        "2023-01-15": dt.date(2023, 1, 15),
        "2023-1-5": dt.date(2023, 1, 5),
        "02/20/2023": dt.date(2023, 2, 20),
        "2/3/2023": dt.date(2023, 2, 3),
        "Mar 05 2023": dt.date(2023, 3, 5),
        "march 5 2023": dt.date(2023, 3, 5),
        "Mar  05 2023": dt.date(2023, 3, 5),
        "MAY 3, 2023": dt.date(2023, 5, 3),
        "September 30, 2023": dt.date(2023, 9, 30),
        "25/12/2023": dt.date(2023, 12, 25),
        "2023-01-15 10:11:12": dt.date(2023, 1, 15),
        "2023-02-30": None,
        "02/30/2023": None,
        "13/40/2023": None,
        "soon": None,
        "": None,
        "10:30": None,
        None: None,
    }
    assert column(temporal.parse_mixed_date, list(cases)) == list(cases.values())


def test_mixed_datetimes(column):
    cases = {
        "2024-01-12 06:01:07": dt.datetime(2024, 1, 12, 6, 1, 7),
        "01/12/2024  07:01:07": dt.datetime(2024, 1, 12, 7, 1, 7),
        "7:59 AM Jan 14, 2024": dt.datetime(2024, 1, 14, 7, 59),
        "12:00 am January 14, 2024": dt.datetime(2024, 1, 14),
        "12:15 PM Jan 4, 2024": dt.datetime(2024, 1, 4, 12, 15),
        "2024-01-12T06:01:07": dt.datetime(2024, 1, 12, 6, 1, 7),
        "2024-01-12": dt.datetime(2024, 1, 12),
        "13/40/2024 00:00:00": None,
        "2024-01-12 25:00:00": None,
        "13:30 PM Jan 4, 2024": None,
    }
    assert column(temporal.parse_mixed_datetime, list(cases)) == list(cases.values())


def test_time_arithmetic(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
           (1, timestamp_ntz'2024-01-01 00:00:00', timestamp_ntz'2024-01-01 01:59:59'),
           (2, timestamp_ntz'2024-01-01 01:59:59', timestamp_ntz'2024-01-01 00:00:00'),
           (3, null, timestamp_ntz'2024-01-01 00:00:00') AS t(i, a, b)"""
    )
    rows = (
        df.select(
            "i",
            temporal.whole_hours_between(F.col("a"), F.col("b")).alias("h"),
            temporal.whole_minutes_between(F.col("a"), F.col("b")).alias("m"),
            temporal.hours_between(F.col("a"), F.col("b")).alias("f"),
        )
        .orderBy("i")
        .collect()
    )
    assert [(r.h, r.m) for r in rows] == [(1, 119), (-1, -119), (None, None)]
    assert rows[0].f == pytest.approx(7199 / 3600) and rows[1].f == -rows[0].f
    assert rows[2].f is None


def test_iso_text(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-12 06:01:07' a, timestamp_ntz'2024-01-12 06:01:07.5' b")
    shown = row.select(temporal.iso_utc(F.col("a")), temporal.iso_utc(F.col("b"))).first()
    assert list(shown) == ["2024-01-12T06:01:07+00:00", "2024-01-12T06:01:07.500000+00:00"]


def test_statuses(column):
    cases = {
        "Canceld": "CANCELLED",
        "shiped": "SHIPPED",
        "SHIPPD": "SHIPPED",
        "deliverd": "DELIVERED",
        "delvd": "UNKNOWN",
        "placedd": "PLACED",
        "replaced": "PLACED",
        "shipment cancelled": "CANCELLED",
        "": "UNKNOWN",
        None: "UNKNOWN",
    }
    assert column(status.normalize_status, list(cases)) == list(cases.values())


def test_numbers(column):
    cells = ["2", " 2.7 ", "abc", "", "1e3", "1d", "-.5", "12.", None, "99999999999"]
    assert column(numeric.to_number, cells) == [2, 2.7, None, None, 1000, None, -0.5, 12, None, 99999999999]
    assert column(numeric.to_whole_number, cells) == [
        2, None, None, None, 1000, None, None, 12, None, 99999999999,
    ]
    assert column(numeric.to_quantity, cells) == [2, 2, 0, 0, 1000, 0, 0, 12, 0, None]


def test_prices(column):
    cells = ["$12.50", " $25.00 ", "$1,299.00", "free", "$"]
    assert column(numeric.parse_price, cells) == [12.5, 25.0, 1299.0, None, None]


def test_repair_agrees_with_list_slicing_on_random_lines(spark):
    rng = random.Random(7)
    pieces = ["a", " b ", "", "  ", "Mar 05", "2023", '"q"', "x y", "\t"]
    lines = [",".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    for columns, date_index in ((CUSTOMER, 4), (LISTING, 6), (CUSTOMER, 0)):
        width, tail = len(columns), len(columns) - date_index - 1
        want = []
        for line in lines:
            cells = [c.strip() for c in line.split(",")]
            if len(cells) > width:
                end = len(cells) - tail
                cells = cells[:date_index] + [" ".join(cells[date_index:end])] + cells[end:]
            cells += [""] * (width - len(cells))
            want.append([c.strip() for c in cells])
        assert repaired(spark, lines, columns, date_index)[0] == want


def test_zones_twelve_hour_clocks_and_bare_times(column):
    given = {
        "2023-01-15T10:00:00Z": dt.datetime(2023, 1, 15, 10),
        "2023-01-15T10:00:00+00:00": dt.datetime(2023, 1, 15, 10),
        "2023-01-15 10:00:00 +02:00": dt.datetime(2023, 1, 15, 8),
        "2023-01-15T10:00:00.123456+0100": dt.datetime(2023, 1, 15, 9, 0, 0, 123456),
        "01/12/2024 07:01 PM": dt.datetime(2024, 1, 12, 19, 1),
        "Jan 14, 2024 7:59 AM": dt.datetime(2024, 1, 14, 7, 59),
        "2023-01-15 7:59 AM": dt.datetime(2023, 1, 15, 7, 59),
        "2023-01-15 17:59": dt.datetime(2023, 1, 15, 17, 59),
        "25/12/2023 07:01 PM": dt.datetime(2023, 12, 25, 19, 1),
        "T10:30": None,
        "10:30 AM": None,
        "T10:30:15.1234": None,
        "": None,
    }
    assert column(temporal.parse_mixed_datetime, list(given)) == list(given.values())


def test_full_times_in_usual_spellings_are_read_as_by_the_general_format(spark, column):
    cells = [
        "2021-03-05 07:08:09", "2021-03-05T07:08:09Z", "2021-03-05T07:08:09+00:00", "03/05/2021  07:08:09",
        "03/05/2021 07:08 PM", "Mar 05, 2021 12:08 AM", "12:05 AM Dec 31, 1999", "02/29/2020 07:08:09",
    ]
    odd = [
        "2021-02-30 07:08:09", "13/05/2021 07:08:09", "31/04/2021 07:08:09", "03/05/2021 13:08 PM",
        "2021-03-05 24:00:00", "Feb 30, 2021 7:08 AM", "0:05 AM Jan 01, 2000",
        "2021-03-05 07:08:09\n", "2021-03-05", "mar 5, 2021 7:08 am", "", None,
    ]

    def general(cell):
        return temporal._parse(F.trim(F.regexp_replace(cell, r"(?U)\s+", " ")))

    assert None not in (usual := column(temporal._usual, cells))
    assert usual == column(general, cells)
    assert column(temporal._usual, odd) == [None] * len(odd)
    assert column(temporal.parse_mixed_datetime, odd) == column(general, odd)
