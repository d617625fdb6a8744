from datetime import datetime, timedelta
from decimal import Decimal, InvalidOperation
from random import Random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tributary import functions as fn
from tributary.schemas import PARSED_AMOUNT


def dec(text):
    return Decimal(text)


# --- SKU -----------------------------------------------------------------------


def test_sku_outer_blanks_and_inner_runs(values):
    texts = ["k77/b", "\tk77/b", "k77/b\n ", "q \t q", "7     8 9", "\r\n k77/b \r", "K77/B", "\x0bm\x0c n\x0b"]
    assert values(fn.clean_sku, texts) == ["k77/b", "k77/b", "k77/b", "q q", "7 8 9", "k77/b", "K77/B", "m n"]


def test_sku_empty_and_null_become_null(values):
    assert values(fn.clean_sku, [None, "\n\t ", "", "\r"]) == [None] * 4


def test_sku_key_folds_case_and_trims_only_outside(values):
    assert values(fn.sku_key, ["\tQr  9Z ", "w\x1f", None]) == ["qr  9z", "w", None]


# --- money ---------------------------------------------------------------------


def test_money_plain_signs_and_separators(values):
    texts = ["3.05", "640.00", "0.07", "\t8.11 ", "$71.3", "PEN 6.4", "2,034.56", "78,901,234.5"]
    expected = ["3.05", "640", "0.07", "8.11", "71.3", "6.4", "2034.56", "78901234.5"]
    assert values(fn.parse_money, texts) == [dec(e) for e in expected]


def test_money_garbage_becomes_null(values):
    assert values(fn.parse_money, ["n/a", "€€", "", "\t", None, "--", "7-7", "8.8.8", "44-"]) == [None] * 9


def test_money_keeps_digits_between_letters(values):
    texts = ["no 55", "(8.40)", "4e2", "-61.05", "-7,654.10", ".25", "9."]
    expected = ["55", "8.4", "42", "-61.05", "-7654.1", "0.25", "9"]
    assert values(fn.parse_money, texts) == [dec(e) for e in expected]


def test_money_currency_sign_with_a_dot_is_not_a_number(values):
    assert values(fn.parse_money, ["S/. 6.35", "S/ 6.35"]) == [None, dec("6.35")]


def test_money_other_digits_are_not_dropped(values):
    assert values(fn.parse_money, ["1١"]) == [None]


def test_money_decimal_comma(values):
    def comma(c):
        return fn.parse_money(c, ",")

    assert values(comma, ["4.031,70", "0,2", "-8,45"]) == [dec("4031.7"), dec("0.2"), dec("-8.45")]
    assert values(fn.parse_money, ["4.031,70"]) == [dec("4.0317")]


def test_to_usd_rounds_half_up_to_four_places(table):
    rows = [("19.90", "1"), ("100", "1"), ("75", "0.2667"), ("10.123456", "1"), ("0.00005", "1")]
    df = table("amount string, rate string", rows).select(
        fn.to_usd(F.col("amount").cast(PARSED_AMOUNT), F.col("rate").cast("decimal(12,6)")).alias("usd")
    )
    expected = ["19.9", "100", "20.0025", "10.1235", "0.0001"]
    assert [r.usd for r in df.collect()] == [dec(e) for e in expected]


# --- whole numbers ---------------------------------------------------------------


def test_int_signs_kept(values):
    assert values(fn.parse_int, ["1", "2", "100", "42", "-1", "-3", " 7 ", "2.0", "1e2"]) == [
        1, 2, 100, 42, -1, -3, 7, 2, 100,
    ]


def test_int_garbage_and_fractions_become_null(values):
    assert values(fn.parse_int, ["abc", None, "", "1.5", "1d", "NaN", "Infinity", "1 2"]) == [None] * 8


# --- time ------------------------------------------------------------------------


def test_iso_offsets_and_utc_default(values):
    texts = [
        "2024-03-15T10:30:00-05:00",
        "2024-03-15T15:30:00+00:00",
        "2024-03-15T15:30:00Z",
        "2024-03-15 15:30:00",
        "20240315T153000",
        "20240315T153000Z",
        "2024-03-15T15:30",
    ]
    assert values(fn.iso_to_utc, texts) == [datetime(2024, 3, 15, 15, 30)] * 7


def test_iso_dates_and_bad_text(values):
    assert values(fn.iso_to_utc, ["2024-03-15", "20240315"]) == [datetime(2024, 3, 15)] * 2
    bad = [None, "not a date", "10:30", "2024-3-5", " 2024-03-15", "2024-13-01", "15/03/2024"]
    assert values(fn.iso_to_utc, bad) == [None] * 7


def lima(c):
    return fn.naive_to_utc(c, "America/Lima")


def test_naive_lima(values):
    texts = ["2024-03-15 10:30:00", "2024-03-15 23:59:59", None, "x", "2024-03-15T10:30:00-05:00"]
    assert values(lima, texts) == [
        datetime(2024, 3, 15, 15, 30), datetime(2024, 3, 16, 4, 59, 59), None, None, None,
    ]


def test_dmy_lima_midnight(values):
    texts = ["15/03/2024", "5/3/2024", "31/02/2024", "2024-03-15", "15/03/24", "15/03/2024 x", None]
    expected = [datetime(2024, 3, 15, 5), datetime(2024, 3, 5, 5)] + [None] * 5
    assert values(lambda c: fn.dmy_to_utc(c, "America/Lima"), texts) == expected


def unambiguous_utc(wall, zone):
    """Brute force: all instants around that show this wall time."""
    shown = set()
    for minutes in range(-14 * 60, 14 * 60 + 1, 30):
        instant = (wall + timedelta(minutes=minutes)).replace(tzinfo=ZoneInfo("UTC"))
        if instant.astimezone(zone).replace(tzinfo=None) == wall:
            shown.add(instant.replace(tzinfo=None))
    return shown.pop() if len(shown) == 1 else None


@pytest.mark.parametrize("name", ["America/New_York", "Australia/Lord_Howe", "Europe/Madrid"])
def test_clock_changes_against_brute_force(values, name):
    zone = ZoneInfo(name)
    starts = [datetime(2024, 3, 9), datetime(2024, 3, 30), datetime(2024, 4, 6),
              datetime(2024, 10, 5), datetime(2024, 10, 26), datetime(2024, 11, 2)]
    walls = [s + timedelta(minutes=30 * i) for s in starts for i in range(96)]
    texts = [w.strftime("%Y-%m-%d %H:%M:%S") for w in walls]
    got = values(lambda c: fn.naive_to_utc(c, name), texts)
    expected = [unambiguous_utc(w, zone) for w in walls]
    assert expected.count(None) >= 2
    assert got == expected


# --- calendar and JSON --------------------------------------------------------------


def test_calendar_parts_at_year_edges(table):
    days = ["2024-12-30", "2027-01-01", "2024-02-29", "2024-03-16", "2024-09-01"]
    df = table("d string", [(d,) for d in days]).select(
        *fn.calendar_parts(F.col("d").cast("date"))
    )
    rows = [tuple(r) for r in df.collect()]
    assert rows[0] == (2024, 4, 12, "Diciembre", 30, 1, "Lunes", 1, False)
    assert rows[1] == (2027, 1, 1, "Enero", 1, 5, "Viernes", 53, False)
    assert rows[2] == (2024, 1, 2, "Febrero", 29, 4, "Jueves", 9, False)
    assert rows[3][5:7] == (6, "Sábado") and rows[3][8] is True
    assert rows[4] == (2024, 3, 9, "Septiembre", 1, 7, "Domingo", 35, True)


def test_row_json_writes_nulls_and_nan_as_null(spark, table):
    df = table("a int, b string, c string", [(1, None, "x\"y")]).withColumns(
        {"d": F.lit(float("nan")), "e": F.lit("1.50").cast("decimal(12,4)"), "f": F.lit(True)}
    )
    assert df.select(fn.row_json(df)).first()[0] == (
        '{"a":1,"b":null,"c":"x\\"y","d":null,"e":"1.5000","f":true}'
    )


# --- against brute force -------------------------------------------------------------


def test_every_white_space_character(values):
    spaces = [chr(i) for i in range(0x10000) if chr(i).isspace()]
    texts = [f"{s}A{s}{s}b{s}" for s in spaces]
    assert values(fn.clean_sku, texts) == ["A b"] * len(spaces)
    assert values(fn.sku_key, texts) == [f"a{s}{s}b" for s in spaces]


def test_random_money_texts(values):
    random = Random(7)
    texts = ["".join(random.choices("0123456789.,-$ aS/()e", k=random.randint(0, 9))) for _ in range(3000)]

    def model(text):
        kept = "".join(c for c in text if c in "0123456789.-")
        try:
            return Decimal(kept)
        except InvalidOperation:
            return None

    assert values(fn.parse_money, texts) == [model(t) for t in texts]


def test_random_whole_numbers(values):
    random = Random(8)
    texts = ["".join(random.choices("0123456789.-+ e", k=random.randint(0, 5))) for _ in range(3000)]

    def model(text):
        try:
            value = float(text.strip(" "))
        except ValueError:
            return None
        return int(value) if value.is_integer() and abs(value) < 1e18 else None

    got = values(fn.parse_int, texts)
    assert [g for g, t in zip(got, texts) if "e" not in t] == [model(t) for t in texts if "e" not in t]


def test_amounts_beyond_the_parsed_range_are_null_and_told_from_garbage(spark):
    from tributary.functions.money import beyond_range, line_total

    texts = ["12345678901234567890", "-99999999999999999999.5", "000000000000000000000007", "1e30", "--" + "9" * 20, None]
    rows = spark.createDataFrame(list(enumerate(texts)), "place int, text string")
    text = F.col("text")
    found = rows.orderBy("place").select(fn.parse_money(text).alias("x"), beyond_range(text).alias("beyond")).collect()
    assert [r.x and str(r.x) for r in found] == [None, None, "7.0000000000", "130.0000000000", None, None]
    assert [r.beyond for r in found] == [True, True, False, False, False, False]
    price, quantity = F.lit(1_000_000).cast("decimal(28,10)"), F.lit(7501234567890).cast("bigint")
    assert spark.range(1).select(line_total(price, quantity, 4).alias("x")).first().x is None
