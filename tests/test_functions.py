import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from outlay.functions import dates, display, keys, money
from outlay.sources import windows


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column).collect()[0][0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("1.234.567,89", "1234567.89"),
        ("- 721,68", "-721.68"),
        ("721.68", "721.68"),
        ("12,345", "12.35"),
        ("12,344", "12.34"),
        ("0,00", "0.00"),
        ("1.234", "1.23"),
        ("", None),
        (None, None),
    ],
)
def test_brl_decimal(spark, text, expected):
    value = one(spark, money.brl_decimal(F.col("v")), text)
    assert value == (None if expected is None else Decimal(expected))


@pytest.mark.parametrize("text", [" ", "abc", "1,2,3"])
def test_brl_decimal_rejects_other_text(spark, text):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, money.brl_decimal(F.col("v")), text)
    assert one(spark, money.brl_decimal(F.col("v"), strict=False), text) is None


def br_text(value: Decimal) -> str:
    sign = "- " if value < 0 else ""
    return sign + f"{abs(value):,.2f}".translate(str.maketrans(",.", ".,"))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.decimals("-9999999999999999.99", "9999999999999999.99", places=2), min_size=1, max_size=50))
def test_brl_round_trip(spark, values):
    rows = spark.createDataFrame([(i, br_text(v)) for i, v in enumerate(values)], "i int, v string")
    parsed = rows.select("i", money.brl_decimal(F.col("v")).alias("v")).orderBy("i").collect()
    assert [row["v"] for row in parsed] == values


def test_safe_ratio(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (5.0, 4.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in rows.select(money.safe_ratio(F.col("a"), F.col("b"))).collect()] == [0.25, None, 1.25, None]


def test_surrogate_keys(spark):
    assert one(spark, keys.surrogate_key(F.col("v"), F.lit("x")), None) is None
    assert one(spark, keys.surrogate_key(F.lit("a"), F.lit("b"))) == one(spark, F.md5(F.lit("a|b")))


def test_election_calendar(spark):
    rows = spark.createDataFrame([(y,) for y in (2020, 2021, 2022, 2023, 2024, 2026)], "y int")
    year = F.col("y")
    found = rows.select(
        year, dates.is_election_year(year), dates.election_type(year), dates.mandate_year(year)
    ).collect()
    assert [tuple(r) for r in found] == [
        (2020, True, "Municipal", 2),
        (2021, False, None, 3),
        (2022, True, "Geral", 4),
        (2023, False, None, 1),
        (2024, True, "Municipal", 2),
        (2026, True, "Geral", 4),
    ]


def test_recency_bound_clamps_leap_day(spark):
    assert one(spark, dates.recency_bound("2024-02-29")) == datetime.date(2021, 2, 28)
    assert one(spark, dates.recency_bound("2026-07-20")) == datetime.date(2023, 7, 20)


def test_month_and_br_dates(spark):
    day = F.lit("2024-04-15").cast("date")
    assert one(spark, dates.month_label(day)) == "2024-04"
    assert one(spark, display.month_name(day)) == "abril de 2024"
    assert one(spark, dates.month_start(day)) == datetime.date(2024, 4, 1)
    assert one(spark, dates.parse_br_date(dates.br_date(day))) == datetime.date(2024, 4, 15)


@pytest.mark.parametrize(
    ("value", "expected"),
    [
        (None, "—"),
        (950.4, "R$ 950"),
        (1234.0, "R$ 1,2 mil"),
        (345_600_000.0, "R$ 345,6 mi"),
        (1_234_000_000.0, "R$ 1,2 bi"),
        (2_345_600_000_000.0, "R$ 2.345,6 bi"),
        (-5_000_000.0, "R$ -5,0 mi"),
        (0.0, "R$ 0"),
    ],
)
def test_format_reais(spark, value, expected):
    assert one(spark, display.format_reais(F.col("v")), value, "double") == expected


@pytest.mark.parametrize(
    ("value", "compact", "full"),
    [
        (None, "R$ 0", "R$ 0"),
        ("123.45", "R$ 123,5", "R$ 123"),
        ("5000000.00", "R$ 5 mi", "R$ 5.000.000"),
        ("999950.00", "R$ 1 mi", "R$ 999.950"),
        ("999949.99", "R$ 999,9 mil", "R$ 999.950"),
        ("44706441708.47", "R$ 44,7 bi", "R$ 44.706.441.708"),
        ("-1250000.50", "-R$ 1,3 mi", "-R$ 1.250.001"),
        ("1500000000000.00", "R$ 1,5 tri", "R$ 1.500.000.000.000"),
    ],
)
def test_site_currency(spark, value, compact, full):
    number = F.col("v").cast("decimal(18,2)")
    spaced = [text.replace(" ", " ") for text in (compact, full)]
    assert one(spark, display.compact_currency(number), value) == spaced[0]
    assert one(spark, display.full_currency(number), value) == spaced[1]


def test_small_texts(spark):
    assert one(spark, display.percent_text(F.lit(0.456))) == "46%"
    assert one(spark, display.percent_text(F.lit(0.285))) == "29%"
    assert one(spark, display.percent_text(F.lit(None).cast("double"))) == "—"
    assert one(spark, display.integer_text(F.lit(18723))) == "18.723"
    assert one(spark, display.integer_text(F.lit(None).cast("int"))) == "0"
    assert one(spark, display.short_label(F.lit(""), F.lit("Ministério"))) == "Ministério"
    assert one(spark, display.short_label(F.lit(None).cast("string"), F.lit("Ministério"))) == "Ministério"
    assert one(spark, display.short_label(F.lit("MS"), F.lit("Ministério"))) == "MS"
    assert one(spark, display.place_label(F.lit("Natal"), F.lit("RN"))) == "Natal (RN)"
    assert one(spark, display.released_share(F.lit(40.0), F.lit(100.0))) == 40.0
    assert one(spark, display.released_share(F.lit(40.0), F.lit(0.0))) == 0.0
    assert one(spark, display.released_share(F.lit(40.0), F.lit(None).cast("double"))) == 0.0
    assert one(spark, display.election_label(F.lit(None).cast("string"))) == "Sem eleição"


def test_year_lists(spark):
    assert one(spark, windows.parse_years(F.lit("2024, 2025,, "))) == [2024, 2025]
    assert one(spark, windows.default_years("2026-07-20")) == [2026, 2025, 2024]
    assert one(spark, windows.refresh_years("2026-07-20")) == [2026, 2025]


def test_default_and_rolling_windows(spark):
    assert one(spark, F.struct(*windows.default_window("2026-07-20"))) == (
        datetime.date(2026, 4, 21),
        datetime.date(2026, 7, 20),
    )
    assert one(spark, F.struct(*windows.rolling_window("2026-07-20"))) == (
        datetime.date(2026, 7, 14),
        datetime.date(2026, 7, 20),
    )


def spans(spark, start, end):
    ranges = spark.createDataFrame([(start, end)], "a date, b date")
    return [tuple(r) for r in windows.split_windows(ranges, "a", "b").orderBy("janela_inicio").collect()]


def test_split_windows_example(spark):
    d = datetime.date
    assert spans(spark, d(2024, 1, 1), d(2024, 3, 5)) == [
        (d(2024, 1, 1), d(2024, 1, 28)),
        (d(2024, 1, 29), d(2024, 2, 25)),
        (d(2024, 2, 26), d(2024, 3, 5)),
    ]
    assert spans(spark, d(2024, 3, 5), d(2024, 1, 1)) == []
    assert spans(spark, d(2024, 3, 5), d(2024, 3, 5)) == [(d(2024, 3, 5), d(2024, 3, 5))]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dates(datetime.date(2014, 1, 1), datetime.date(2030, 1, 1)), st.integers(0, 400))
def test_split_windows_cover_without_gap_or_overlap(spark, start, length):
    end = start + datetime.timedelta(days=length)
    found = spans(spark, start, end)
    assert found[0][0] == start and found[-1][1] == end
    assert all(0 <= (b - a).days <= 27 for a, b in found)
    assert all(nxt[0] - cur[1] == datetime.timedelta(days=1) for cur, nxt in zip(found, found[1:]))
