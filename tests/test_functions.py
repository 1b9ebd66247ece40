from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import dates, numbers, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{k} {kind(v)}" for k, v in values.items()
    ))
    return df.select(column).first()[0]


def kind(value):
    return {
        str: "string", int: "bigint", float: "double", date: "date", datetime: "timestamp",
        Decimal: "decimal(12,4)", type(None): "string",
    }[type(value)]


@pytest.mark.parametrize(
    "item, name, info",
    [
        ("Trail-9 Blue, 48", "Trail-9 Blue", "48"),
        ("Pump", "Pump", ""),
        ("Sock, ", "Sock", ""),
        ("A, B, C", "A", "B"),
        ("", "", ""),
        (None, None, ""),
    ],
)
def test_item_parts(spark, item, name, info):
    assert one(spark, text.item_name(F.col("i")), i=item) == name
    assert one(spark, text.item_info(F.col("i")), i=item) == info


@pytest.mark.parametrize(
    "full, first, last",
    [("Ada Lane", "Ada", "Lane"), ("Ben Van Dyk", "Ben", "Van"), ("Cher", "Cher", None)],
)
def test_names(spark, full, first, last):
    assert one(spark, text.first_name(F.col("n")), n=full) == first
    assert one(spark, text.last_name(F.col("n")), n=full) == last


def test_blank_and_label(spark):
    assert one(spark, text.blank_to(F.col("x"), "Unknown"), x="") == "Unknown"
    assert one(spark, text.blank_to(F.col("x"), "Unknown"), x=None) == "Unknown"
    assert one(spark, text.blank_to(F.col("x"), "Unknown"), x=" ") == " "
    label = text.label(F.col("n"), " @", F.col("s"))
    assert one(spark, label, n=3, s="BP_1") == "3 @BP_1"
    assert one(spark, label, n=None, s="BP_1") == " @BP_1"


def test_dates(spark):
    day = date(2021, 3, 9)
    assert one(spark, dates.date_key(F.col("d")), d=day) == 20210309
    assert one(spark, dates.year_text(F.col("d")), d=day) == "2021"
    assert one(spark, dates.slash_year(F.col("d")), d=day) == "2021"
    at = datetime(2021, 3, 9, 23, 59, 59)
    assert one(spark, dates.day_bin(F.col("t")), t=at) == datetime(2021, 3, 9)


def test_recency_is_strict(spark):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    check = dates.newer_than(F.col("t"), now, "1 hour")
    assert one(spark, check, t=datetime(2024, 1, 1, 11, 0, 0)) is False
    assert one(spark, check, t=datetime(2024, 1, 1, 11, 0, 1)) is True


def test_fill_rate_of_nothing_is_null(spark):
    rate = numbers.fill_rate(F.col("a"), F.col("b"))
    assert one(spark, rate, a=0, b=0) is None
    assert one(spark, rate, a=1, b=3) == 0.25


def test_whole_percent_is_exact(spark):
    assert one(spark, numbers.whole_percent(F.col("d")), d=0.29) == 29
    assert one(spark, numbers.whole_percent(F.col("d")), d=Decimal("0.155")) == 15


def test_coarser_rounds_half_away_from_zero(spark):
    got = {u: one(spark, numbers.coarser(F.col("u")), u=u) for u in (149, 150, -149, -150, 0)}
    assert got == {149: 1, 150: 2, -149: -1, -150: -2, 0: 0}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 10**9), min_size=1, max_size=50))
def test_exact_sum_is_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "amount double")
    total = df.agg(numbers.exact_sum(F.col("amount"))).first()[0]
    assert total == Decimal(sum(cents)) / 100


def test_cents_to_units(spark):
    assert one(spark, numbers.cents_to_units(F.col("c")), c=1050) == Decimal("10.50")


def test_as_of_default_is_newest(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1),), (datetime(2024, 1, 3),), (None,)], "t timestamp"
    )
    assert rows(df.select(dates.as_of(df, "t")).distinct()) == [(datetime(2024, 1, 3),)]
    assert df.select(dates.as_of(df, "t", "2020-01-01")).first()[0] == datetime(2020, 1, 1)


def test_units_are_exact_or_an_error(spark):
    assert one(spark, numbers.units(F.col("x")), x=90071992547409.0) == 9007199254740900
    assert one(spark, numbers.units(F.col("x")), x=-1.005) == -100
    with pytest.raises(Exception, match="too large"):
        one(spark, numbers.units(F.col("x")), x=1e15)
