import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillflow.functions import calendar, errors, money, text


def one(spark, **columns):
    row = spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()
    return row.asDict()


def test_both_weekday_numberings(spark):
    week = spark.sql("select explode(sequence(date'2024-01-07', date'2024-01-13')) as date")
    found = week.select(
        calendar.day_number(F.col("date")), calendar.day_index(F.col("date")),
        calendar.index_of_number(calendar.day_number(F.col("date"))),
        calendar.day_name(F.col("date")),
        calendar.day_name_of_number(calendar.day_number(F.col("date"))),
        calendar.weekend_flag(calendar.day_number(F.col("date"))),
        calendar.weekday_factor(F.col("date")),
    ).collect()
    assert [tuple(r) for r in found] == [
        (1, 6, 6, "Sun", "Sun", 1, 1.3), (2, 0, 0, "Mon", "Mon", 0, 0.9),
        (3, 1, 1, "Tue", "Tue", 0, 0.85), (4, 2, 2, "Wed", "Wed", 0, 0.9),
        (5, 3, 3, "Thu", "Thu", 0, 0.95), (6, 4, 4, "Fri", "Fri", 0, 1.2),
        (7, 5, 5, "Sat", "Sat", 1, 1.5),
    ]


def test_season_of_each_month(spark):
    months = spark.range(1, 13).select(F.make_date(F.lit(2024), F.col("id").cast("int"), F.lit(15)).alias("d"))
    found = months.select(
        F.month("d").alias("m"), calendar.season_factor(F.col("d")).alias("s"),
        calendar.holiday_flag(F.month("d")).alias("h"),
    ).collect()
    assert {r.m: r.s for r in found} == {m: {7: 1.15, 11: 1.6, 12: 1.6}.get(m, 1.0) for m in range(1, 13)}
    assert {r.m for r in found if r.h} == {11, 12}


def test_bad_date_becomes_null(spark):
    found = one(spark, good=calendar.parse_date(F.lit("2022-01-01")), bad=calendar.parse_date(F.lit("bad")))
    assert found == {"good": dt.date(2022, 1, 1), "bad": None}


def test_null_date_has_no_name(spark):
    assert one(spark, n=calendar.day_name(F.lit(None).cast("date"))) == {"n": None}


def test_padded_keys_are_never_cut(spark):
    found = spark.createDataFrame([(0,), (5,), (1234,)], "id long").select(
        text.padded_key("S", F.col("id"), 3).alias("key")
    ).collect()
    assert [r.key for r in found] == ["S000", "S005", "S1234"]


def test_discounted_amount_rounds_to_the_cent(spark):
    def amount(units, price, pct):
        return one(spark, a=money.discounted_amount(
            F.lit(units), F.lit(Decimal(price)).cast("decimal(18,2)"), F.lit(pct)))["a"]

    assert amount(3, "19.99", 15) == Decimal("50.97")  # 50.9745
    assert amount(1, "0.10", 5) == Decimal("0.10")  # 0.095, half up
    assert amount(7, "12.00", 0) == Decimal("84.00")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(
    st.integers(-1000, 100000), st.integers(0, 10**9), st.integers(0, 100)), min_size=1, max_size=40))
def test_cents_and_decimals_agree(spark, rows):
    df = spark.createDataFrame(rows, "units int, cents long, pct int")
    price = money.from_cents(F.col("cents"))
    both = df.select(
        money.discounted_amount(F.col("units"), price, F.col("pct")).alias("exact"),
        money.from_cents(money.discounted_cents(F.col("units"), F.col("cents"), F.col("pct"))).alias("cents"),
    ).collect()
    assert [r.exact for r in both] == [r.cents for r in both]


def test_adjusted_units_round_half_to_even_and_stay_positive(spark):
    found = spark.createDataFrame([(10, 0.85), (10, 0.95), (0, 1.0), (None, 1.0)], "u int, f double").select(
        money.adjusted_units(F.col("u"), F.col("f")).alias("n")
    ).collect()
    assert [r.n for r in found] == [8, 10, 1, None]  # 8.5 and 9.5 go to the even side


def test_discount_only_when_promoted(spark):
    found = one(spark, a=money.promoted_discount(F.lit(1), F.lit(25)), b=money.promoted_discount(F.lit(0), F.lit(25)))
    assert found == {"a": 25, "b": 0}


def test_money_as_double_keeps_nulls(spark):
    df = spark.sql("select cast(1.25 as decimal(18,2)) as a, cast(null as decimal(18,2)) as b, 'x' as c")
    out = money.money_as_double(df)
    assert out.dtypes == [("a", "double"), ("b", "double"), ("c", "string")]
    assert tuple(out.first()) == (1.25, None, "x")


def test_percent_error_of_zero_actual_is_zero(spark):
    assert one(spark, e=errors.percent_error(F.lit(0.0), F.lit(5.0)))["e"] == 0.0
    assert one(spark, e=errors.percent_error(F.lit(200.0), F.lit(150.0)))["e"] == 25.0


def test_direction_quality_and_tags(spark):
    assert one(spark, a=errors.direction(F.lit(0.0)), b=errors.direction(F.lit(-0.1))) == {"a": "over", "b": "under"}
    assert one(spark, a=errors.quality(F.lit(14.99)), b=errors.quality(F.lit(15.0))) == {"a": "good", "b": "poor"}
    tags = one(spark, a=errors.day_tags(F.lit(1), F.lit(1)), b=errors.day_tags(F.lit(0), F.lit(0)),
               c=errors.day_tags(F.lit(0), F.lit(1)))
    assert tags == {"a": ["Weekend", "Holiday season"], "b": [], "c": ["Holiday season"]}


def test_report_text(spark):
    found = one(spark, label=text.group_label(F.lit("North"), F.lit("Toys")),
                iso=text.iso_text(F.lit("2024-02-03").cast("date")), whole=text.figure(F.lit(1234567.891), 0),
                cents=text.figure(F.lit(1234567.891), 2))
    assert found == {"label": "North / Toys", "iso": "2024-02-03", "whole": "1,234,568", "cents": "1,234,567.89"}
