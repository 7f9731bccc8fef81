import datetime as dt

import pytest
from pyspark.sql import functions as F

from shortfall.functions import dates, nulls, text
from shortfall.functions.dates import Period


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(name) for name, c in cols.items()]).first()


@pytest.mark.parametrize(
    "as_of, end",
    [
        (dt.date(1998, 6, 29), dt.date(1998, 6, 27)),  # Monday
        (dt.date(1998, 6, 28), dt.date(1998, 6, 20)),  # Sunday: yesterday is Saturday itself
        (dt.date(1998, 7, 4), dt.date(1998, 6, 27)),
        (dt.date(2017, 1, 3), dt.date(2016, 12, 31)),
    ],
)
def test_period_is_the_last_full_week(spark, as_of, end):
    period = Period.ending_before(as_of)
    assert (period.wk_end, period.wk_start) == (end, end - dt.timedelta(days=6))
    df = dates.reporting_period(spark.createDataFrame([(as_of,)], "as_of date"), "as_of")
    row = df.first()
    assert (row.wk_end, row.wk_start) == (period.wk_end, period.wk_start)
    assert (row.ru_week, row.ru_year) == (period.week, period.year)
    assert row.week_start_date_key == period.start_key


@pytest.mark.parametrize(
    "day, block, legacy",
    [("2017-01-07", 1, 2), ("2016-12-31", 53, 53), ("2017-01-01", 1, 1), ("2017-12-31", 53, 53)],
)
def test_week_numbers_around_year_end(spark, day, block, legacy):
    d = dt.date.fromisoformat(day)
    row = one(
        spark,
        b=dates.week_of_year(F.lit(d)),
        lg=dates.week_of_year(F.lit(d), "legacy"),
    )
    assert (row.b, row.lg) == (block, legacy)
    assert Period(d, d).week == block
    assert Period(d, d, "legacy").week == legacy


def test_bad_period_is_refused():
    with pytest.raises(ValueError):
        Period(dt.date(2020, 1, 2), dt.date(2020, 1, 1))
    with pytest.raises(ValueError):
        Period(dt.date(2020, 1, 1), dt.date(2020, 1, 2), "iso")


def test_dates_that_do_not_parse_are_null(spark):
    row = one(
        spark,
        bad=dates.parse_date(F.lit(20170230), "yyyyMMdd"),
        good=dates.parse_date(F.lit(20170228), "yyyyMMdd"),
        slashes=dates.parse_date(F.lit("05/06/2017"), "dd/MM/yyyy"),
        word=dates.parse_date(F.lit("soon")),
    )
    assert row.bad is None and row.word is None
    assert row.good == dt.date(2017, 2, 28) and row.slashes == dt.date(2017, 6, 5)


def test_sums_and_counts_with_missing_values(spark, rows):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("b", 2.0), ("b", 3.0), ("c", None)], "k string, v double"
    )
    got = rows(
        df.groupBy("k").agg(
            nulls.strict_sum("v").alias("strict"),
            nulls.sum_or_zero("v").alias("loose"),
            nulls.count_distinct_na("v").alias("n"),
        ),
        "k",
    )
    assert [got[k]["strict"] for k in "abc"] == [None, 5.0, None]
    assert [got[k]["loose"] for k in "abc"] == [1.0, 5.0, 0.0]
    assert [got[k]["n"] for k in "abc"] == [2, 2, 1]


def test_minimum_and_condition_propagate_missing_values(spark):
    none = F.lit(None).cast("double")
    row = one(
        spark,
        low=nulls.strict_least(F.lit(1.0), none),
        high=nulls.strict_greatest(F.lit(1.0), F.lit(2.0)),
        beyond=nulls.excess(F.lit(1.0), F.lit(2.0)),
        unknown=nulls.excess(none, F.lit(2.0)),
        choice=nulls.if_else(none > 1, F.lit("y"), F.lit("n")),
    )
    assert row.low is None and row.unknown is None and row.choice is None
    assert row.high == 2.0 and row.beyond == 0.0


def test_null_safe_join(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    right = spark.createDataFrame([("a", 10), (None, 20)], "j string, w int")
    got = nulls.null_safe_join(left, right, [("k", "j")])
    assert sorted(got.columns) == ["k", "v", "w"]
    assert {r.v: r.w for r in got.collect()} == {1: 10, 2: 20, 3: None}
    semi = nulls.null_safe_join(left, right, [("k", "j")], "left_semi")
    assert {r.v for r in semi.collect()} == {1, 2}


def test_text_helpers(spark):
    row = one(
        spark,
        first=text.first_of_list(F.lit("x,y,z")),
        single=text.first_of_list(F.lit("x")),
        missing=text.first_of_list(F.lit(None).cast("string")),
        num=text.to_number(F.lit("NULL")),
    )
    assert (row.first, row.single, row.missing, row.num) == ("x", "", None, None)
    flags = spark.createDataFrame([("true",), ("TRUE",), ("1",), ("false",), (None,)], "f string")
    assert [r[0] for r in flags.select(text.is_true("f")).collect()] == [
        True, True, True, False, None,
    ]
    assert text.strip_qualifiers(spark.range(1).toDF("t.id")).columns == ["id"]


def test_week_days_are_the_days_of_the_week_number():
    for rule in ("block", "legacy"):
        for day in (dt.date(2016, 12, 31), dt.date(2017, 1, 1), dt.date(2017, 1, 7), dt.date(2017, 6, 3)):
            first, last = Period(day, day, rule).week_days
            numbers = {
                k: Period(k, k, rule).week
                for k in (dt.date(day.year, 1, 1) + dt.timedelta(n) for n in range(365))
            }
            week = [k for k, number in numbers.items() if number == Period(day, day, rule).week]
            assert first == week[0] and last >= week[-1] and last.year == day.year
