"""Reporting period, week numbers and date keys."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: ``block``: seven-day blocks counted from 1 January.
#: ``legacy``: the same blocks ending one day early (day 7 is in week 2).
WEEK_RULES = ("block", "legacy")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


@dataclass(frozen=True)
class Period:
    """The span a run reports on; every operator takes it as an argument."""

    wk_start: dt.date
    wk_end: dt.date
    week_rule: str = "block"

    def __post_init__(self):
        if self.week_rule not in WEEK_RULES:
            raise ValueError(f"week_rule must be one of {WEEK_RULES}")
        if self.wk_start > self.wk_end:
            raise ValueError("wk_start is after wk_end")

    @classmethod
    def ending_before(cls, as_of: dt.date, week_rule: str = "block") -> Period:
        """Sunday-to-Saturday week that was complete on the day before ``as_of``."""
        yesterday = as_of - dt.timedelta(days=1)
        wk_end = yesterday - dt.timedelta(days=yesterday.isoweekday() % 7 + 1)
        return cls(wk_end - dt.timedelta(days=6), wk_end, week_rule)

    def shift(self, base: str, days: int) -> dt.date:
        """``wk_start`` or ``wk_end`` moved by a number of days."""
        return getattr(self, base) + dt.timedelta(days=days)

    @property
    def week(self) -> int:
        day = self.wk_end.timetuple().tm_yday
        return (day - 1) // 7 + 1 if self.week_rule == "block" else day // 7 + 1

    @property
    def week_days(self) -> tuple[dt.date, dt.date]:
        """First and last day of the seven-day block that ``week`` numbers."""
        new_year, before = dt.date(self.year, 1, 1), 0 if self.week_rule == "block" else 1
        first = new_year + dt.timedelta(days=7 * (self.week - 1) - before)
        last = first + dt.timedelta(days=6)
        return max(first, new_year), min(last, dt.date(self.year, 12, 31))

    @property
    def year(self) -> int:
        return self.wk_end.year

    @property
    def start_key(self) -> int:
        return int(self.wk_start.strftime("%Y%m%d"))

    @property
    def end_key(self) -> int:
        return int(self.wk_end.strftime("%Y%m%d"))


def week_of_year(d: Column | str, rule: str = "block") -> Column:
    """Week number in seven-day blocks from 1 January (not ISO weeks)."""
    day = F.dayofyear(_col(d))
    offset = {"block": 1, "legacy": 0}[rule]
    return (F.floor((day - offset) / 7) + 1).cast("int")


def date_key(d: Column | str) -> Column:
    """Date as the integer yyyymmdd."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def parse_date(c: Column | str, fmt: str | None = None) -> Column:
    """Text or integer to date; null where it does not parse."""
    text = _col(c).cast("string")
    return F.try_to_date(text, fmt) if fmt else F.try_to_date(text)


def last_saturday_before(d: Column | str) -> Column:
    """Last Saturday strictly before the date."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d))


def sunday_on_or_before(d: Column | str) -> Column:
    return F.date_sub(F.next_day(_col(d), "Sunday"), 7)


def days_between(later: Column | dt.date, earlier: Column | dt.date) -> Column:
    """Whole days from ``earlier`` to ``later``; compare it with fractional lead times."""
    as_col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.datediff(as_col(later), as_col(earlier))


def reporting_period(df: DataFrame, as_of: str, week_rule: str = "block") -> DataFrame:
    """Add the period that a run on the date column ``as_of`` would report."""
    wk_end = last_saturday_before(F.date_sub(F.col(as_of), 1))
    return (
        df.withColumn("wk_end", wk_end)
        .withColumn("wk_start", F.date_sub("wk_end", 6))
        .withColumn("ru_week", week_of_year("wk_end", week_rule))
        .withColumn("ru_year", F.year("wk_end"))
        .withColumn("week_start_date_key", date_key("wk_start"))
    )
