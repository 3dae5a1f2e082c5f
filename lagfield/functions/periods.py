"""Month arithmetic on integer ``YYYYMM`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def month_index(period: Column | str) -> Column:
    """Months since year 0, so neighbouring months differ by one."""
    p = as_col(period).cast("int")
    return (F.floor(p / 100) * 12 + F.pmod(p, F.lit(100)) - 1).cast("int")


def from_index(index: Column | str) -> Column:
    i = as_col(index)
    return (F.floor(i / 12) * 100 + F.pmod(i, F.lit(12)) + 1).cast("int")


def add_months(period: Column | str, months: int | Column) -> Column:
    step = F.lit(months) if isinstance(months, int) else months
    return from_index(month_index(period) + step)


def shift_period(period: int, months: int) -> int:
    """Plain-integer twin of :func:`add_months` for anchors and cuts."""
    index = (period // 100) * 12 + period % 100 - 1 + months
    return index // 12 * 100 + index % 12 + 1


def to_month_start(period: Column | str) -> Column:
    return F.to_date(as_col(period).cast("string"), "yyyyMM")


def to_month_timestamp(period: Column | str) -> Column:
    return to_month_start(period).cast("timestamp_ntz")


def period_of(date: Column | str) -> Column:
    d = as_col(date)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def month_of(period: Column | str) -> Column:
    return F.pmod(as_col(period).cast("int"), F.lit(100)).cast("int")


def year_of(period: Column | str) -> Column:
    return F.floor(as_col(period).cast("int") / 100).cast("int")
