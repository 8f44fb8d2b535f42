"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfcast.columns import HORIZON


def week_of_month(date: Column) -> Column:
    """Week of the month, weeks start on Sunday, a partial first week is week 1."""
    first = F.dayofweek(F.trunc(date, "MM"))
    return (F.floor((F.dayofmonth(date) + first - 2) / 7) + 1).cast("int")


def week_of_year_simple(date: Column) -> Column:
    """Seven-day blocks counted from 1 January (not ISO weeks)."""
    return (F.floor((F.dayofyear(date) - 1) / 7) + 1).cast("int")


def date_parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "monthday": F.dayofmonth(date),
        "weekday": F.dayofweek(date),
        "quarter": F.quarter(date),
    }


def parse_us_date(text: Column) -> Column:
    """``month/day/year`` text to a date; text of another shape gives NULL."""
    return F.try_to_date(text, "M/d/yyyy")


def football_flags(weekday: Column, month: Column) -> dict[str, Column]:
    """Professional games on Sundays September to January, college on Saturdays
    September to December."""
    sunday = (weekday == "Sunday") & ((month > 8) | (month < 2))
    saturday = (weekday == "Saturday") & month.between(9, 12)
    return {
        "NFL_Sun": F.when(sunday, 1).otherwise(0),
        "NCAA_Sat": F.when(saturday, 1).otherwise(0),
    }


def shift_to_horizon(date: Column, days: int = HORIZON) -> Column:
    return F.date_add(date, days)
