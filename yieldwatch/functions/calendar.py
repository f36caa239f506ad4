"""Calendar columns of a date, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_fields(date: Column) -> dict[str, Column]:
    """Integer date parts; weeks are ISO weeks and Monday is day 0."""
    return {
        "day_of_week": F.weekday(date),
        "day_of_month": F.dayofmonth(date),
        "day_of_year": F.dayofyear(date),
        "month": F.month(date),
        "quarter": F.quarter(date),
        "year": F.year(date),
        "week_of_year": F.weekofyear(date),
    }


def cyclical_encoding(date: Column) -> dict[str, Column]:
    """Sine and cosine of the weekday (0-6) and of the month (1-12)."""
    weekday_angle = 2 * F.pi() * F.weekday(date) / 7
    month_angle = 2 * F.pi() * F.month(date) / 12
    return {
        "day_of_week_sin": F.sin(weekday_angle),
        "day_of_week_cos": F.cos(weekday_angle),
        "month_sin": F.sin(month_angle),
        "month_cos": F.cos(month_angle),
    }


def calendar_flags(date: Column) -> dict[str, Column]:
    """Weekend, month-end and quarter-end as 0/1."""
    month_end = F.last_day(date) == date.cast("date")
    return {
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
        "is_month_end": month_end.cast("int"),
        "is_quarter_end": (month_end & (F.month(date) % 3 == 0)).cast("int"),
    }


def calendar_columns(date: Column) -> dict[str, Column]:
    """All 14 calendar features in table order."""
    return {**calendar_fields(date), **cyclical_encoding(date), **calendar_flags(date)}


def is_business_day(date: Column) -> Column:
    return F.weekday(date) < 5
