"""Timestamp arithmetic with calendar-boundary semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dayledger.fixed_values import WEEKDAY_LABELS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parsed(name: str) -> Column:
    """Text to timestamp; what cannot be read becomes NULL instead of failing the job."""
    return F.try_to_timestamp(F.col(name))


def day_of(c: Column | str) -> Column:
    return F.to_date(_col(c))


def monday_of(c: Column | str) -> Column:
    day = day_of(c)
    return F.date_sub(day, F.weekday(day))


def iso_weekday(c: Column | str) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(_col(c)) + 1


def weekday_label(c: Column | str) -> Column:
    return F.element_at(F.array(*map(F.lit, WEEKDAY_LABELS)), iso_weekday(c))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second difference; fractions are dropped from both ends first."""
    return F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Number of midnights crossed."""
    return F.datediff(day_of(end), day_of(start))


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Number of full hours on the clock crossed: 00:59 to 01:01 is one."""
    return F.floor(F.unix_timestamp(_col(end)) / 3600) - F.floor(
        F.unix_timestamp(_col(start)) / 3600
    )


def weeks_between(start: Column | str, end: Column | str) -> Column:
    """Number of Mondays crossed."""
    return (F.datediff(monday_of(end), monday_of(start)) / 7).cast("int")


def days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def hours(n: int) -> Column:
    return F.make_dt_interval(hours=F.lit(n))
