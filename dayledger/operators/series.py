"""Daily series, calendars and dense axes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from dayledger.fixed_values import PAYDAYS_OF_MONTH, PROMO_DAY, PUBLIC_HOLIDAYS
from dayledger.functions.moments import day_of


def trailing_mean(
    daily: DataFrame, day: str, values: Iterable[str], rows: int = 7, suffix: str = "_mean7"
) -> DataFrame:
    """Mean over the current and the preceding rows of a daily series, short at its start.

    The series has one row per calendar day, so the single window partition is small
    however many orders stand behind it.
    """
    window = W.orderBy(day).rowsBetween(-(rows - 1), W.currentRow)
    return daily.select("*", *(F.avg(v).over(window).alias(f"{v}{suffix}") for v in values))


def calendar(df: DataFrame, moment: str, out: str = "day") -> DataFrame:
    """Every day from the first to the last moment in the data, also days without rows."""
    ends = df.agg(day_of(F.min(moment)).alias("_first"), day_of(F.max(moment)).alias("_last"))
    return ends.select(F.explode(F.sequence("_first", "_last")).alias(out))


def _fixed_holiday(day: Column) -> Column:
    listed = [m * 100 + d for m, d in PUBLIC_HOLIDAYS]
    return (F.month(day) * 100 + F.dayofmonth(day)).isin(*listed)


def day_type(name: str) -> Column:
    """promo, holiday, payday or normal, the first that applies.

    A holiday on a weekend is also observed on the next Monday; Black Friday is the
    Friday among the last seven days of November.
    """
    day = F.col(name)
    monday = F.weekday(day) == 0
    moved_here = monday & (_fixed_holiday(F.date_sub(day, 1)) | _fixed_holiday(F.date_sub(day, 2)))
    black_friday = (F.month(day) == 11) & (F.weekday(day) == 4) & (F.dayofmonth(day) > 23)
    promo_date = (F.month(day) == PROMO_DAY[0]) & (F.dayofmonth(day) == PROMO_DAY[1])
    return (
        F.when(promo_date | black_friday, "promo")
        .when(_fixed_holiday(day) | moved_here, "holiday")
        .when(F.dayofmonth(day).isin(*PAYDAYS_OF_MONTH), "payday")
        .otherwise("normal")
    )
