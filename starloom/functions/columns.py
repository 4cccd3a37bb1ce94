"""Keys, guarded ratios and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a null part of a surrogate key.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: str | Column) -> Column:
    """MD5 hex key over the parts, joined by dashes; a null part still gives a key."""
    texts = []
    for part in parts:
        column = F.col(part) if isinstance(part, str) else part
        texts.append(F.coalesce(column.cast("string"), F.lit(NULL_KEY_PART)))
    return F.md5(F.concat_ws("-", *texts))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that is null where the denominator is zero or null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_of_positive(numerator: Column, denominator: Column) -> Column:
    """Double division that is null unless the denominator is above zero."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double"))


def flag(condition: Column) -> Column:
    """A two-valued flag: an unknown condition counts as false."""
    return F.coalesce(condition, F.lit(False))


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def calendar_key(day: Column, first: str, last: str) -> Column:
    """Key of the calendar row of a day; null outside the calendar.

    Same result as a left join to the calendar on the day, with no join: the
    calendar holds every day between its ends exactly once.
    """
    inside = day.between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return F.when(inside, date_key(day))


def distance_band(distance: Column, short: int = 800, medium: int = 3500) -> Column:
    return (
        F.when(distance < short, "short_haul")
        .when(distance < medium, "medium_haul")
        .otherwise("long_haul")
    )


def month_of(day: Column) -> Column:
    return F.trunc(day, "month")


def month_day_in(day: Column, days: list[tuple[int, int]]) -> Column:
    """Whether the day falls on one of the (month, day) pairs."""
    return (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d in days])
