"""Calendar features from (year, day of year)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Days of the year taken as public holidays.
PUBLIC_HOLIDAYS = [
    1,    # New Year's Day
    15,   # Martin Luther King Jr. Day
    53,   # Washington's Birthday
    151,  # Memorial Day
    185,  # Independence Day
    121,  # Labor Day
    285,  # Columbus Day
    315,  # Veterans Day
    330,  # Thanksgiving
    360,  # Christmas
]


def txn_date(year: str | Column = "year", day: str | Column = "day") -> Column:
    """The date, or NULL for a null part or a day the year does not have."""
    year = F.col(year) if isinstance(year, str) else year
    day = F.col(day) if isinstance(day, str) else day
    known = year.between(1, 9999) & day.between(1, 366)
    found = F.date_add(F.make_date(F.when(known, year), F.lit(1), F.lit(1)), day - 1)
    return F.when(known & (F.year(found) == year), found)


def add_day_of_week(df: DataFrame) -> DataFrame:
    """1 = Sunday ... 7 = Saturday."""
    return df.withColumn("day_of_week", F.dayofweek(txn_date()))


def add_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.month(txn_date()))


def add_weekend_flag(df: DataFrame) -> DataFrame:
    """`is_holiday`: 1 on Saturday and Sunday, else 0 (also for a null day)."""
    return df.withColumn("is_holiday", F.when(F.col("day_of_week").isin(1, 7), 1).otherwise(0))


def is_public_holiday(day: str | Column = "day", days: list[int] | None = None) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return F.when(day.isin(PUBLIC_HOLIDAYS if days is None else days), 1).otherwise(0)


def add_holiday_flag(df: DataFrame, days: list[int] | None = None) -> DataFrame:
    """`is_public_holiday`: 1 on exactly the listed days of the year."""
    return df.withColumn("is_public_holiday", is_public_holiday("day", days))
