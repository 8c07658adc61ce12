"""Business calendar: Monday to Saturday are working days, with given months overridden."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def working_days(first: Column, last: Column) -> Column:
    """Days from first to last, both included, that aren't Sundays; by arithmetic, so spans may be long."""
    days = F.datediff(last, first) + 1
    sundays = F.floor((F.datediff(last, F.lit("1970-01-04").cast("date")) + 7) / 7) - F.floor((F.datediff(first, F.lit("1970-01-04").cast("date")) + 6) / 7)
    return F.greatest(F.lit(0), days - sundays).cast("long")


def month_start(year_month: Column) -> Column:
    return F.to_date(F.concat(year_month, F.lit("-01")))


def projected(df: DataFrame, metric: str, overrides: DataFrame | None = None) -> DataFrame:
    """df(year_month, week_ending, metric to date) with days_elapsed, days_in_month and projection; overrides(year_month, days) replaces a month's days."""
    first = month_start(F.col("year_month"))
    df = df.withColumns({"days_elapsed": working_days(first, F.col("week_ending")), "days_in_month": working_days(first, F.last_day(first))})
    if overrides is not None:
        df = df.join(overrides.select("year_month", "days"), "year_month", "left").withColumn("days_in_month", F.coalesce("days", "days_in_month")).drop("days")
    return df.withColumn("projection", F.try_divide(F.col(metric).cast("double"), F.col("days_elapsed").cast("double")) * F.col("days_in_month"))
