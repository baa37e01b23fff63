"""Calendar columns: weeks run Monday to Sunday, weekday 0 is Sunday."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_name(day: Column) -> Column:
    return F.date_format(day, "MMMM")


def month_short(day: Column) -> Column:
    return F.date_format(day, "MMM")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def day_short(day: Column) -> Column:
    return F.date_format(day, "EEE")


def day_of_week_number(day: Column) -> Column:
    return F.dayofweek(day) - F.lit(1)


def week_start_monday(day: Column) -> Column:
    return F.trunc(day, "week")


def week_end_sunday(day: Column) -> Column:
    return F.date_add(week_start_monday(day), 6)


def fiscal_year(day: Column, start_month: int = 1) -> Column:
    """Calendar year in which the fiscal year holding ``day`` began."""
    return F.when(F.month(day) >= F.lit(start_month), F.year(day)).otherwise(F.year(day) - F.lit(1))


def fiscal_quarter(day: Column, start_month: int = 1) -> Column:
    months_in = F.pmod(F.month(day) - F.lit(start_month), F.lit(12))
    return F.floor(months_in / F.lit(3)).cast("int") + F.lit(1)


def date_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day in [start, end), generated inside the executors."""
    days = max((end - start).days, 0)
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("date"))


def spine_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Daily spine over a one-row ``bounds`` frame; both ends included."""
    return bounds.select(F.explode(F.sequence(first, last)).alias("date"))


def calendar_columns(days: DataFrame, as_of: Column, fiscal_start_month: int = 1) -> DataFrame:
    """The date dimension for a frame with one DATE column called ``date``."""
    day = F.col("date")
    year_start = F.trunc(day, "year")
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month_number"),
        month_name(day).alias("month_name"),
        month_short(day).alias("month_short"),
        F.dayofmonth(day).alias("day_of_month"),
        F.weekofyear(day).alias("week_number"),
        day_of_week_number(day).alias("day_of_week_number"),
        day_name(day).alias("day_of_week_name"),
        day_short(day).alias("day_of_week_short"),
        week_start_monday(day).alias("week_start_date"),
        week_end_sunday(day).alias("week_end_date"),
        F.trunc(day, "month").alias("month_start_date"),
        F.last_day(day).alias("month_end_date"),
        year_start.alias("year_start_date"),
        F.date_sub(F.add_months(year_start, 12), 1).alias("year_end_date"),
        fiscal_year(day, fiscal_start_month).alias("fiscal_year"),
        fiscal_quarter(day, fiscal_start_month).alias("fiscal_quarter"),
        day_of_week_number(day).isin(0, 6).alias("is_weekend"),
        (day == as_of).alias("is_today"),
    )


def dim_date(
    spark: SparkSession, as_of: date, start: date = date(2000, 1, 1), fiscal_start_month: int = 1
) -> DataFrame:
    """Date dimension from ``start`` to the end of the ninth year after ``as_of``."""
    spine = date_spine(spark, start, date(as_of.year + 10, 1, 1))
    return calendar_columns(spine, F.lit(as_of), fiscal_start_month)
