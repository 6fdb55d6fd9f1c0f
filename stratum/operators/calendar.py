"""Calendar (date) dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def date_parts(d: Column | str) -> list[Column]:
    """Calendar attributes of a date column (ISO week and ISO weekday)."""
    c = F.col(d) if isinstance(d, str) else d
    dow = F.weekday(c) + 1  # ISO: Monday = 1 ... Sunday = 7
    return [
        F.year(c).alias("year"),
        F.quarter(c).alias("quarter"),
        F.month(c).alias("month"),
        F.date_format(c, "MMMM").alias("month_name"),
        F.weekofyear(c).alias("week"),
        F.dayofmonth(c).alias("day_of_month"),
        dow.alias("day_of_week"),
        F.date_format(c, "EEEE").alias("day_of_week_name"),
        dow.isin(6, 7).alias("is_weekend"),
    ]


def date_dimension_from(bounds: DataFrame, start: str = "start", end: str = "end",
                        holidays: DataFrame | None = None, holiday_col: str = "holiday_date",
                        flag: str = "is_holiday") -> DataFrame:
    """One row per day in ``[start, end)`` (end exclusive) for a one-row
    ``bounds`` frame, with :func:`date_parts` and a holiday flag.

    Holidays are made distinct (a duplicate date would fan out a day).
    """
    days = bounds.select(
        F.explode(F.sequence(F.to_date(F.col(start)), F.date_sub(F.to_date(F.col(end)), 1))).alias("date_id")
    )
    out = days.select("date_id", *date_parts("date_id"))
    if holidays is not None:
        h = holidays.select(F.col(holiday_col).cast("date").alias("__h")).distinct()
        out = (out.join(h, F.col("date_id") == F.col("__h"), "left")
                  .withColumn(flag, F.col("__h").isNotNull()).drop("__h"))
    return out


def date_dimension(spark: SparkSession, start: str | dt.date, end: str | dt.date,
                   holidays: DataFrame | None = None, **kw) -> DataFrame:
    """Calendar between two fixed dates, ``end`` exclusive."""
    s = dt.date.fromisoformat(str(start))
    e = dt.date.fromisoformat(str(end))
    bounds = spark.range(int(e > s)).select(F.lit(s).alias("start"), F.lit(e).alias("end"))
    return date_dimension_from(bounds, holidays=holidays, **kw)
