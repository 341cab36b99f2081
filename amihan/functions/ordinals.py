"""Working days by number: adding working days is one addition between two lookups.

Every day of a calendar has the number of the working days up to it.  The
n-th working day after a date is the working day whose number is n more.  The
calendar has a row for each day, so its size is that of the span of dates;
holidays of any number are rows, not literals of a plan.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def working_day_calendar(spark: SparkSession, first: date, last: date, holidays: DataFrame) -> DataFrame:
    """(day, ordinal, is_working) from ``first`` to ``last``; ``holidays`` has a column calendar_date."""
    days = spark.range((last - first).days + 1).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    closed = holidays.select(F.col("calendar_date").alias("day")).where(F.col("day").isNotNull()).distinct()
    marked = days.join(closed.withColumn("_closed", F.lit(True)), "day", "left").select(
        "day", (~F.dayofweek("day").isin(1, 7) & F.col("_closed").isNull()).alias("is_working")
    )
    # Days of one month count by themselves, months add up: no window holds more than a month or all months.
    month = F.date_trunc("month", "day").cast("date")
    inside = F.sum(F.col("is_working").cast("int")).over(Window.partitionBy("_month").orderBy("day"))
    marked = marked.withColumn("_month", month).withColumn("_inside", inside)
    totals = marked.groupBy("_month").agg(F.sum(F.col("is_working").cast("int")).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    months = totals.select("_month", before.alias("_before"))
    return marked.join(months, "_month").select("day", (F.col("_before") + F.col("_inside")).cast("long").alias("ordinal"), "is_working")


def span(rows: DataFrame, column: str, n: int, buffer: int) -> tuple[date, date] | None:
    """The first and last day a calendar must have for the dates of a column; None without dates."""
    first, last = rows.agg(F.min(column), F.max(column)).first()
    return (first, last + timedelta(days=n * buffer)) if first is not None else None


def with_working_day(rows: DataFrame, column: str, name: str, n: int, calendar: DataFrame, buffer: int = 3) -> DataFrame:
    """Adds the n-th working day after a date, NULL if it is more than ``n * buffer`` days away.

    Two equality joins with the calendar, which Catalyst broadcasts by its
    size.  A null date, or one that the calendar lacks, gives NULL.
    """
    start = calendar.select(F.col("day").alias("_start"), F.col("ordinal").alias("_ordinal"))
    end = calendar.where("is_working").select(F.col("day").alias("_end"), (F.col("ordinal") - n).alias("_from"))
    joined = rows.join(start, F.col(column) == F.col("_start"), "left").join(end, F.col("_ordinal") == F.col("_from"), "left")
    near: Column = F.when(F.col("_end") <= F.date_add(F.col(column), n * buffer), F.col("_end"))
    return joined.select(*[rows[c] for c in rows.columns], near.alias(name))
