from datetime import date, timedelta

from pyspark.sql import functions as F
from rows import PARAMS, by

from amihan.functions.calendar import working_day_deadline, working_days_add
from amihan.operators.extensions import banking_day_number
from amihan.plans.dimensions import dim_date
from amihan.sources.seeds import load_seeds


def brute_force(start, n, holidays, buffer):
    days = [start + timedelta(days=i) for i in range(1, n * buffer + 1)]
    working = [d for d in days if d.weekday() < 5 and d not in holidays]
    return working[n - 1] if len(working) >= n else None


def test_deadlines_equal_a_plain_calendar(spark):
    holidays = load_seeds(spark).holidays
    days = spark.range(730).select(F.date_add(F.lit(date(2025, 1, 1)), F.col("id").cast("int")).alias("d"))
    d = F.col("d")
    rows = days.select(
        "d",
        working_day_deadline(d, 1, holidays).alias("n1"),
        working_day_deadline(d, 5, holidays).alias("n5"),
        working_days_add(d, 1, holidays).alias("a1"),
        working_days_add(d, 5, holidays).alias("a5"),
    ).collect()
    for r in rows:
        assert r.n1 == brute_force(r.d, 1, holidays, 3)
        assert r.n5 == brute_force(r.d, 5, holidays, 3)
        assert r.a1 == brute_force(r.d, 1, holidays, 2)
        assert r.a5 == brute_force(r.d, 5, holidays, 2)
    none = {r.d for r in rows if r.n1 is None}
    assert len(none) == 18
    assert {date(2025, 8, 22), date(2025, 12, 24), date(2026, 2, 6)} <= none
    assert all(r.n5 is not None for r in rows)


def test_banking_day_numbers(spark):
    holidays = load_seeds(spark).holidays
    days = spark.range(730).select(F.date_add(F.lit(date(2025, 1, 1)), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", banking_day_number(F.col("d"), holidays).alias("n")).orderBy("d").collect()
    for before, after in zip(rows, rows[1:]):
        is_working = after.d.weekday() < 5 and after.d not in holidays
        assert after.n - before.n == (1 if is_working else 0)


def test_dim_date(spark):
    rows = by(dim_date(spark, PARAMS, load_seeds(spark).holidays), "calendar_date")
    assert len(rows) == 1826
    assert min(rows) == date(2021, 6, 30) and max(rows) == date(2026, 6, 29)  # a leap day cuts off as_of
    monday = rows[date(2026, 6, 29)]
    assert (monday.day_of_week, monday.day_name, monday.is_current_week, monday.is_ph_working_day) == (
        1, "Monday", True, True,
    )
    assert not rows[date(2026, 6, 28)].is_current_week
    assert not rows[date(2026, 6, 12)].is_ph_working_day
    assert sum(r.is_current_month for r in rows.values()) == 29
