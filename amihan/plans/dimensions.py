"""Gold dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from amihan.functions.calendar import as_of, is_working_day, loaded_at_manila
from amihan.functions.keys import with_dense_key
from amihan.functions.masking import mask_ends, mask_tail
from amihan.operators.risk import COMPONENTS
from amihan.params import AmlParams

# Length of the calendar and its day names, Sunday first.
CALENDAR_YEARS = 5
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def dim_branches(branches: DataFrame, params: AmlParams) -> DataFrame:
    """The branch list with a dense key (a seed list: one window is enough)."""
    number = F.row_number().over(Window.orderBy("branch_code")).cast("long")
    return branches.select(
        number.alias("branch_sk"),
        "branch_code",
        "branch_name",
        "region_name",
        "city_municipality",
        "province",
        loaded_at_manila(params),
    )


def dim_date(spark: SparkSession, params: AmlParams, holidays: Sequence[date]) -> DataFrame:
    """The calendar of the last five years.

    It has 5 * 365 + 1 days counted from the start date, whatever the data.
    """
    today = as_of(params)
    start = F.add_months(today, -12 * CALENDAR_YEARS)
    day = F.col("calendar_date")
    weekday = F.dayofweek(day) - 1
    monday = F.trunc(today, "week")
    this_year = F.year(day) == F.year(today)
    days = spark.range(CALENDAR_YEARS * 365 + 1, numPartitions=1).select(
        F.date_add(start, F.col("id").cast("int")).alias("calendar_date")
    )
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day,
        F.year(day).alias("calendar_year"),
        F.month(day).alias("calendar_month"),
        F.quarter(day).alias("calendar_quarter"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), weekday).alias("day_name"),
        is_working_day(day, holidays).alias("is_ph_working_day"),
        ((day >= monday) & (day < F.date_add(monday, 7))).alias("is_current_week"),
        (this_year & (F.month(day) == F.month(today))).alias("is_current_month"),
        this_year.alias("is_current_year"),
        loaded_at_manila(params),
    )


def masked_customers(customers: DataFrame) -> DataFrame:
    """Customers with masked name and numbers, in dimension order."""
    return customers.select(
        "customer_id",
        mask_ends(F.col("customer_name")).alias("customer_name"),
        "customer_type",
        "customer_segment",
        mask_tail(F.col("sss_number")).alias("sss_number"),
        mask_tail(F.col("tin_number")).alias("tin_number"),
        "date_of_birth",
        "nationality",
        "is_pep",
        "pep_determination_date",
        "risk_tier",
        "account_status",
        "account_opened_date",
        "branch_code",
    )


def dim_customers(customers: DataFrame, risk: DataFrame, params: AmlParams) -> DataFrame:
    """Masked customers with their risk rating; a snapshot of today."""
    rating = risk.select("customer_id", "overall_risk_score", "overall_risk_tier", *COMPONENTS, "risk_factors")
    numbered = with_dense_key(masked_customers(customers), "customer_id", "customer_sk")
    joined = numbered.join(rating, "customer_id", "left")
    return joined.select(
        *numbered.columns,
        *[c for c in rating.columns if c != "customer_id"],
        as_of(params).alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
        loaded_at_manila(params),
    )


def vw_dim_customers_masked(dimension: DataFrame, role: str, params: AmlParams) -> DataFrame:
    """The dimension as a role sees it: the restricted role gets masks again.

    Masking a masked value changes nothing.
    """
    if role != params.masked_role:
        return dimension
    return dimension.withColumns(
        {
            "customer_name": mask_ends(F.col("customer_name")),
            "sss_number": mask_tail(F.col("sss_number")),
            "tin_number": mask_tail(F.col("tin_number")),
        }
    )


#: The session variable that names who reads a masked view.
ROLE_VARIABLE = "viewer_role"


def set_viewer_role(spark: SparkSession, role: str) -> None:
    """Whoever reads a masked view of this session from now on is this role."""
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT current_user()")
    spark.sql(f"SET VAR {ROLE_VARIABLE} = :role", args={"role": role})


def create_masked_view(dimension: DataFrame, params: AmlParams, name: str = "vw_dim_customers_masked") -> None:
    """A temporary view of the dimension that asks for the reader's role when it is queried.

    Until :func:`set_viewer_role` is called the reader is the session's user.
    """
    spark = dimension.sparkSession
    spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT current_user()")
    dimension.createOrReplaceTempView(f"{name}_base")
    restricted = f"session.{ROLE_VARIABLE} = '{params.masked_role}'"
    masks = {
        "customer_name": "concat(substring(customer_name, 1, 1), '***', substring(customer_name, length(customer_name), 1))",
        "sss_number": "concat('***', right(sss_number, 4))",
        "tin_number": "concat('***', right(tin_number, 4))",
    }
    shown = [f"CASE WHEN {restricted} THEN {masks[c]} ELSE {c} END AS {c}" if c in masks else f"`{c}`" for c in dimension.columns]
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {', '.join(shown)} FROM {name}_base")
