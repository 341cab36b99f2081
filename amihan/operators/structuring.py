"""Cash structuring: several cash withdrawals within days that add up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import loaded_at
from amihan.functions.keys import surrogate_key
from amihan.operators.customer_day import (
    KEYS,
    cash_debit,
    structuring_qualifies,
    structuring_windows,
)
from amihan.operators.skew import join_groups
from amihan.params import AmlParams

# Fixed value.
STRUCTURING_CODE = "STRUCT_01"


def cash_debit_days(transactions: DataFrame) -> DataFrame:
    """Count and sum of the cash withdrawals per customer and date."""
    return (
        transactions.filter(cash_debit())
        .groupBy(*KEYS)
        .agg(F.count("*").alias("cash_debit_count"), F.sum("amount_php").alias("cash_debit_sum"))
    )


def is_structuring_row(params: AmlParams) -> Column:
    """Given a qualifying window: the row itself stays below the threshold."""
    return F.col("amount_php") < params.structuring_max_single


def int_structuring_detection(
    transactions: DataFrame,
    params: AmlParams,
    daily: DataFrame | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Cash withdrawals whose 7-day window has enough of them and enough money.

    ``daily`` may be a stored customer-day table, and ``hot`` its largest
    days.  Only the windows that qualify meet the rows again.
    """
    daily = cash_debit_days(transactions) if daily is None else daily.filter("cash_debit_count > 0")
    windows = (
        structuring_windows(daily, params)
        .filter(structuring_qualifies(params))
        .select(*KEYS, "txn_count_7d", "txn_sum_7d", "observation_window_start_date")
    )
    rows = transactions.filter(cash_debit()).select("txn_id", *KEYS, "branch_code", "amount_php")
    pattern = is_structuring_row(params)
    reference = F.lit(params.structuring_reference_sum)
    return join_groups(rows, windows, KEYS, F.col("txn_id"), hot).select(
        surrogate_key("customer_id", "txn_date_ph", "observation_window_start_date").alias(
            "structuring_event_id"
        ),
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "observation_window_start_date",
        "amount_php",
        "txn_count_7d",
        "txn_sum_7d",
        pattern.alias("is_structuring_pattern"),
        F.when(pattern, STRUCTURING_CODE).alias("str_indicator_code"),
        F.when(pattern, params.structuring_score).otherwise(0).alias("risk_score_structuring"),
        F.round((F.col("txn_sum_7d") - reference) * 100 / reference, 2).alias("threshold_evasion_pct"),
        loaded_at(params),
    )
