"""Layering and velocity: money in and out within two days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import loaded_at
from amihan.functions.keys import surrogate_key
from amihan.functions.numeric import cents, rounded_ratio
from amihan.operators.customer_day import (
    KEYS,
    customer_day,
    layering_pattern,
    velocity_spike,
    velocity_windows,
)
from amihan.operators.skew import join_groups
from amihan.params import AmlParams

# Fixed value.
LAYERING_CODE = "LAYER_01"


def layering_windows(daily: DataFrame, params: AmlParams, signed_net: bool = False) -> DataFrame:
    """The customer-days with a layering pattern or a velocity spike.

    As specified, the net amount is the sum of all amounts, in and out alike,
    so the pattern cannot fire.  ``signed_net`` takes the documented meaning:
    the absolute difference of in and out.
    """
    windows = velocity_windows(daily, params)
    if signed_net:
        difference = F.abs(F.col("amount_in_48h") - F.col("amount_out_48h")).cast("decimal(29,2)")
        windows = windows.withColumn("net_amount_48h", difference)
    moved = (F.col("amount_in_48h") + F.col("amount_out_48h")).cast("decimal(30,2)")
    return windows.select(
        *KEYS,
        "amount_in_48h",
        "amount_out_48h",
        "net_amount_48h",
        rounded_ratio(cents(F.col("net_amount_48h")) * 100, cents(moved), 2).alias("net_position_pct"),
        "txn_count_48h",
        "avg_daily_velocity_90d",
        F.coalesce(layering_pattern(F.col("net_amount_48h"), params), F.lit(False)).alias("is_layering_pattern"),
        F.coalesce(velocity_spike(params), F.lit(False)).alias("velocity_anomaly"),
    ).filter(F.col("is_layering_pattern") | F.col("velocity_anomaly"))


def int_layering_detection(
    transactions: DataFrame,
    params: AmlParams,
    daily: DataFrame | None = None,
    hot: DataFrame | None = None,
    signed_net: bool = False,
) -> DataFrame:
    """The transactions of the customer-days that show a pattern or a spike."""
    daily = customer_day(transactions) if daily is None else daily
    windows = layering_windows(daily, params, signed_net)
    rows = transactions.filter(F.col("amount_php") > 0).select(
        "txn_id", *KEYS, "branch_code", "transaction_direction", "amount_php", "purpose_description"
    )
    pattern = F.col("is_layering_pattern")
    return join_groups(rows, windows, KEYS, F.col("txn_id"), hot).select(
        surrogate_key("customer_id", "txn_date_ph").alias("layering_event_id"),
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "transaction_direction",
        "amount_php",
        "amount_in_48h",
        "amount_out_48h",
        "net_amount_48h",
        "net_position_pct",
        "txn_count_48h",
        "avg_daily_velocity_90d",
        "is_layering_pattern",
        "velocity_anomaly",
        F.when(pattern, LAYERING_CODE).alias("str_indicator_code"),
        F.when(pattern, params.layering_score).otherwise(0).alias("risk_score_layering"),
        "purpose_description",
        loaded_at(params),
    )


def velocity_anomaly(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """The velocity rows alone."""
    return int_layering_detection(transactions, params).filter("velocity_anomaly")
