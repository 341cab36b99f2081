"""Customer-day facts: the grain on which all day windows are computed.

Every rolling window of the detections is a RANGE over dates, and all rows of
one customer and date share one frame.  So the windows run over one row per
customer and date, not over the transactions: a customer with a third of
all transactions has at most as many window rows as the calendar has days,
and the counts and sums behind them are combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from amihan.functions.numeric import rounded_ratio
from amihan.params import AmlParams

KEYS = ["customer_id", "txn_date_ph"]


def cash_debit() -> Column:
    """The rows that can take part in structuring."""
    return (
        (F.col("txn_type") == "CASH") & (F.col("amount_php") > 0) & (F.col("transaction_direction") == "DEBIT")
    )


def _when(condition: Column) -> Column:
    return F.when(condition, F.col("amount_php")).otherwise(F.lit(0).cast("decimal(19,2)"))


def customer_day(transactions: DataFrame) -> DataFrame:
    """Counts and sums per customer and date, in one pass over the transactions."""
    direction = F.col("transaction_direction")
    return (
        transactions.filter(F.col("amount_php") > 0)
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("day_count"),
            F.sum("amount_php").alias("day_total"),
            F.sum(_when(direction == "CREDIT")).alias("day_in"),
            F.sum(_when(direction == "DEBIT")).alias("day_out"),
            F.count(F.when(cash_debit(), 1)).alias("cash_debit_count"),
            F.sum(_when(cash_debit())).alias("cash_debit_sum"),
        )
    )


def last_days(days: int) -> WindowSpec:
    """The current date and the ``days`` dates before it, per customer."""
    return Window.partitionBy("customer_id").orderBy(F.unix_date("txn_date_ph")).rangeBetween(-days, 0)


def long_sum(value: Column, days: int) -> Column:
    """The sum over the current date and the ``days`` dates before it.

    A sliding frame is summed anew for every row, so a long one costs its
    length.  The difference of two running sums costs the same for any
    length.
    """
    ordered = Window.partitionBy("customer_id").orderBy(F.unix_date("txn_date_ph"))
    until_now = F.sum(value).over(ordered.rangeBetween(Window.unboundedPreceding, 0))
    before = F.sum(value).over(ordered.rangeBetween(Window.unboundedPreceding, -days - 1))
    return F.when(before.isNull(), until_now).otherwise(until_now - before)


def structuring_windows(daily: DataFrame, params: AmlParams) -> DataFrame:
    """Add the rolling cash-debit count, sum and first date."""
    w = last_days(params.structuring_days)
    return daily.withColumns(
        {
            "txn_count_7d": F.sum("cash_debit_count").over(w),
            "txn_sum_7d": F.sum("cash_debit_sum").over(w).cast("decimal(29,2)"),
            "observation_window_start_date": F.min(
                F.when(F.col("cash_debit_count") > 0, F.col("txn_date_ph"))
            ).over(w),
        }
    )


def velocity_windows(daily: DataFrame, params: AmlParams) -> DataFrame:
    """Add the rolling in, out, total and count, and the 90-day average.

    The average is over transactions: each transaction contributes the count
    of its own date.  Over days that is the sum of n*n by the sum of n, kept
    as a pair of whole numbers so that comparing and rounding are exact.
    """
    w = last_days(params.layering_days)
    n = F.col("day_count").cast("decimal(18,0)")
    return daily.withColumns(
        {
            "amount_in_48h": F.sum("day_in").over(w).cast("decimal(29,2)"),
            "amount_out_48h": F.sum("day_out").over(w).cast("decimal(29,2)"),
            "net_amount_48h": F.sum("day_total").over(w).cast("decimal(29,2)"),
            "txn_count_48h": F.sum("day_count").over(w),
            "_squares_90d": long_sum(n * n, params.velocity_days).cast("decimal(36,0)"),
            "_count_90d": long_sum(F.col("day_count"), params.velocity_days),
        }
    ).withColumn("avg_daily_velocity_90d", rounded_ratio(F.col("_squares_90d"), F.col("_count_90d"), 2))


def structuring_qualifies(params: AmlParams) -> Column:
    return (F.col("txn_count_7d") >= params.structuring_min_count) & (
        F.col("txn_sum_7d") >= params.structuring_min_sum
    )


def layering_pattern(net: Column, params: AmlParams) -> Column:
    """Both legs large and a small net position.

    ``net / (in + out) < limit`` is tested as ``net < limit * (in + out)``,
    which needs no division.
    """
    moved_in, moved_out = F.col("amount_in_48h"), F.col("amount_out_48h")
    return (
        (moved_in > params.layering_min_leg)
        & (moved_out > params.layering_min_leg)
        & (net < F.lit(params.layering_max_net_ratio) * (moved_in + moved_out).cast("decimal(30,2)"))
    )


def velocity_spike(params: AmlParams) -> Column:
    """More transactions in the short window than twice the long average, with money in and out."""
    return (
        (
            F.col("txn_count_48h").cast("decimal(18,0)") * F.col("_count_90d").cast("decimal(18,0)")
            > F.col("_squares_90d") * params.velocity_factor
        )
        & (F.col("amount_in_48h") > 0)
        & (F.col("amount_out_48h") > 0)
    )
