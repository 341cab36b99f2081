"""Covered-transaction candidates: large cash, related cash, foreign currency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import loaded_at
from amihan.functions.keys import surrogate_key
from amihan.params import AmlParams

# Transfer types of the foreign-currency rule.
FOREX_TYPES = ("WIRE", "SWIFT", "RTGS")
LOCAL_CURRENCY = "PHP"

_ROW = (
    "txn_id",
    "customer_id",
    "branch_code",
    "txn_date_ph",
    "txn_type",
    "txn_channel",
    "amount_php",
    "counterparty_name",
    "counterparty_account",
)


def _candidate(rows: DataFrame, ctr_type: Column, ctr_amount: Column) -> DataFrame:
    return rows.select(
        *_ROW,
        ctr_type.alias("ctr_type"),
        ctr_amount.cast("decimal(29,2)").alias("ctr_amount_php"),
        "transaction_direction",
        F.lit(True).alias("is_ctr_candidate"),
    )


def _is_single_cash(params: AmlParams) -> Column:
    return (F.col("txn_type") == "CASH") & (F.col("amount_php") >= params.ctr_php_threshold)


def _is_forex(params: AmlParams) -> Column:
    return (
        (F.col("currency_code") != LOCAL_CURRENCY)
        & (F.col("amount_php") >= params.ctr_forex_threshold_usd * params.php_per_usd)
        & F.col("txn_type").isin(*FOREX_TYPES)
    )


def ctr_single_cash(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """One cash transaction at or above the threshold."""
    return _candidate(transactions.filter(_is_single_cash(params)), F.lit("SINGLE_CASH"), F.col("amount_php"))


def ctr_forex(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """A foreign-currency transfer at or above the threshold."""
    return _candidate(transactions.filter(_is_forex(params)), F.lit("FOREX_EQUIVALENT"), F.col("amount_php"))


def ctr_related_cash(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """Cash of one customer and date that together reaches the threshold.

    Reported once, on the row with the smallest id.  One aggregation gives
    both the day's total and that row: it is combined before the shuffle, so
    it needs neither a self join nor a sort of all rows of a day.
    """
    others = [c for c in _ROW if c not in ("txn_id", "customer_id", "txn_date_ph")]
    row = F.struct("txn_id", *others, "transaction_direction")
    days = (
        transactions.filter((F.col("txn_type") == "CASH") & (F.col("amount_php") > 0))
        .groupBy("customer_id", "txn_date_ph")
        .agg(F.sum("amount_php").alias("_day_cash"), F.min(row).alias("_row"))
        .filter(F.col("_day_cash") >= params.ctr_php_threshold)
    )
    rows = days.select("customer_id", "txn_date_ph", "_day_cash", "_row.*")
    return _candidate(rows, F.lit("RELATED_CASH"), F.col("_day_cash"))


def union_ctr(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """All candidates; a transaction may appear under several types.

    The two row rules exclude each other by transaction type, so one scan
    serves both.
    """
    single = _is_single_cash(params)
    by_row = _candidate(
        transactions.filter(single | _is_forex(params)),
        F.when(single, "SINGLE_CASH").otherwise("FOREX_EQUIVALENT"),
        F.col("amount_php"),
    )
    return by_row.unionByName(ctr_related_cash(transactions, params))


def int_ctr_candidates(transactions: DataFrame, params: AmlParams) -> DataFrame:
    candidates = union_ctr(transactions, params)
    return candidates.select(
        surrogate_key("txn_id", "ctr_type").alias("ctr_candidate_id"), *candidates.columns, loaded_at(params)
    )
