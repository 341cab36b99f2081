"""Opt-in rules that are documented but not part of the default run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.functions.calendar import as_of
from amihan.operators.customer_day import KEYS as DAY_KEYS
from amihan.operators.signals import KEYS
from amihan.operators.skew import join_groups, keep_groups
from amihan.params import AmlParams

# Codes and scores of the documented indicators.
DORMANCY_CODE, DORMANCY_SCORE = "DORMANCY_01", 60
SMURFING_CODE, SMURFING_SCORE = "PATTERN_01", 80


def _signal(rows: DataFrame, code: str, score: int, detail: Column) -> DataFrame:
    return rows.select(
        *KEYS,
        F.lit(code).alias("indicator_code"),
        F.lit(score).alias("signal_risk_score"),
        detail.cast("string").alias("signal_detail"),
    )


def signal_dormancy(transactions: DataFrame, params: AmlParams, hot: DataFrame | None = None) -> DataFrame:
    """A large credit on the first active date after a long silence.

    Silence is measured between active dates, so the window runs over one
    row per customer and date.
    """
    active = transactions.groupBy(*DAY_KEYS).agg(F.count("*").alias("_rows"))
    before = F.lag("txn_date_ph").over(Window.partitionBy("customer_id").orderBy("txn_date_ph"))
    woken = (
        active.withColumn("_silent_days", F.datediff("txn_date_ph", before))
        .filter(F.col("_silent_days") >= params.dormancy_days)
        .select(*DAY_KEYS, "_silent_days")
    )
    credits = transactions.filter(
        (F.col("transaction_direction") == "CREDIT") & (F.col("amount_php") >= params.dormancy_min_credit)
    ).select(*KEYS)
    joined = join_groups(credits, woken, DAY_KEYS, F.col("txn_id"), hot)
    return _signal(joined, DORMANCY_CODE, DORMANCY_SCORE, F.col("_silent_days"))


def banking_day_number(day: Column, holidays: Sequence[date]) -> Column:
    """Banking days up to and including ``day``, counted from a fixed Monday.

    Weekends and holidays share the number of the banking day before them.
    """
    since_monday = F.unix_date(day) + 3
    weekdays = F.floor(since_monday / 7) * 5 + F.least(F.pmod(since_monday, F.lit(7)) + 1, F.lit(5))
    closed = sorted(h for h in set(holidays) if h.weekday() < 5)
    if not closed:
        return weekdays.cast("int")
    passed = F.size(F.filter(F.lit(closed), lambda h: h <= day))
    return (weekdays - passed).cast("int")


def signal_smurfing(
    transactions: DataFrame, params: AmlParams, holidays: Sequence[date], hot: DataFrame | None = None
) -> DataFrame:
    """Several customers paying into one account within a few banking days.

    Distinct depositors are counted exactly without collecting them: each
    (account, day, customer) counts for its own day and the next ones of
    the window, duplicates vanish in a first aggregation, the second one
    counts.  Both combine before the shuffle.
    """
    number = banking_day_number(F.col("txn_date_ph"), holidays).alias("_day")
    rows = transactions.filter(F.col("counterparty_account").isNotNull()).select(
        *KEYS, "counterparty_account", number
    )
    window_ends = F.sequence(F.col("_day"), F.col("_day") + params.smurfing_banking_days - 1)
    crowded = (
        rows.select("counterparty_account", "_day", "customer_id")
        .distinct()
        .select("counterparty_account", "customer_id", F.explode(window_ends).alias("_day"))
        .distinct()
        .groupBy("counterparty_account", "_day")
        .agg(F.count("*").alias("_depositors"))
        .filter(F.col("_depositors") >= params.smurfing_min_depositors)
    )
    joined = join_groups(rows, crowded, ["counterparty_account", "_day"], F.col("txn_id"), hot)
    return _signal(joined, SMURFING_CODE, SMURFING_SCORE, F.col("_depositors"))


def signal_flagged_customers(
    transactions: DataFrame, flagged: DataFrame, code: str, score: int, hot: DataFrame | None = None
) -> DataFrame:
    """All transactions of flagged customers; code and score are the caller's.

    ``hot`` has the customers with very many transactions, to be salted.
    """
    rows = keep_groups(transactions.select(*KEYS), flagged, ["customer_id"], F.col("txn_id"), hot)
    return _signal(rows, code, score, F.lit(None))


def scd2_customers(history: DataFrame, snapshot: DataFrame, params: AmlParams) -> DataFrame:
    """Customer history with one row per period of an unchanged risk tier.

    ``history`` has valid_from, valid_to, is_current; ``snapshot`` is today's
    dimension.  A changed tier closes the current row and opens a new one; a
    new customer opens a row; all else stays.
    """
    today = as_of(params)
    latest = snapshot.select("customer_id", F.col("risk_tier").alias("_tier"))
    changed = F.col("is_current") & F.col("_tier").isNotNull() & ~F.col("risk_tier").eqNullSafe(F.col("_tier"))
    kept = (
        history.join(latest, "customer_id", "left")
        .withColumn("valid_to", F.when(changed, today).otherwise(F.col("valid_to")))
        .withColumn("is_current", F.col("is_current") & ~changed)
        .select(*history.columns)
    )
    open_rows = history.filter("is_current").select("customer_id", "risk_tier")
    opened = (
        snapshot.join(open_rows, ["customer_id", "risk_tier"], "left_anti")
        .withColumn("valid_from", today)
        .withColumn("valid_to", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(True))
        .select(*history.columns)
    )
    return kept.unionByName(opened)


def retention_filter(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """Transactions within the retention period.

    The year predicate prunes the folders of a year-partitioned table.
    """
    oldest = F.add_months(as_of(params), -12 * params.retention_years)
    kept = transactions.filter(F.col("txn_date_ph") >= oldest)
    if "txn_year" in transactions.columns:
        kept = kept.filter(F.col("txn_year") >= params.as_of.year - params.retention_years)
    return kept
