"""Gold facts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import as_of, loaded_at_manila, working_day_deadline
from amihan.functions.keys import surrogate_key
from amihan.functions.numeric import cents, rounded_ratio
from amihan.functions.scoring import filing_urgency, first_match
from amihan.operators.risk import COMPONENTS
from amihan.params import AmlParams
from amihan.sources.seeds import listed_rows

# Indicator categories with a score column of their own.
CATEGORIES = {
    "structuring_risk": "STRUCTURING",
    "layering_risk": "LAYERING",
    "jurisdiction_risk": "JURISDICTION",
    "pep_risk": "PEP",
}


def _null(kind: str, name: str) -> Column:
    return F.lit(None).cast(kind).alias(name)


def fct_covered_transactions(
    candidates: DataFrame,
    branches: DataFrame,
    calendar: DataFrame,
    holidays: Sequence[date],
    params: AmlParams,
) -> DataFrame:
    """Covered transactions with date key, branch and filing deadline.

    Both dimensions are small lists, broadcast by Catalyst's size check.  The
    branch code is the dimension's: NULL for an unknown branch.
    """
    known = branches.select(F.col("branch_code").alias("_code"), F.col("branch_code").alias("_known"))
    dates = calendar.select(F.col("calendar_date").alias("txn_date_ph"), "date_id")
    return (
        candidates.join(known, F.col("branch_code") == F.col("_code"), "left")
        .join(dates, "txn_date_ph", "left")
        .select(
            surrogate_key("txn_id", "ctr_type").alias("ctr_id"),
            "txn_id",
            "customer_id",
            F.col("date_id").alias("txn_date_id"),
            "txn_date_ph",
            F.col("_known").alias("branch_code"),
            "amount_php",
            "transaction_direction",
            "ctr_type",
            "txn_channel",
            working_day_deadline(F.col("txn_date_ph"), params.ctr_deadline_days, holidays).alias("filing_deadline"),
            F.lit("PENDING").alias("filing_status"),
            _null("date", "filing_date"),
            _null("string", "amlc_ers_reference"),
            loaded_at_manila(params),
        )
    )


def category_scores(indicators: DataFrame) -> dict[str, Column]:
    """Per category the sum of base scores over a candidate's indicator array.

    The indicator list is a bounded seed, so the scores are literals and the
    sum is row-local: no explode, join and regrouping of the candidates.
    """
    rows = listed_rows(indicators.select("indicator_code", "indicator_category", "base_risk_score"))
    out = {}
    for name, category in CATEGORIES.items():
        points: dict[str, int] = {}
        for code, row_category, score in rows:
            if row_category == category and score is not None:
                points[code] = points.get(code, 0) + score
        terms = [
            F.when(F.array_contains("str_indicators", code), F.lit(score)).otherwise(0).cast("long")
            for code, score in sorted(points.items())
        ]
        out[name] = sum(terms[1:], terms[0]) if terms else F.lit(0).cast("long")
    return out


def fct_suspicious_transactions(
    candidates: DataFrame,
    transactions: DataFrame,
    indicators: DataFrame,
    holidays: Sequence[date],
    params: AmlParams,
) -> DataFrame:
    """Candidates with amount, category scores, deadline and urgency."""
    amounts = transactions.select("txn_id", F.col("amount_php").alias("transaction_amount_php"))
    determined = F.col("str_determination_ts").cast("date")
    dated = (
        candidates.join(amounts, "txn_id", "left")
        .withColumn("str_filing_deadline", working_day_deadline(determined, params.str_deadline_days, holidays))
        .withColumn("days_to_deadline", F.datediff("str_filing_deadline", as_of(params)))
    )
    return dated.select(
        F.col("str_candidate_id").alias("str_id"),
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "str_indicators",
        "indicator_count",
        "max_risk_score",
        "transaction_amount_php",
        *[score.alias(name) for name, score in category_scores(indicators).items()],
        "str_determination_ts",
        "str_filing_deadline",
        "days_to_deadline",
        filing_urgency(F.col("days_to_deadline")).alias("filing_urgency"),
        F.lit("PENDING").alias("filing_status"),
        _null("date", "filed_at"),
        _null("string", "amlc_ers_reference"),
        "str_confidence_level",
        "signal_details",
        loaded_at_manila(params),
    )


def agg_ctr_ytd(covered: DataFrame, params: AmlParams) -> DataFrame:
    """Covered transactions of the year per customer; a date range, so it prunes."""
    this_year = (F.col("txn_date_ph") >= F.lit(params.year_start)) & (
        F.col("txn_date_ph") < F.lit(params.next_year_start)
    )
    return covered.filter(this_year).groupBy("customer_id").agg(F.count("*").alias("ctr_count_ytd"))


def agg_str_ytd(suspicious: DataFrame, params: AmlParams) -> DataFrame:
    """Suspicious transactions determined in the year per customer, and the overdue ones."""
    determined = F.col("str_determination_ts")
    first = F.lit(f"{params.year_start} 00:00:00").cast("timestamp_ntz")
    after = F.lit(f"{params.next_year_start} 00:00:00").cast("timestamp_ntz")
    return (
        suspicious.filter((determined >= first) & (determined < after))
        .groupBy("customer_id")
        .agg(
            F.count("*").alias("str_count_ytd"),
            F.count(F.when(F.col("filing_urgency") == "OVERDUE", 1)).alias("str_overdue_count_ytd"),
        )
    )


def fct_customer_compliance(
    customers: DataFrame,
    kyc_health: DataFrame,
    risk: DataFrame,
    covered: DataFrame,
    suspicious: DataFrame,
    params: AmlParams,
) -> DataFrame:
    """One row per customer: KYC state, risk and the year's reports.

    Five inputs meet on ``customer_id``; facts arrive pre-aggregated.
    """
    kyc = kyc_health.select(
        "customer_id",
        "kyc_completeness_score",
        "kyc_freshness_flag",
        "kyc_exception",
        "days_since_kyc_update",
        "kyc_refresh_due_date",
        "has_primary_id",
        "has_address_verification",
        "has_valid_primary_id",
        "pep_screening_status",
        "earliest_expiry_date",
    )
    rating = risk.select(
        "customer_id", "overall_risk_score", F.col("overall_risk_tier").alias("_tier"), *COMPONENTS
    )
    joined = (
        customers.join(kyc, "customer_id", "left")
        .join(rating, "customer_id", "left")
        .join(agg_ctr_ytd(covered, params), "customer_id", "left")
        .join(agg_str_ytd(suspicious, params), "customer_id", "left")
    )
    counts = ("ctr_count_ytd", "str_count_ytd", "str_overdue_count_ytd")
    return joined.select(
        "customer_id",
        "customer_type",
        "customer_segment",
        "branch_code",
        "nationality",
        as_of(params).alias("snapshot_date"),
        *[c for c in kyc.columns if c != "customer_id"],
        "overall_risk_score",
        F.col("_tier").alias("risk_tier"),
        *COMPONENTS,
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        "is_pep",
        "account_status",
        "kyc_last_update_date",
        loaded_at_manila(params),
    )


def _count(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def agg_branch_customers(compliance: DataFrame) -> DataFrame:
    tier, score = F.col("risk_tier"), F.col("overall_risk_score")
    return compliance.groupBy("branch_code").agg(
        F.countDistinct("customer_id").alias("unique_customers"),
        _count(tier == "HIGH").alias("high_risk_customers"),
        _count(tier == "MEDIUM").alias("medium_risk_customers"),
        _count(tier == "LOW").alias("low_risk_customers"),
        _count(F.col("is_pep")).alias("pep_customers"),
        _count(F.col("kyc_exception")).alias("kyc_exceptions"),
        _count(F.col("kyc_freshness_flag")).alias("stale_kyc_customers"),
        rounded_ratio(F.sum(score), F.count(score)).alias("avg_customer_risk_score"),
    )


def agg_branch_ctr(covered: DataFrame) -> DataFrame:
    amount, direction = F.col("amount_php"), F.col("transaction_direction")
    return covered.groupBy("branch_code").agg(
        F.count("*").alias("ctr_count"),
        F.sum(amount).alias("ctr_value_php"),
        _count(direction == "CREDIT").alias("ctr_inbound_count"),
        _count(direction == "DEBIT").alias("ctr_outbound_count"),
        F.max(amount).alias("ctr_max_amount_php"),
        rounded_ratio(cents(F.sum(amount)), F.count(amount) * 100).alias("ctr_avg_amount_php"),
        _count(F.col("filing_status") == "PENDING").alias("ctr_pending_count"),
    )


def agg_branch_str(suspicious: DataFrame) -> DataFrame:
    urgency, score, confidence = F.col("filing_urgency"), F.col("max_risk_score"), F.col("str_confidence_level")
    return suspicious.groupBy("branch_code").agg(
        F.count("*").alias("str_count"),
        _count(urgency == "OVERDUE").alias("overdue_strs"),
        _count(urgency == "DUE_SOON").alias("due_soon_strs"),
        _count(urgency == "PENDING").alias("pending_strs"),
        rounded_ratio(F.sum(score), F.count(score)).alias("avg_str_risk_score"),
        F.max(score).alias("max_str_risk_score"),
        _count(confidence == "HIGH").alias("high_confidence_strs"),
        _count(confidence == "MEDIUM").alias("medium_confidence_strs"),
    )


def fct_branch_compliance_summary(
    branches: DataFrame,
    compliance: DataFrame,
    covered: DataFrame,
    suspicious: DataFrame,
    params: AmlParams,
) -> DataFrame:
    """One row per branch; each fact is aggregated before it joins."""
    parts = [agg_branch_customers(compliance), agg_branch_ctr(covered), agg_branch_str(suspicious)]
    joined = branches
    for part in parts:
        joined = joined.join(part, "branch_code", "left")
    metrics = [c for part in parts for c in part.columns if c != "branch_code"]
    filled = joined.select(
        "branch_code",
        "branch_name",
        "region_name",
        "city_municipality",
        "province",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in metrics],
    )
    status = first_match(
        [
            (F.col("overdue_strs") > 0, "CRITICAL"),
            (F.col("due_soon_strs") > 0, "AT_RISK"),
            (F.col("kyc_exceptions") > params.branch_kyc_exceptions_above, "NEEDS_ATTENTION"),
        ],
        "COMPLIANT",
    )
    return filled.select("*", status.alias("branch_compliance_status"), loaded_at_manila(params))
