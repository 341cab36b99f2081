"""Customer risk rating: six component scores, one overall score and tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import loaded_at
from amihan.functions.scoring import (
    account_status_points,
    customer_type_points,
    geography_points,
    kyc_points,
    tier_label,
    watchlist_points,
)
from amihan.params import AmlParams

COMPONENTS = (
    "pep_risk_score",
    "customer_type_risk_score",
    "geography_risk_score",
    "kyc_health_risk_score",
    "account_status_risk_score",
    "watchlist_risk_score",
)
# Fixed values.
PEP_WEIGHT_KEY = ("PEP", "PEP_CUSTOMER")
COMPONENT_DIVISOR = 5
MAX_SCORE = 100


def agg_watchlist_hits(screening: DataFrame) -> DataFrame:
    """Hits per customer; every screening row counts, whatever its result."""
    return screening.groupBy("customer_id").agg(
        F.count("*").alias("total_watchlist_hits"),
        F.count(F.when(F.col("is_sanctions_confirmed"), 1)).alias("confirmed_sanctions_hits"),
        F.count(F.when(F.col("is_potential_match"), 1)).alias("potential_match_count"),
        F.max("match_confidence_pct").alias("highest_match_confidence"),
    )


def pep_weight(weights: DataFrame, params: AmlParams) -> Column:
    """The one weight row that is read, as a scalar subquery; or the default."""
    category, subcategory = PEP_WEIGHT_KEY
    row = weights.filter((F.col("risk_category") == category) & (F.col("risk_subcategory") == subcategory))
    return F.coalesce(row.select("weight_value").scalar(), F.lit(params.pep_default_weight).cast("decimal(10,2)"))


def pep_points(weights: DataFrame, params: AmlParams) -> Column:
    return F.when(F.col("is_pep"), pep_weight(weights, params)).otherwise(F.lit(0).cast("decimal(10,2)"))


def overall(params: AmlParams) -> tuple[Column, Column]:
    """Overall score and tier; the tier comes from the unrounded score."""
    total = sum((F.col(c) for c in COMPONENTS[1:]), F.col(COMPONENTS[0])).cast("decimal(14,2)")
    raw = (total / COMPONENT_DIVISOR).cast("decimal(20,6)")
    score = F.least(F.lit(MAX_SCORE), F.round(raw, 0).cast("int"))
    return score, tier_label(raw, params)


def risk_factors() -> Column:
    return F.array_compact(
        F.array(
            F.when(F.col("is_pep"), "PEP"),
            F.when(F.col("account_status") == "FROZEN", "FROZEN_ACCOUNT"),
            F.when(F.col("_hits") > 0, "WATCHLIST_HIT"),
            F.when(F.col("_kyc_score") < 80, "INCOMPLETE_KYC"),
        )
    )


def int_customer_risk_rating(
    customers: DataFrame, kyc_health: DataFrame, screening: DataFrame, weights: DataFrame, params: AmlParams
) -> DataFrame:
    """Risk rating per customer.

    All three inputs meet on ``customer_id``: customers are shuffled once and
    the aggregates arrive partitioned by the same key.
    """
    score, tier = overall(params)
    kyc = kyc_health.select("customer_id", F.col("kyc_completeness_score").alias("_kyc_score"))
    hits = F.coalesce("total_watchlist_hits", F.lit(0))
    rated = (
        customers.join(kyc, "customer_id", "left")
        .join(agg_watchlist_hits(screening), "customer_id", "left")
        .select(
            "customer_id",
            "customer_type",
            "customer_segment",
            "risk_tier",
            "is_pep",
            "nationality",
            "account_status",
            pep_points(weights, params).alias("pep_risk_score"),
            customer_type_points(F.col("customer_type")).alias("customer_type_risk_score"),
            geography_points(F.col("nationality")).alias("geography_risk_score"),
            kyc_points(F.col("_kyc_score")).alias("kyc_health_risk_score"),
            account_status_points(F.col("account_status")).alias("account_status_risk_score"),
            watchlist_points(F.col("confirmed_sanctions_hits"), F.col("highest_match_confidence"), hits).alias(
                "watchlist_risk_score"
            ),
            "_kyc_score",
            hits.alias("_hits"),
        )
    )
    return rated.select(
        *[c for c in rated.columns if not c.startswith("_")],
        score.alias("overall_risk_score"),
        tier.alias("overall_risk_tier"),
        risk_factors().alias("risk_factors"),
        loaded_at(params),
    )
