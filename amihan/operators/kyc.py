"""KYC health: document completeness and freshness per customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import as_of, loaded_at
from amihan.functions.scoring import first_match, refresh_due, refresh_overdue
from amihan.params import AmlParams

# Document groups and their points.
PRIMARY_IDS = ("PASSPORT", "NATIONAL_ID", "DRIVERS_LICENSE")
VALID_PRIMARY_IDS = ("NATIONAL_ID", "PASSPORT")
ADDRESS_ID = "POSTAL_ID"
PRIMARY_POINTS, VALID_PRIMARY_POINTS, ADDRESS_POINTS = 30, 20, 20
COUNT_POINTS = ((3, 30), (2, 20), (1, 10))

_COUNTS = (
    "has_primary_id",
    "has_address_verification",
    "has_valid_primary_id",
    "valid_docs_count",
    "expired_docs_count",
)


def _flag(condition: Column) -> Column:
    return F.max(F.when(condition, 1).otherwise(0))


def document_facts(documents: DataFrame) -> DataFrame:
    """Flags and counts per customer, combined before the shuffle."""
    kind, expired = F.col("document_type"), F.col("is_expired")
    return documents.groupBy("customer_id").agg(
        _flag(kind.isin(*PRIMARY_IDS)).alias("has_primary_id"),
        _flag(kind == ADDRESS_ID).alias("has_address_verification"),
        _flag(kind.isin(*VALID_PRIMARY_IDS) & ~expired).alias("has_valid_primary_id"),
        F.count(F.when(~expired, 1)).alias("valid_docs_count"),
        F.count(F.when(expired, 1)).alias("expired_docs_count"),
        _flag(F.col("expiry_within_90_days")).alias("has_docs_expiring_90d"),
        F.min("expiry_date").alias("earliest_expiry_date"),
    )


def agg_doc_completeness(customers: DataFrame, documents: DataFrame) -> DataFrame:
    """Document facts for every customer; those without documents have zeros."""
    joined = customers.select("customer_id", "customer_type", "risk_tier", "is_pep", "kyc_last_update_date").join(
        document_facts(documents), "customer_id", "left"
    )
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in (*_COUNTS, "has_docs_expiring_90d")})


def completeness_points() -> Column:
    by_count = first_match([(F.col("valid_docs_count") >= n, p) for n, p in COUNT_POINTS], 0)
    return (
        F.col("has_primary_id") * PRIMARY_POINTS
        + F.col("has_valid_primary_id") * VALID_PRIMARY_POINTS
        + F.col("has_address_verification") * ADDRESS_POINTS
        + by_count
    )


def int_kyc_health(
    customers: DataFrame, documents: DataFrame, params: AmlParams, hundred_scale: bool = False
) -> DataFrame:
    """Score, freshness and due date per customer.

    As specified, the score runs from 0.0 to 1.0 but is compared with 80, so
    every customer is an exception.  ``hundred_scale`` keeps the points on
    0..100, where the limits act.
    """
    points = completeness_points().cast("decimal(10,0)")
    score = points if hundred_scale else F.round(points / 100, 1)
    tier, updated, today = F.col("risk_tier"), F.col("kyc_last_update_date"), as_of(params)
    return (
        agg_doc_completeness(customers, documents)
        .select(
            "customer_id",
            "customer_type",
            "risk_tier",
            "is_pep",
            "kyc_last_update_date",
            *_COUNTS,
            score.cast("decimal(20,6)").alias("kyc_completeness_score"),
            refresh_overdue(updated, tier, today).alias("kyc_freshness_flag"),
            F.datediff(today, updated).alias("days_since_kyc_update"),
            refresh_due(updated, tier).alias("kyc_refresh_due_date"),
            "has_docs_expiring_90d",
            "earliest_expiry_date",
            F.when(F.col("is_pep"), "REQUIRES_SCREENING").otherwise("NOT_APPLICABLE").alias("pep_screening_status"),
            loaded_at(params),
        )
        .withColumn(
            "kyc_exception", F.coalesce(F.col("kyc_completeness_score") < params.kyc_exception_below, F.lit(False))
        )
    )


def kyc_refresh_due(customers: DataFrame, params: AmlParams) -> DataFrame:
    """Due date and freshness alone; needs no documents."""
    tier, updated = F.col("risk_tier"), F.col("kyc_last_update_date")
    return customers.select(
        "customer_id",
        "risk_tier",
        "kyc_last_update_date",
        refresh_overdue(updated, tier, as_of(params)).alias("kyc_freshness_flag"),
        F.datediff(as_of(params), updated).alias("days_since_kyc_update"),
        refresh_due(updated, tier).alias("kyc_refresh_due_date"),
    )
