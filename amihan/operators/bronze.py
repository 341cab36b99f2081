"""Bronze: normalise the landing tables and reject unusable rows.

Every normaliser is one projection and one filter: no shuffle, and the
filter reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import as_of, loaded_at, manila_instant
from amihan.params import AmlParams

# How screening results are read.
POTENTIAL_MATCHES = ("CONFIRMED_MATCH", "POSSIBLE_MATCH")
SANCTION_LISTS = ("UN_SANCTIONS", "OFAC_SDN")
EXPIRY_NOTICE_DAYS = 90


def _trim(name: str, width: int | None = None) -> Column:
    text = F.trim(F.col(name))
    return (F.substring(text, 1, width) if width else text).alias(name)


def _upper(name: str, width: int | None = None) -> Column:
    text = F.upper(F.trim(F.col(name)))
    return (F.substring(text, 1, width) if width else text).alias(name)


def stg_transactions(raw: DataFrame, params: AmlParams) -> DataFrame:
    usable = F.col("customer_id").isNotNull() & (F.col("amount_php") > 0) & F.col("txn_date_ph").isNotNull()
    return raw.filter(usable).select(
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "txn_time_ph",
        manila_instant(F.col("txn_date_ph"), F.col("txn_time_ph")).alias("txn_ts_ph"),
        _upper("txn_type"),
        _upper("txn_channel"),
        _upper("transaction_direction"),
        F.col("amount_local").cast("decimal(19,4)").alias("amount_local"),
        _upper("currency_code", 3),
        F.col("amount_php").cast("decimal(19,2)").alias("amount_php"),
        _trim("counterparty_name"),
        _trim("counterparty_account"),
        _trim("counterparty_bank"),
        _trim("purpose_code"),
        _trim("purpose_description"),
        _trim("reference_number"),
        _trim("source_system"),
        "batch_id",
        loaded_at(params),
    )


def derived_risk_tier(is_pep: Column, tier: Column) -> Column:
    """PEPs are HIGH; MED means MEDIUM; anything unknown is LOW."""
    name = F.upper(tier)
    return (
        F.when(is_pep | (name == "HIGH"), "HIGH").when(name.isin("MEDIUM", "MED"), "MEDIUM").otherwise("LOW")
    )


def stg_customers(raw: DataFrame, params: AmlParams) -> DataFrame:
    usable = (
        F.col("customer_id").isNotNull()
        & F.col("customer_name").isNotNull()
        & F.col("account_opened_date").isNotNull()
    )
    return raw.filter(usable).select(
        _trim("customer_id", 50),
        _trim("customer_name"),
        _upper("customer_type"),
        _upper("customer_segment"),
        _trim("sss_number"),
        _trim("tin_number"),
        _trim("philhealth_id"),
        "date_of_birth",
        _upper("nationality", 2),
        derived_risk_tier(F.col("is_pep"), F.col("risk_tier")).alias("risk_tier"),
        F.coalesce("is_pep", F.lit(False)).alias("is_pep"),
        "pep_determination_date",
        _upper("account_status"),
        "account_opened_date",
        _trim("branch_code", 10),
        _upper("kyc_status"),
        "kyc_last_update_date",
        loaded_at(params),
    )


def stg_kyc_documents(raw: DataFrame, params: AmlParams) -> DataFrame:
    expiry, today = F.col("expiry_date"), as_of(params)
    usable = (
        F.col("customer_id").isNotNull() & F.col("document_type").isNotNull() & F.col("issue_date").isNotNull()
    )
    never = F.lit(False)
    return raw.filter(usable).select(
        "document_id",
        _trim("customer_id", 50),
        _upper("document_type"),
        _trim("document_number"),
        _upper("issuing_country", 2),
        _trim("issuing_authority"),
        "issue_date",
        "expiry_date",
        F.datediff(expiry, today).alias("days_until_expiry"),
        F.coalesce(expiry < today, never).alias("is_expired"),
        F.coalesce(expiry.between(today, F.date_add(today, EXPIRY_NOTICE_DAYS)), never).alias(
            "expiry_within_90_days"
        ),
        loaded_at(params),
    )


def stg_watchlist(raw: DataFrame, params: AmlParams) -> DataFrame:
    status = F.upper(F.trim("match_status"))
    source = F.upper(F.trim("watchlist_source"))
    no = F.lit(False)
    usable = F.col("customer_id").isNotNull() & F.col("screening_date").isNotNull()
    return raw.filter(usable).select(
        "screening_id",
        _trim("customer_id", 50),
        "screening_date",
        _upper("watchlist_source"),
        _upper("match_status"),
        _trim("matched_name"),
        F.col("match_score").cast("decimal(5,2)").alias("match_score"),
        F.col("match_confidence_pct").cast("decimal(5,2)").alias("match_confidence_pct"),
        _trim("notes"),
        F.coalesce(status.isin(*POTENTIAL_MATCHES), no).alias("is_potential_match"),
        F.coalesce(source.isin(*SANCTION_LISTS) & (status == "CONFIRMED_MATCH"), no).alias(
            "is_sanctions_confirmed"
        ),
        loaded_at(params),
    )
