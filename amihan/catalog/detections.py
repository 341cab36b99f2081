"""Bronze tables, detections and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from amihan.catalog.registry import query
from amihan.operators import candidates, ctr, kyc, layering, risk, signals

STG_TRANSACTIONS = (
    "txn_id customer_id branch_code txn_date_ph:d txn_time_ph txn_ts_ph:e txn_type txn_channel "
    "transaction_direction amount_local:n currency_code amount_php:n counterparty_name counterparty_account "
    "counterparty_bank purpose_code purpose_description reference_number source_system batch_id"
)
STG_CUSTOMERS = (
    "customer_id customer_name customer_type customer_segment sss_number tin_number philhealth_id date_of_birth:d "
    "nationality risk_tier is_pep pep_determination_date:d account_status account_opened_date:d branch_code "
    "kyc_status kyc_last_update_date:d"
)
STG_KYC_DOCUMENTS = (
    "document_id customer_id document_type document_number issuing_country issuing_authority issue_date:d "
    "expiry_date:d days_until_expiry:i is_expired expiry_within_90_days"
)
STG_WATCHLIST = (
    "screening_id customer_id screening_date:d watchlist_source match_status matched_name match_score:n "
    "match_confidence_pct:n notes is_potential_match is_sanctions_confirmed"
)
query("stg_transactions", STG_TRANSACTIONS, "select * from txn")(lambda x: x.transactions)
query("stg_customers", STG_CUSTOMERS, "select * from cust")(lambda x: x.customers)
query("stg_kyc_documents", STG_KYC_DOCUMENTS, "select * from docs")(lambda x: x.documents)
query("stg_watchlist", STG_WATCHLIST, "select * from screening")(lambda x: x.screening)

# Covered transactions -------------------------------------------------------
CTR = (
    "txn_id customer_id branch_code txn_date_ph:d txn_type txn_channel amount_php:n counterparty_name "
    "counterparty_account ctr_type ctr_amount_php:n transaction_direction"
)
query("ctr_single_cash", CTR, "select * from ctr_single")(lambda x: ctr.ctr_single_cash(x.transactions, x.params))
query("ctr_related_cash", CTR, "select * from ctr_related")(lambda x: ctr.ctr_related_cash(x.transactions, x.params))
query("ctr_forex", CTR, "select * from ctr_forex")(lambda x: ctr.ctr_forex(x.transactions, x.params))
query("union_ctr", CTR + " is_ctr_candidate", "select * from ctr")(lambda x: ctr.union_ctr(x.transactions, x.params))
query("int_ctr_candidates", "ctr_candidate_id " + CTR + " is_ctr_candidate", "select * from ctr")(lambda x: x.ctr)

# Structuring and layering ----------------------------------------------------
query(
    "int_structuring_detection",
    "structuring_event_id txn_id customer_id branch_code txn_date_ph:d observation_window_start_date:d amount_php:n "
    "txn_count_7d:i txn_sum_7d:n is_structuring_pattern str_indicator_code risk_score_structuring:i "
    "threshold_evasion_pct:n",
    "select * from structuring",
)(lambda x: x.structuring)
LAYERING = (
    "layering_event_id txn_id customer_id branch_code txn_date_ph:d transaction_direction amount_php:n amount_in_48h:n "
    "amount_out_48h:n net_amount_48h:n net_position_pct:n txn_count_48h:i avg_daily_velocity_90d:n is_layering_pattern "
    "velocity_anomaly str_indicator_code risk_score_layering:i purpose_description"
)
query("int_layering_detection", LAYERING, "select * from layering")(lambda x: x.layering)
query("velocity_anomaly", LAYERING, "select * from layering where velocity_anomaly")(
    lambda x: layering.velocity_anomaly(x.transactions, x.params)
)

# KYC health -----------------------------------------------------------------
KYC = (
    "customer_id customer_type risk_tier is_pep kyc_last_update_date:d has_primary_id:i has_address_verification:i "
    "has_valid_primary_id:i valid_docs_count:i expired_docs_count:i kyc_completeness_score:n kyc_freshness_flag "
    "days_since_kyc_update:i kyc_refresh_due_date:d has_docs_expiring_90d:i earliest_expiry_date:d "
    "pep_screening_status kyc_exception"
)
query("int_kyc_health", KYC, "select * from kyc")(lambda x: x.kyc)
query(
    "kyc_refresh_due",
    "customer_id risk_tier kyc_last_update_date:d kyc_freshness_flag days_since_kyc_update:i kyc_refresh_due_date:d",
    "select * from kyc",
)(lambda x: kyc.kyc_refresh_due(x.customers, x.params))

# Risk rating ----------------------------------------------------------------
RISK = (
    "customer_id customer_type customer_segment risk_tier is_pep nationality account_status pep_risk_score:n "
    "customer_type_risk_score:i geography_risk_score:i kyc_health_risk_score:i account_status_risk_score:i "
    "watchlist_risk_score:i overall_risk_score:i overall_risk_tier risk_factors:a"
)
query("int_customer_risk_rating", RISK, "select * from risk")(lambda x: x.risk)
query("risk_pep", "customer_id is_pep pep_risk_score:n", "select * from risk_parts")(
    lambda x: x.customers.select(
        "customer_id", "is_pep", risk.pep_points(x.seeds.weights, x.params).alias("pep_risk_score")
    )
)
query("risk_customer_type", "customer_id customer_type customer_type_risk_score:i", "select * from risk_parts")(
    lambda x: x.customers.select(
        "customer_id",
        "customer_type",
        risk.customer_type_points(F.col("customer_type")).alias("customer_type_risk_score"),
    )
)
query("risk_geography", "customer_id nationality geography_risk_score:i", "select * from risk_parts")(
    lambda x: x.customers.select(
        "customer_id", "nationality", risk.geography_points(F.col("nationality")).alias("geography_risk_score")
    )
)
query("risk_kyc", "customer_id kyc_completeness_score:n kyc_health_risk_score:i", "select * from risk_parts")(
    lambda x: x.kyc.select(
        "customer_id",
        "kyc_completeness_score",
        risk.kyc_points(F.col("kyc_completeness_score")).alias("kyc_health_risk_score"),
    )
)
query("risk_account_status", "customer_id account_status account_status_risk_score:i", "select * from risk_parts")(
    lambda x: x.customers.select(
        "customer_id",
        "account_status",
        risk.account_status_points(F.col("account_status")).alias("account_status_risk_score"),
    )
)


@query(
    "risk_watchlist",
    "customer_id watchlist_risk_score:i",
    "select customer_id, watchlist_risk_score from risk_parts",
)
def _risk_watchlist(x):
    """Of every customer; without screenings the score is zero."""
    hits = F.coalesce("total_watchlist_hits", F.lit(0))
    points = risk.watchlist_points(F.col("confirmed_sanctions_hits"), F.col("highest_match_confidence"), hits)
    screened = x.customers.select("customer_id").join(risk.agg_watchlist_hits(x.screening), "customer_id", "left")
    return screened.select("customer_id", points.alias("watchlist_risk_score"))


# Signals --------------------------------------------------------------------
SIGNAL = (
    "customer_id txn_id branch_code txn_date_ph:d indicator_code signal_risk_score:i txn_count_7d:i signal_detail"
)


def _signal_structuring(x):
    return signals.signal_structuring(x.structuring)


def _signal_layering(x):
    return signals.signal_layering(x.layering)


def _signal_fatf(x):
    return signals.signal_fatf(x.transactions, x.customers, x.seeds.jurisdictions, x.params)


def _signal_pep(x):
    return signals.signal_pep(x.transactions, x.customers, x.params)


def _signal_round(x):
    return signals.signal_round_number(x.transactions, x.params)


def all_signals(x):
    parts = (_signal_structuring, _signal_layering, _signal_fatf, _signal_pep, _signal_round)
    return signals.union_signals(*[part(x) for part in parts])


query("signal_structuring", SIGNAL, "select * from sig_structuring")(_signal_structuring)
query("signal_layering", SIGNAL, "select * from sig_layering")(_signal_layering)
query("signal_fatf", SIGNAL, "select * from sig_fatf")(_signal_fatf)
query("signal_pep", SIGNAL, "select * from sig_pep")(_signal_pep)
query("signal_round_number", SIGNAL, "select * from sig_round")(_signal_round)
query("union_signals", SIGNAL, "select * from signals")(all_signals)
query(
    "agg_signals",
    "customer_id txn_id branch_code txn_date_ph:d str_indicators:a indicator_count:i max_risk_score:i signal_details",
    "select * from signal_groups",
)(lambda x: candidates.agg_signals(all_signals(x)))
CANDIDATE = (
    "str_candidate_id txn_id customer_id branch_code txn_date_ph:d str_indicators:a indicator_count:i "
    "max_risk_score:i signal_details str_determination_ts:t str_determination_date:t str_confidence_level"
)
query("int_str_candidates", CANDIDATE, "select * from candidates")(lambda x: x.candidates)
