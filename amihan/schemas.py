"""Declared schemas of the landing tables and the seed tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(10,2)": T.DecimalType(10, 2),
    "decimal(15,2)": T.DecimalType(15, 2),
}


def _schema(spec: str) -> T.StructType:
    """Build a schema from ``name:type`` words."""
    pairs = (word.split(":") for word in spec.split())
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = {
    "raw_transactions": _schema(
        """txn_id:string customer_id:string branch_code:string txn_date_ph:date
        txn_time_ph:string txn_type:string txn_channel:string
        transaction_direction:string amount_local:decimal(15,2)
        currency_code:string amount_php:decimal(15,2) counterparty_name:string
        counterparty_account:string counterparty_bank:string
        purpose_code:string purpose_description:string
        reference_number:string source_system:string batch_id:string
        created_at:timestamp updated_at:timestamp"""
    ),
    "raw_customers": _schema(
        """customer_id:string customer_name:string customer_type:string
        sss_number:string tin_number:string philhealth_id:string
        date_of_birth:date nationality:string is_pep:boolean
        pep_determination_date:date risk_tier:string account_status:string
        account_opened_date:date branch_code:string customer_segment:string
        kyc_status:string kyc_last_update_date:date
        created_at:timestamp updated_at:timestamp"""
    ),
    "raw_kyc_documents": _schema(
        """document_id:string customer_id:string document_type:string
        document_number:string issue_date:date expiry_date:date
        issuing_country:string issuing_authority:string
        created_at:timestamp updated_at:timestamp"""
    ),
    "raw_watchlist_screening": _schema(
        """screening_id:string customer_id:string screening_date:date
        watchlist_source:string match_status:string matched_name:string
        match_score:decimal(5,2) match_confidence_pct:decimal(5,2)
        notes:string created_at:timestamp updated_at:timestamp"""
    ),
}

SEEDS = {
    "ph_branches": _schema(
        "branch_code:string branch_name:string region_name:string "
        "city_municipality:string province:string"
    ),
    "fatf_jurisdictions": _schema(
        "iso2_code:string country_name:string fatf_list_type:string "
        "inclusion_date:date removal_date:date"
    ),
    "aml_risk_weights": _schema(
        "risk_category:string risk_subcategory:string "
        "weight_value:decimal(10,2) description:string"
    ),
    "ph_non_working_days": _schema(
        "calendar_date:date holiday_name:string holiday_type:string"
    ),
    "str_indicators_ref": _schema(
        "indicator_code:string indicator_name:string indicator_category:string "
        "description:string base_risk_score:int bsp_circular_ref:string"
    ),
}

# The primary keys of the landing tables.
PRIMARY_KEYS = {
    "raw_transactions": ("txn_id", "txn_date_ph"),
    "raw_customers": ("customer_id",),
    "raw_kyc_documents": ("document_id",),
    "raw_watchlist_screening": ("screening_id",),
}
