"""Landing tables derived from a star schema (``orders``, ``customer``).

The mapping is plain integer arithmetic per row, so it adds no shuffle and
can be stated alike in other SQL engines.  All orders and customers take part;
remainders only decide what a row looks like and which customers have
documents or were screened.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from amihan.params import AmlParams

STAR_PARAMS = AmlParams(
    as_of=date(2026, 6, 30),
    run_ts=datetime(2026, 6, 30, 2, 0, tzinfo=timezone.utc),
)

TODAY = f"date '{STAR_PARAMS.as_of}'"

# Fixed values of the mapping: lists as SQL arrays, picked by a 0-based index.
BRANCHES = (
    "array('MKT001', 'MKT002', 'CEB001', 'CEB002', 'DVO001', 'CDO001', "
    "'ILO001', 'LEG001', 'PUA001', 'BAG001', 'TAC001', 'ZAM001')"
)
BANKS = "array('BDO', 'BPI', 'METROBANK', 'UNIONBANK', 'EASTWEST', 'SYRIA COMMERCIAL', null)"
TYPES = "array('CASH', 'CASH', 'CASH', 'CASH', 'CASH', 'CASH', 'RTGS', 'PESONet', 'InstaPay', 'SWIFT')"
CHANNELS = "array('BRANCH', 'ATM', 'ONLINE', 'MOBILE')"
ROUND_AMOUNTS = "array(50000, 100000, 500000, 1000000, 5000000)"
CUSTOMER_TYPES = "array('INDIVIDUAL', 'CORPORATE', 'SOLEPROPRIETOR', 'NGO', 'GOVERNMENT')"
SEGMENTS = "array('RETAIL', 'SME', 'CORPORATE')"
NATIONALITIES = "array('KP', 'IR', 'BY', 'TR', 'PA')"
STATUSES = "array('ACTIVE', 'DORMANT', 'RESTRICTED', 'FROZEN', 'CLOSED')"
DOCUMENT_TYPES = "array('PASSPORT', 'NATIONAL_ID', 'DRIVERS_LICENSE', 'POSTAL_ID')"
SOURCES = "array('AMLC_LIST', 'UN_SANCTIONS', 'OFAC_SDN', 'INTERNAL_BLACKLIST')"
MATCHES = "array('NO_MATCH', 'POSSIBLE_MATCH', 'CONFIRMED_MATCH', 'FALSE_POSITIVE')"

AUDIT = ("cast(null as timestamp) as created_at", "cast(null as timestamp) as updated_at")


def _pick(values: str, index: str) -> str:
    return f"get({values}, cast({index} as int))"


def _padded(prefix: str, key: str, width: int = 12) -> str:
    return f"'{prefix}' || lpad(cast({key} as string), {width}, '0')"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_transactions(spark: SparkSession, sf_dir: str, folded: bool = True) -> DataFrame:
    """Orders as transactions.

    ``folded`` moves all dates into one month, dense enough for short
    windows; otherwise the order dates are kept, which span years.
    """
    day = "date_add(date '2026-06-01', cast((o * 7) % 30 as int))" if folded else "cast(ordered as date)"
    orders = _read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as o",
        "o_custkey as c",
        "o_orderdate as ordered",
        "cast(o_totalprice as decimal(19,2)) as price",
    )
    amount = f"""cast(case when o % 50 = 0 then {_pick(ROUND_AMOUNTS, "(o div 50) % 5")}
        when o % 4 = 0 then price * 2 when o % 10 = 9 then price * 3 else price end as decimal(15,2))"""
    return orders.selectExpr(
        f"{_padded('T', 'o')} as txn_id",
        f"{_padded('CUST', 'c')} as customer_id",
        f"{_pick(BRANCHES, 'c % 12')} as branch_code",
        f"{day} as txn_date_ph",
        "'10:00:00' as txn_time_ph",
        f"{_pick(TYPES, 'o % 10')} as txn_type",
        f"{_pick(CHANNELS, 'o % 4')} as txn_channel",
        "case when (o div 10) % 10 < 6 then 'DEBIT' else 'CREDIT' end as transaction_direction",
        f"{amount} as amount_local",
        "case when o % 11 = 0 or o % 10 = 9 then 'USD' else 'PHP' end as currency_code",
        f"{amount} as amount_php",
        "cast(null as string) as counterparty_name",
        f"{_padded('1234', 'o % 500', 10)} as counterparty_account",
        f"{_pick(BANKS, 'o % 7')} as counterparty_bank",
        "cast(null as string) as purpose_code",
        "case when o % 13 = 0 then 'Remit to Iran' when o % 17 = 0 then 'REMIT TO TURKEY' else 'Fund transfer' end "
        "as purpose_description",
        "'REF' || o as reference_number",
        "'TEMENOS' as source_system",
        "'B1' as batch_id",
        *AUDIT,
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_name", "c_nationkey as nation")
    return customers.selectExpr(
        f"{_padded('CUST', 'k')} as customer_id",
        "c_name as customer_name",
        f"{_pick(CUSTOMER_TYPES, 'k % 5')} as customer_type",
        f"{_padded('', 'k', 10)} as sss_number",
        f"{_padded('', 'k', 10)} as tin_number",
        f"{_padded('', 'k', 10)} as philhealth_id",
        "cast(null as date) as date_of_birth",
        f"coalesce({_pick(NATIONALITIES, 'nation')}, 'PH') as nationality",
        "k % 20 = 0 as is_pep",
        f"case when k % 20 = 0 then date_sub({TODAY}, 100) end as pep_determination_date",
        "case when k % 20 = 0 or k % 10 = 9 then 'HIGH' when k % 10 between 6 and 8 then 'MEDIUM' else 'LOW' end "
        "as risk_tier",
        f"coalesce({_pick(STATUSES, 'k % 25')}, 'ACTIVE') as account_status",
        f"date_sub({TODAY}, cast(365 + k % 1460 as int)) as account_opened_date",
        f"{_pick(BRANCHES, 'k % 12')} as branch_code",
        f"{_pick(SEGMENTS, 'k % 3')} as customer_segment",
        "'COMPLETE' as kyc_status",
        f"date_sub({TODAY}, cast((k * 37) % 2200 as int)) as kyc_last_update_date",
        *AUDIT,
    )


def raw_kyc_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four documents per customer.

    One in a hundred lacks its type, one customer in a hundred the issue dates
    of all documents; those are rejected later.  One in four hundred refers to
    a customer that does not exist.
    """
    numbered = _read(spark, sf_dir, "customer").selectExpr("c_custkey as k", "explode(sequence(1, 4)) as i")
    return numbered.selectExpr(
        f"{_padded('D', 'k')} || '-' || i as document_id",
        f"case when k % 100 = 33 and i = 4 then {_padded('GONE', 'k')} else {_padded('CUST', 'k')} end as customer_id",
        f"case when (k + i) % 100 <> 0 then {_pick(DOCUMENT_TYPES, 'i - 1')} end as document_type",
        "'N' || k || i as document_number",
        f"case when k % 100 <> 7 then date_sub({TODAY}, cast(30 + k % 1000 as int)) end as issue_date",
        f"""case when (k + i) % 20 = 0 then null
            when (k * i) % 7 = 0 then date_sub({TODAY}, cast(1 + k % 365 as int))
            else date_add({TODAY}, cast((k * 13 + i * 50) % 1500 as int)) end as expiry_date""",
        "'PH' as issuing_country",
        "'DFA' as issuing_authority",
        *AUDIT,
    )


def raw_watchlist_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screening per customer.

    One in a hundred each lacks its date and is rejected later, has more than
    100 per cent, and refers to a customer that does not exist.
    """
    screened = _read(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_name")
    return screened.selectExpr(
        f"{_padded('W', 'k')} as screening_id",
        f"case when k % 100 = 66 then {_padded('GONE', 'k')} else {_padded('CUST', 'k')} end as customer_id",
        f"case when k % 100 <> 50 then date_sub({TODAY}, cast(k % 60 as int)) end as screening_date",
        f"{_pick(SOURCES, '(k div 4) % 4')} as watchlist_source",
        f"{_pick(MATCHES, '(k div 16) % 4')} as match_status",
        "c_name as matched_name",
        "cast((k * 7) % 101 as decimal(5,2)) as match_score",
        "cast(case when k % 100 = 25 then 105 else (k * 7) % 101 end as decimal(5,2)) as match_confidence_pct",
        "cast(null as string) as notes",
        *AUDIT,
    )
