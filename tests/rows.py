"""Hand-made landing rows: give what matters, the rest has defaults."""

from datetime import date, datetime, timezone
from decimal import Decimal

from amihan.operators import bronze
from amihan.params import AmlParams
from amihan.schemas import RAW

PARAMS = AmlParams(as_of=date(2026, 6, 30), run_ts=datetime(2026, 6, 30, 2, 0, tzinfo=timezone.utc))

TXN = {
    "customer_id": "C1",
    "branch_code": "MKT001",
    "txn_date_ph": date(2026, 6, 1),
    "txn_time_ph": "10:00:00",
    "txn_type": "CASH",
    "txn_channel": "BRANCH",
    "transaction_direction": "DEBIT",
    "currency_code": "PHP",
    "amount_php": 1000,
}
CUSTOMER = {
    "customer_id": "C1",
    "customer_name": "Maria Cruz",
    "customer_type": "INDIVIDUAL",
    "nationality": "PH",
    "is_pep": False,
    "risk_tier": "LOW",
    "account_status": "ACTIVE",
    "account_opened_date": date(2020, 1, 1),
    "branch_code": "MKT001",
    "kyc_last_update_date": date(2026, 1, 1),
}
DOCUMENT = {"customer_id": "C1", "document_type": "PASSPORT", "document_number": "N1", "issue_date": date(2020, 1, 1)}
SCREENING = {
    "customer_id": "C1",
    "screening_date": date(2026, 6, 1),
    "watchlist_source": "AMLC_LIST",
    "match_status": "NO_MATCH",
}


def _frame(spark, name, defaults, key, rows):
    schema = RAW[name]
    out = []
    for i, row in enumerate(rows):
        full = {key: f"{key[0].upper()}{i:03d}", **defaults, **row}
        if name == "raw_transactions":
            full.setdefault("amount_local", full["amount_php"])
        for f in schema:
            if f.dataType.typeName() == "decimal" and full.get(f.name) is not None:
                full[f.name] = Decimal(str(full[f.name]))
        out.append(tuple(full.get(f.name) for f in schema))
    return spark.createDataFrame(out, schema)


def raw_txns(spark, *rows):
    return _frame(spark, "raw_transactions", TXN, "txn_id", rows)


def raw_customers(spark, *rows):
    return _frame(spark, "raw_customers", CUSTOMER, "customer_id", rows)


def raw_documents(spark, *rows):
    return _frame(spark, "raw_kyc_documents", DOCUMENT, "document_id", rows)


def raw_screening(spark, *rows):
    return _frame(spark, "raw_watchlist_screening", SCREENING, "screening_id", rows)


def txns(spark, *rows):
    return bronze.stg_transactions(raw_txns(spark, *rows), PARAMS)


def customers(spark, *rows):
    return bronze.stg_customers(raw_customers(spark, *rows), PARAMS)


def documents(spark, *rows):
    return bronze.stg_kyc_documents(raw_documents(spark, *rows), PARAMS)


def screening(spark, *rows):
    return bronze.stg_watchlist(raw_screening(spark, *rows), PARAMS)


def by(df, key):
    """Rows of a small result by a key column."""
    return {r[key]: r for r in df.collect()}
