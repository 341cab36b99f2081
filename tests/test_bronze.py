from datetime import date, datetime, timezone

from pyspark.sql import functions as F
from rows import PARAMS, by, customers, documents, raw_txns, screening, txns

from amihan.functions.calendar import manila_instant
from amihan.operators.bronze import stg_transactions


def test_transactions_are_normalised_and_rejected(spark):
    out = by(
        txns(
            spark,
            {"txn_id": "A", "txn_type": " cash ", "currency_code": "usd", "counterparty_bank": "  BDO "},
            {"txn_id": "B", "amount_php": 0},
            {"txn_id": "C", "amount_php": -5},
            {"txn_id": "D", "customer_id": None},
            {"txn_id": "E", "txn_date_ph": None},
            {"txn_id": "F", "customer_id": " C9 "},
        ),
        "txn_id",
    )
    assert set(out) == {"A", "F"}
    assert (out["A"].txn_type, out["A"].currency_code, out["A"].counterparty_bank) == ("CASH", "USD", "BDO")
    assert out["F"].customer_id == " C9 "  # keys are not trimmed here


def test_instant_is_manila_time_in_any_session_zone(spark):
    raw = raw_txns(
        spark,
        {"txn_id": "A", "txn_time_ph": "10:00:00"},
        {"txn_id": "B", "txn_time_ph": "00:00:00.25"},
        {"txn_id": "C", "txn_time_ph": None},
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", other)
        try:
            out = {
                r.txn_id: r.us
                for r in stg_transactions(raw, PARAMS).select("txn_id", F.unix_micros("txn_ts_ph").alias("us")).collect()
            }
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
        epoch = int(datetime(2026, 6, 1, 2, tzinfo=timezone.utc).timestamp()) * 10**6
        assert out == {"A": epoch, "B": epoch - 10 * 3600 * 10**6 + 250_000, "C": None}


def test_instant_equals_the_parsed_timestamp(spark):
    days = spark.range(0, 4000, 13).select(
        F.date_add(F.lit(date(2015, 1, 1)), F.col("id").cast("int")).alias("d"),
        F.format_string("%02d:%02d:%02d", F.col("id") % 24, F.col("id") % 60, F.col("id") % 59).alias("t"),
    )
    parsed = F.concat(F.col("d").cast("string"), F.lit(" "), F.col("t"), F.lit(" Asia/Manila")).cast("timestamp")
    assert days.filter(parsed != manila_instant(F.col("d"), F.col("t"))).count() == 0


def test_customer_tier_and_rejects(spark):
    out = by(
        customers(
            spark,
            {"customer_id": " P ", "is_pep": True, "risk_tier": "LOW"},
            {"customer_id": "M", "risk_tier": "med"},
            {"customer_id": "X", "risk_tier": "strange"},
            {"customer_id": "N", "is_pep": None, "risk_tier": None, "nationality": "phl"},
            {"customer_id": "R", "customer_name": None},
            {"customer_id": "S", "account_opened_date": None},
        ),
        "customer_id",
    )
    assert {k: r.risk_tier for k, r in out.items()} == {"P": "HIGH", "M": "MEDIUM", "X": "LOW", "N": "LOW"}
    assert out["N"].is_pep is False and out["N"].nationality == "PH"


def test_document_expiry_edges(spark):
    edges = {
        "none": None,
        "today": date(2026, 6, 30),
        "d90": date(2026, 9, 28),
        "d91": date(2026, 9, 29),
        "past": date(2026, 6, 29),
    }
    out = by(documents(spark, *[{"document_id": k, "expiry_date": v} for k, v in edges.items()]), "document_id")
    assert {k: (r.days_until_expiry, r.is_expired, r.expiry_within_90_days) for k, r in out.items()} == {
        "none": (None, False, False),
        "today": (0, False, True),
        "d90": (90, False, True),
        "d91": (91, False, False),
        "past": (-1, True, False),
    }


def test_watchlist_flags(spark):
    out = by(
        screening(
            spark,
            {"screening_id": "un", "watchlist_source": "un_sanctions", "match_status": " confirmed_match"},
            {"screening_id": "int", "watchlist_source": "INTERNAL_BLACKLIST", "match_status": "CONFIRMED_MATCH"},
            {"screening_id": "pos", "watchlist_source": "OFAC_SDN", "match_status": "POSSIBLE_MATCH"},
            {"screening_id": "no", "match_status": None},
        ),
        "screening_id",
    )
    assert {k: (r.is_potential_match, r.is_sanctions_confirmed) for k, r in out.items()} == {
        "un": (True, True),
        "int": (True, False),
        "pos": (True, False),
        "no": (False, False),
    }
