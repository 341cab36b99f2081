from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F
from rows import PARAMS, by, customers, documents, screening

from amihan.functions.keys import surrogate_key, with_dense_key
from amihan.functions.masking import mask_pii
from amihan.operators.kyc import int_kyc_health
from amihan.operators.risk import int_customer_risk_rating
from amihan.plans.dimensions import dim_customers, vw_dim_customers_masked
from amihan.sources.seeds import load_seeds, read_seed


def test_kyc_scores(spark):
    people = customers(
        spark,
        {"customer_id": "none"},
        {"customer_id": "full"},
        {"customer_id": "licence"},
        {"customer_id": "expired"},
    )
    papers = documents(
        spark,
        {"customer_id": "full"},
        {"customer_id": "full", "document_type": "NATIONAL_ID", "expiry_date": date(2026, 7, 1)},
        {"customer_id": "full", "document_type": "POSTAL_ID"},
        {"customer_id": "licence", "document_type": "DRIVERS_LICENSE"},
        {"customer_id": "expired", "expiry_date": date(2020, 1, 1)},
    )
    out = by(int_kyc_health(people, papers, PARAMS), "customer_id")
    assert {k: r.kyc_completeness_score for k, r in out.items()} == {
        "none": 0, "full": 1, "licence": Decimal("0.4"), "expired": Decimal("0.3"),
    }
    assert all(r.kyc_exception for r in out.values())
    assert out["full"].has_docs_expiring_90d == 1 and out["none"].has_docs_expiring_90d == 0
    hundred = by(int_kyc_health(people, papers, PARAMS, hundred_scale=True), "customer_id")
    assert hundred["full"].kyc_completeness_score == 100 and not hundred["full"].kyc_exception


def test_kyc_freshness(spark):
    people = customers(
        spark,
        {"customer_id": "high", "risk_tier": "HIGH", "kyc_last_update_date": date(2025, 6, 29)},
        {"customer_id": "edge", "risk_tier": "HIGH", "kyc_last_update_date": date(2025, 6, 30)},
        {"customer_id": "leap", "risk_tier": "MEDIUM", "kyc_last_update_date": date(2024, 2, 29)},
        {"customer_id": "low", "risk_tier": "LOW", "kyc_last_update_date": date(2021, 6, 29)},
        {"customer_id": "null", "kyc_last_update_date": None},
    )
    out = by(int_kyc_health(people, documents(spark), PARAMS), "customer_id")
    assert {k: (r.kyc_freshness_flag, r.kyc_refresh_due_date) for k, r in out.items()} == {
        "high": (True, date(2026, 6, 29)),
        "edge": (False, date(2026, 6, 30)),
        "leap": (False, date(2027, 2, 28)),
        "low": (True, date(2026, 6, 29)),
        "null": (False, None),
    }


def rated(spark, people, hits=()):
    table = customers(spark, *people)
    kyc = int_kyc_health(table, documents(spark), PARAMS)
    weights = read_seed(spark, "aml_risk_weights")
    return by(int_customer_risk_rating(table, kyc, screening(spark, *hits), weights, PARAMS), "customer_id")


def test_risk_rating(spark):
    out = rated(
        spark,
        [
            {"customer_id": "max", "is_pep": True, "customer_type": "SOLEPROPRIETOR", "nationality": "KP",
             "account_status": "FROZEN"},
            {"customer_id": "unknown", "customer_type": None, "nationality": None, "account_status": "ODD"},
            {"customer_id": "clean"},
        ],
        [
            {"customer_id": "max", "watchlist_source": "OFAC_SDN", "match_status": "CONFIRMED_MATCH"},
            {"customer_id": "clean"},
        ],
    )
    top = out["max"]
    assert (top.overall_risk_score, top.overall_risk_tier) == (65, "MEDIUM")  # HIGH cannot be reached
    assert top.risk_factors == ["PEP", "FROZEN_ACCOUNT", "WATCHLIST_HIT", "INCOMPLETE_KYC"]
    unknown = out["unknown"]
    assert (unknown.customer_type_risk_score, unknown.geography_risk_score, unknown.account_status_risk_score) == (
        25, 10, 10,
    )
    assert out["clean"].watchlist_risk_score == 15  # any screening row counts


def test_tier_comes_from_the_unrounded_score(spark):
    """80 + 30 + 50 + 40 + 30 + 20 = 250 -> 50, MEDIUM; with 15 for the watchlist 245 -> 49, LOW."""
    person = {"is_pep": True, "nationality": "TR", "account_status": "FROZEN"}
    hit = {"match_confidence_pct": 60}
    out = rated(
        spark,
        [{**person, "customer_id": "a"}, {**person, "customer_id": "b"}],
        [{**hit, "customer_id": "a"}, {"customer_id": "b"}],
    )
    assert (out["a"].overall_risk_score, out["a"].overall_risk_tier) == (50, "MEDIUM")
    assert (out["b"].overall_risk_score, out["b"].overall_risk_tier) == (49, "LOW")


def test_masks(spark):
    df = spark.createDataFrame(
        [("A", "12", "a@b.c"), ("", "", ""), (None, None, None), ("Maria Cruz", "0012345678", "maria@x.org")],
        "name string, number string, mail string",
    )
    out = df.select(
        mask_pii(F.col("name")).alias("n"),
        mask_pii(F.col("number"), "account").alias("a"),
        mask_pii(F.col("mail"), "email").alias("e"),
        mask_pii(F.col("name"), "other").alias("o"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("A***A", "***12", "a***@b.c", None),
        ("***", "***", "***@", None),
        (None, None, None, None),
        ("M***uz", "***5678", "m***@x.org", None),
    ]


def test_masked_view_masks_again_without_change(spark):
    table = customers(spark, {"customer_id": "A", "sss_number": "12345678"}, {"customer_id": "B", "customer_name": "X"})
    kyc = int_kyc_health(table, documents(spark), PARAMS)
    risk = int_customer_risk_rating(table, kyc, screening(spark), load_seeds(spark).weights, PARAMS)
    dim = dim_customers(table, risk, PARAMS)
    masked = vw_dim_customers_masked(dim, PARAMS.masked_role, PARAMS)
    assert dim.exceptAll(masked).count() == 0
    assert vw_dim_customers_masked(dim, "analyst", PARAMS) is dim


def test_dense_key_is_the_rank(spark):
    df = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("k")).repartition(13)
    out = with_dense_key(df, "k", "n")
    expected = {k: i + 1 for i, k in enumerate(sorted(r.k for r in df.collect()))}
    assert {r.k: r.n for r in out.collect()} == expected


def test_surrogate_key_marks_null(spark):
    import hashlib

    row = spark.sql("select 'a' as x, cast(null as string) as y, date '2026-01-02' as z").select(
        surrogate_key("x", "y", "z").alias("k")
    )
    text = "a-_dbt_utils_surrogate_key_null_-2026-01-02"
    assert row.first().k == hashlib.md5(text.encode()).hexdigest()
