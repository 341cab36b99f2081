"""The daily run: landing tables in, bronze, silver and gold tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from amihan.operators import bronze
from amihan.operators.candidates import int_str_candidates
from amihan.operators.ctr import int_ctr_candidates
from amihan.operators.customer_day import KEYS, customer_day
from amihan.operators.kyc import int_kyc_health
from amihan.operators.layering import int_layering_detection
from amihan.operators.quality import dq_report, landing_report
from amihan.operators.risk import int_customer_risk_rating
from amihan.operators.skew import hot_groups
from amihan.operators.structuring import int_structuring_detection
from amihan.params import AmlParams
from amihan.plans import dimensions, facts
from amihan.schemas import RAW
from amihan.sources.raw import read_raw
from amihan.sources.seeds import load_seeds
from amihan.sources.sinks import append_new_only, overwrite_table


def run_daily(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    params: AmlParams,
    seed_root: str | None = None,
) -> dict[str, DataFrame]:
    """Build all tables below ``out_root`` and return them by name.

    Each table is written once and read back, so later tables start from
    files and a lost executor costs one stage, not the whole run.  All tables
    are rebuilt but the STR candidates, which are only added to.  The masked
    customer view is left in the session.
    """
    seeds = load_seeds(spark, seed_root)
    raw = {name: read_raw(spark, raw_root, name) for name in RAW}
    out: dict[str, DataFrame] = {}

    def put(layer: str, name: str, df: DataFrame, *cluster_by: str) -> DataFrame:
        out[name] = overwrite_table(df, f"{out_root}/{layer}/{name}", cluster_by)
        return out[name]

    # Bronze.
    txns = put("bronze", "stg_transactions", bronze.stg_transactions(raw["raw_transactions"], params))
    customers = put("bronze", "stg_customers", bronze.stg_customers(raw["raw_customers"], params))
    documents = put("bronze", "stg_kyc_documents", bronze.stg_kyc_documents(raw["raw_kyc_documents"], params))
    screening = put("bronze", "stg_watchlist", bronze.stg_watchlist(raw["raw_watchlist_screening"], params))

    # Silver.  The customer-days are stored once and serve three detections;
    # their largest days are salted where rows meet them.
    days = put("silver", "customer_day", customer_day(txns))
    hot = hot_groups(days, KEYS, "day_count")
    ctr = put("silver", "int_ctr_candidates", int_ctr_candidates(txns, params))
    put("silver", "int_structuring_detection", int_structuring_detection(txns, params, days, hot))
    put("silver", "int_layering_detection", int_layering_detection(txns, params, days, hot))
    kyc = put("silver", "int_kyc_health", int_kyc_health(customers, documents, params))
    risk = put(
        "silver",
        "int_customer_risk_rating",
        int_customer_risk_rating(customers, kyc, screening, seeds.weights, params),
    )
    str_path = f"{out_root}/silver/int_str_candidates"
    candidates = append_new_only(
        int_str_candidates(txns, customers, seeds, params, days, hot),
        str_path,
        ["str_candidate_id"],
    )
    out["int_str_candidates"] = candidates

    # Gold.  Facts are sorted within files by the date that reports filter on.
    branches = put("gold", "dim_branches", dimensions.dim_branches(seeds.branches, params))
    calendar = put("gold", "dim_date", dimensions.dim_date(spark, params, seeds.holidays))
    people = put("gold", "dim_customers", dimensions.dim_customers(customers, risk, params))
    dimensions.create_masked_view(people, params)
    covered = put(
        "gold",
        "fct_covered_transactions",
        facts.fct_covered_transactions(ctr, branches, calendar, seeds.holidays, params),
        "txn_date_ph",
    )
    suspicious = put(
        "gold",
        "fct_suspicious_transactions",
        facts.fct_suspicious_transactions(candidates, txns, seeds.indicators, seeds.holidays, params),
        "str_determination_ts",
    )
    compliance = put(
        "gold",
        "fct_customer_compliance",
        facts.fct_customer_compliance(customers, kyc, risk, covered, suspicious, params),
    )
    put(
        "gold",
        "fct_branch_compliance_summary",
        facts.fct_branch_compliance_summary(branches, compliance, covered, suspicious, params),
    )
    put(
        "audit",
        "dq_report",
        dq_report(
            {
                "stg_transactions": txns,
                "stg_customers": customers,
                "stg_kyc_documents": documents,
                "stg_watchlist": screening,
            }
        ).unionByName(landing_report(raw)),
    )
    return out
