"""The opt-in run: documented rules beside the daily tables, from what the daily run published."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.operators import extensions as ext
from amihan.operators.customer_day import KEYS as DAY_KEYS
from amihan.operators.kyc import int_kyc_health
from amihan.operators.layering import int_layering_detection
from amihan.operators.signals import signal_fatf
from amihan.operators.skew import hot_groups
from amihan.params import AmlParams
from amihan.sources import published
from amihan.sources.seeds import load_seeds
from amihan.sources.sinks import overwrite_table

# Codes and scores of the documented rules on flagged customers.
KYC_CODE, KYC_SCORE = "KYC_DEFICIENCY", 40
WATCHLIST_CODE, WATCHLIST_SCORE = "WATCHLIST_MATCH", 50


def run_optional(spark: SparkSession, out_root: str, params: AmlParams, seed_root: str | None = None) -> dict[str, DataFrame]:
    """Build the opt-in tables below ``out_root/optional`` and return them by name.

    Groups with very many rows are salted where rows meet them: customer-days
    for dormancy, accounts and days for smurfing, customers for flags.  The customer history is
    carried on from its last version; a second run on one day changes nothing.
    """
    out_root = out_root.rstrip("/")
    seeds = load_seeds(spark, seed_root)
    out: dict[str, DataFrame] = {}

    def table(layer: str, name: str) -> DataFrame:
        found = published.read(spark, f"{out_root}/{layer}/{name}")
        if found is None:
            raise ValueError(f"{layer}/{name} has not been published below {out_root}")
        return found

    def put(name: str, df: DataFrame, *cluster_by: str) -> None:
        out[name] = overwrite_table(df, f"{out_root}/optional/{name}", cluster_by)

    txns, customers = table("bronze", "stg_transactions"), table("bronze", "stg_customers")
    documents, screening = table("bronze", "stg_kyc_documents"), table("bronze", "stg_watchlist")
    days = table("silver", "customer_day")
    hot_days = hot_groups(days, DAY_KEYS, "day_count")
    hot_customers = hot_groups(days.groupBy("customer_id").agg(F.sum("day_count").alias("_n")), ["customer_id"], "_n")
    put("layering_net_intent", int_layering_detection(txns, params, days, hot_days, signed_net=True).where("is_layering_pattern"))
    put("kyc_score_100", int_kyc_health(customers, documents, params, hundred_scale=True))
    numbered = txns.select("counterparty_account", ext.banking_day_number(F.col("txn_date_ph"), seeds.holidays).alias("_day"))
    per_day = numbered.where("counterparty_account is not null").groupBy("counterparty_account", "_day").agg(F.count("*").alias("_n"))
    hot_accounts = hot_groups(per_day, ["counterparty_account", "_day"], "_n")
    signals = (
        ext.signal_dormancy(txns, params, hot_days)
        .unionByName(ext.signal_smurfing(txns, params, seeds.holidays, hot_accounts))
        .unionByName(ext.signal_flagged_customers(txns, out["kyc_score_100"].where("kyc_exception"), KYC_CODE, KYC_SCORE, hot_customers))
        .unionByName(ext.signal_flagged_customers(txns, screening.where("is_potential_match"), WATCHLIST_CODE, WATCHLIST_SCORE, hot_customers))
    )
    put("signals", signals, "txn_date_ph")
    put("fatf_active", signal_fatf(txns, customers, seeds.jurisdictions, params, active_only=True, hot=hot_customers), "txn_date_ph")
    snapshot = table("gold", "dim_customers").drop("valid_from", "valid_to", "is_current", "dbt_loaded_at", "customer_sk")
    history = published.read(spark, f"{out_root}/optional/customer_history")
    if history is None:
        start = {"valid_from": F.lit(params.as_of), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True)}
        put("customer_history", snapshot.withColumns(start))
    else:
        put("customer_history", ext.scd2_customers(history, snapshot.select(*[c for c in history.columns if c in snapshot.columns]), params))
    put("retained_transactions", ext.retention_filter(txns, params), "txn_date_ph")
    return out
