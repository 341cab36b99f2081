"""Suspicion signals: one row per transaction and indicator."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.operators.layering import LAYERING_CODE
from amihan.operators.skew import keep_groups
from amihan.operators.structuring import STRUCTURING_CODE
from amihan.params import AmlParams
from amihan.sources.seeds import Jurisdiction

# Indicator codes.
BLACKLIST_CODE, GREYLIST_CODE = "JURIS_01", "JURIS_02"
PEP_CODE = "PEP_01"
ROUND_CODE = "ROUND_01"

KEYS = ("customer_id", "txn_id", "branch_code", "txn_date_ph")


def _signal(rows: DataFrame, code: Column, score: Column, detail: Column, count_7d: Column | None = None) -> DataFrame:
    no_count = F.lit(None).cast("long")
    return rows.select(
        *KEYS,
        code.alias("indicator_code"),
        score.cast("int").alias("signal_risk_score"),
        (no_count if count_7d is None else count_7d).alias("txn_count_7d"),
        detail.cast("string").alias("signal_detail"),
    )


def signal_structuring(structuring: DataFrame) -> DataFrame:
    return _signal(
        structuring.filter("is_structuring_pattern"),
        F.lit(STRUCTURING_CODE),
        F.col("risk_score_structuring"),
        F.lit(None),
        F.col("txn_count_7d"),
    )


def signal_layering(layering: DataFrame) -> DataFrame:
    return _signal(
        layering.filter("is_layering_pattern"),
        F.lit(LAYERING_CODE),
        F.col("risk_score_layering"),
        F.col("net_position_pct"),
    )


def _contains(text: Column, part: str | None) -> Column:
    return F.lit(False) if part is None else text.like(f"%{part}%")


def jurisdiction_hit(entry: Jurisdiction, active_only: bool = False) -> Column:
    """Whether a transaction names a jurisdiction.

    As specified: the upper-cased bank name contains the two-letter code, or
    the upper-cased purpose contains the country name as written in the list.
    ``active_only`` compares names in upper case on both sides and passes
    over entries already removed on the transaction date.
    """
    bank, purpose = F.upper("counterparty_bank"), F.upper("purpose_description")
    code, name = entry.iso2_code, entry.country_name
    if active_only:
        code, name = code.upper(), name and name.upper()
    hit = F.coalesce(_contains(bank, code) | _contains(purpose, name), F.lit(False))
    if active_only and entry.removal_date is not None:
        hit = hit & (F.col("txn_date_ph") < F.lit(entry.removal_date))
    return hit


def jurisdiction_hits(
    jurisdictions: Sequence[Jurisdiction], params: AmlParams, active_only: bool = False
) -> tuple[Column, Column]:
    """(any hit, array of hits): code, score and country per matched entry.

    The list is a bounded seed, so the comparison is row-local: no join.
    """
    hits, items = [], []
    for entry in jurisdictions:
        hit = jurisdiction_hit(entry, active_only)
        black = entry.fatf_list_type == "BLACKLIST"
        hits.append(hit)
        items.append(
            F.when(
                hit,
                F.struct(
                    F.lit(BLACKLIST_CODE if black else GREYLIST_CODE).alias("code"),
                    F.lit(params.blacklist_score if black else params.greylist_score).alias("score"),
                    F.lit(entry.country_name).alias("detail"),
                ),
            )
        )
    return reduce(or_, hits), F.array_compact(F.array(*items))


def signal_fatf(
    transactions: DataFrame,
    customers: DataFrame,
    jurisdictions: Sequence[Jurisdiction],
    params: AmlParams,
    active_only: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Transactions of known customers that name a listed jurisdiction.

    Rows are filtered before they are shuffled to meet the customers; several
    jurisdictions in one row give several signals.  ``hot`` has the customers
    with very many transactions, to be salted.
    """
    any_hit, hits = jurisdiction_hits(jurisdictions, params, active_only)
    rows = transactions.filter(any_hit).select(*KEYS, hits.alias("_hits"))
    known = keep_groups(rows, customers, ["customer_id"], F.col("txn_id"), hot)
    each = known.withColumn("_hit", F.explode("_hits"))
    return _signal(each, F.col("_hit.code"), F.col("_hit.score"), F.col("_hit.detail"))


def signal_pep(transactions: DataFrame, customers: DataFrame, params: AmlParams, hot: DataFrame | None = None) -> DataFrame:
    """Larger transactions of politically exposed customers; ``hot`` as in :func:`signal_fatf`."""
    rows = transactions.filter(F.col("amount_php") >= params.pep_min_amount).select(*KEYS, "amount_php")
    return _signal(
        keep_groups(rows, customers.filter("is_pep"), ["customer_id"], F.col("txn_id"), hot),
        F.lit(PEP_CODE),
        F.lit(params.pep_signal_score),
        F.col("amount_php"),
    )


def is_round_cash(params: AmlParams) -> Column:
    amounts = [F.lit(a).cast("decimal(19,2)") for a in params.round_amounts]
    return F.col("amount_php").isin(*amounts) & (F.col("txn_type") == "CASH")


def signal_round_number(transactions: DataFrame, params: AmlParams) -> DataFrame:
    """Cash in one of the listed round amounts."""
    return _signal(
        transactions.filter(is_round_cash(params)), F.lit(ROUND_CODE), F.lit(params.round_score), F.col("amount_php")
    )


def union_signals(*signals: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, signals)
