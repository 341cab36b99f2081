"""Suspicious-transaction candidates: all signals of a transaction in one row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.functions.calendar import run_manila
from amihan.functions.keys import surrogate_key
from amihan.functions.scoring import confidence_label
from amihan.operators.customer_day import KEYS as DAY_KEYS
from amihan.operators.customer_day import (
    cash_debit,
    customer_day,
    structuring_qualifies,
    structuring_windows,
)
from amihan.operators.layering import LAYERING_CODE, layering_windows
from amihan.operators.signals import (
    BLACKLIST_CODE,
    GREYLIST_CODE,
    KEYS,
    PEP_CODE,
    ROUND_CODE,
    is_round_cash,
    jurisdiction_hit,
)
from amihan.operators.skew import join_groups
from amihan.operators.structuring import STRUCTURING_CODE, is_structuring_row
from amihan.params import AmlParams
from amihan.sources.seeds import Jurisdiction, Seeds
from amihan.sources.sinks import rows_with_new_keys

# Jurisdictions per bit mask.
_MASK_BITS = 62


def _text_or_null(parts: Column) -> Column:
    """Sorted parts joined with '; '; NULL when there are none."""
    return F.when(F.size(parts) > 0, F.array_join(F.sort_array(parts), "; "))


def agg_signals(signals: DataFrame) -> DataFrame:
    """Signals of each transaction as one row.

    The sets hold at most the indicators and details of one transaction.
    """
    return (
        signals.groupBy(*KEYS)
        .agg(
            F.collect_set("indicator_code").alias("_codes"),
            F.max("signal_risk_score").alias("max_risk_score"),
            F.collect_set("signal_detail").alias("_details"),
        )
        .select(
            *KEYS,
            F.sort_array("_codes").alias("str_indicators"),
            F.size("_codes").cast("long").alias("indicator_count"),
            "max_risk_score",
            _text_or_null(F.col("_details")).alias("signal_details"),
        )
    )


def as_candidates(aggregated: DataFrame, params: AmlParams, existing: DataFrame | None = None) -> DataFrame:
    """Candidate rows with the time of determination.

    A candidate already in ``existing`` is left out, so its first
    determination and its indicators stay as they are.
    """
    determined = run_manila(params)
    candidates = aggregated.select(
        surrogate_key("customer_id", "txn_id").alias("str_candidate_id"),
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "str_indicators",
        "indicator_count",
        "max_risk_score",
        "signal_details",
        determined.alias("str_determination_ts"),
        determined.alias("str_determination_date"),
        confidence_label(F.col("indicator_count")).alias("str_confidence_level"),
        determined.alias("dbt_loaded_at"),
    )
    return rows_with_new_keys(candidates, existing, ["str_candidate_id"]).select(*candidates.columns)


def _is_black(jurisdiction: Jurisdiction) -> bool:
    return jurisdiction.fatf_list_type == "BLACKLIST"


def jurisdiction_masks(jurisdictions: Sequence[Jurisdiction]) -> dict[str, Column]:
    """The matched jurisdictions of a row as bits, a number per list part.

    Numbers travel through the shuffle instead of arrays of texts.
    """
    masks = {}
    for start in range(0, len(jurisdictions), _MASK_BITS):
        part = jurisdictions[start : start + _MASK_BITS]
        bits = [F.when(jurisdiction_hit(j), F.lit(1 << i)).otherwise(0).cast("long") for i, j in enumerate(part)]
        masks[f"_listed{start // _MASK_BITS}"] = reduce(add, bits)
    return masks


def any_bit(jurisdictions: Sequence[Jurisdiction], wanted: Callable[[Jurisdiction], bool]) -> Column:
    """Whether one of the wanted jurisdictions is among the matched ones."""
    tests = []
    for start in range(0, len(jurisdictions), _MASK_BITS):
        part = jurisdictions[start : start + _MASK_BITS]
        bits = sum(1 << i for i, j in enumerate(part) if wanted(j))
        if bits:
            tests.append(F.col(f"_listed{start // _MASK_BITS}").bitwiseAND(F.lit(bits).cast("long")) != 0)
    return reduce(or_, tests) if tests else F.lit(False)


def matched_names(jurisdictions: Sequence[Jurisdiction]) -> Column:
    """The country names of the matched jurisdictions."""
    parts = []
    for start in range(0, len(jurisdictions), _MASK_BITS):
        part = jurisdictions[start : start + _MASK_BITS]
        mask = F.col(f"_listed{start // _MASK_BITS}")
        entries = F.array(
            *[
                F.struct(F.lit(1 << i).cast("long").alias("bit"), F.lit(j.country_name).alias("name"))
                for i, j in enumerate(part)
            ]
        )
        hit = F.filter(entries, lambda e: mask.bitwiseAND(e["bit"]) != 0)  # noqa: B023
        parts.append(F.transform(hit, lambda e: e["name"]))
    return F.concat(*parts) if parts else F.array().cast("array<string>")


def customer_day_profile(
    daily: DataFrame, customers: DataFrame, params: AmlParams, with_layering: bool, signed_net: bool
) -> DataFrame:
    """What the rows of a customer-day must know: windows and customer flags.

    The flags join here, on at most one row per customer and date, instead of
    on the transactions, where one customer may own most of the rows.
    """
    structuring = F.coalesce(structuring_qualifies(params), F.lit(False)).alias("_structuring")
    profile = structuring_windows(daily, params).select(*DAY_KEYS, structuring)
    if with_layering:
        layering = layering_windows(daily, params, signed_net).select(
            *DAY_KEYS, F.col("is_layering_pattern").alias("_layering"), F.col("net_position_pct").alias("_net_pct")
        )
        profile = profile.join(layering, DAY_KEYS, "left")
    flags = customers.select("customer_id", F.lit(True).alias("_known"), F.col("is_pep").alias("_pep"))
    return profile.join(flags, "customer_id", "left")


def int_str_candidates(
    transactions: DataFrame,
    customers: DataFrame,
    seeds: Seeds,
    params: AmlParams,
    daily: DataFrame | None = None,
    hot: DataFrame | None = None,
    existing: DataFrame | None = None,
    signed_net: bool = False,
) -> DataFrame:
    """Candidates in two passes over the transactions and one shuffle of rows.

    Pass one builds the customer-days.  Pass two joins each row to its day
    and derives all its signals in place, so no union of five scans and no
    regrouping is needed.  Equal to ``agg_signals`` over the single signals
    because a transaction id and date identify one row (the landing key).
    """
    daily = customer_day(transactions) if daily is None else daily
    # The net amount as specified is never below in + out, so without
    # ``signed_net`` the pattern needs a limit above 1 to fire at all.
    with_layering = signed_net or params.layering_max_net_ratio > 1
    profile = customer_day_profile(daily, customers, params, with_layering, signed_net)

    masks = jurisdiction_masks(seeds.jurisdictions)
    listed = reduce(or_, [jurisdiction_hit(j) for j in seeds.jurisdictions], F.lit(False))
    small_cash = cash_debit() & is_structuring_row(params)
    large = F.col("amount_php") >= params.pep_min_amount
    rows = transactions.filter(F.col("amount_php") > 0)
    if not with_layering:
        # Cheap tests first; text is searched only where they fail.
        rows = rows.filter(small_cash | large | is_round_cash(params) | listed)
    rows = rows.select(
        *KEYS,
        "amount_php",
        small_cash.alias("_small_cash"),
        is_round_cash(params).alias("_round"),
        *[mask.alias(name) for name, mask in masks.items()],
    )

    # One flag per indicator, listed in text order of the codes.
    known, jurisdictions = F.col("_known"), seeds.jurisdictions
    indicators = {
        BLACKLIST_CODE: (known & any_bit(jurisdictions, _is_black), params.blacklist_score),
        GREYLIST_CODE: (known & any_bit(jurisdictions, lambda j: not _is_black(j)), params.greylist_score),
        PEP_CODE: (F.col("_pep") & large, params.pep_signal_score),
        ROUND_CODE: (F.col("_round"), params.round_score),
        STRUCTURING_CODE: (F.col("_small_cash") & F.col("_structuring"), params.structuring_score),
    }
    if with_layering:
        indicators[LAYERING_CODE] = (F.col("_layering"), params.layering_score)
    flags = {code: flag for code, (flag, _) in indicators.items()}
    # One number instead of a disjunction: the optimizer would take an OR apart
    # and repeat its left-side terms, text search included, below the join.
    any_flag = F.greatest(*[F.when(flag, F.lit(1)).otherwise(0) for flag in flags.values()]) > 0
    signaled = join_groups(rows, profile, DAY_KEYS, F.col("txn_id"), hot).filter(any_flag)

    codes = F.array_compact(F.array(*[F.when(flags[code], code) for code in sorted(flags)]))
    scores = [F.when(flag, F.lit(score)).otherwise(0) for flag, score in indicators.values()]
    texts = [F.when(flags[PEP_CODE] | flags[ROUND_CODE], F.col("amount_php").cast("string"))]
    if with_layering:
        texts.append(F.when(flags[LAYERING_CODE], F.col("_net_pct").cast("string")))
    countries = F.when(known, matched_names(jurisdictions)).otherwise(F.array().cast("array<string>"))
    described = signaled.select(
        *KEYS,
        codes.alias("str_indicators"),
        F.greatest(*scores).alias("max_risk_score"),
        F.array_distinct(F.array_compact(F.concat(countries, F.array(*texts)))).alias("_details"),
    )
    aggregated = described.select(
        *KEYS,
        "str_indicators",
        F.size("str_indicators").cast("long").alias("indicator_count"),
        "max_risk_score",
        _text_or_null(F.col("_details")).alias("signal_details"),
    )
    return as_candidates(aggregated, params, existing)
