from dataclasses import replace
from datetime import date, datetime, timezone

from rows import PARAMS, by, customers, txns

from amihan.operators import signals
from amihan.operators.candidates import agg_signals, as_candidates, int_str_candidates
from amihan.operators.customer_day import KEYS, customer_day
from amihan.operators.layering import int_layering_detection
from amihan.operators.skew import hot_groups
from amihan.operators.structuring import int_structuring_detection
from amihan.plans.facts import fct_suspicious_transactions
from amihan.sources.seeds import load_seeds
from amihan.sources.sinks import append_new_only


def table(spark):
    return txns(
        spark,
        {"txn_id": "metro", "txn_type": "RTGS", "counterparty_bank": "MetroBank"},
        {"txn_id": "nobank", "txn_type": "RTGS", "counterparty_bank": None, "purpose_description": "to Iran"},
        {"txn_id": "two", "txn_type": "RTGS", "counterparty_bank": "SYRIA TRUST"},
        {"txn_id": "stranger", "customer_id": "C9", "txn_type": "RTGS", "counterparty_bank": "KP BANK"},
        {"txn_id": "strange_round", "customer_id": "C9", "amount_php": 100000},
        {"txn_id": "pep", "customer_id": "P", "amount_php": 50000, "txn_type": "RTGS"},
        {"txn_id": "pep_small", "customer_id": "P", "amount_php": 49999.99, "txn_type": "RTGS"},
        *[{"txn_id": f"s{i}", "customer_id": "S", "amount_php": 150001} for i in range(3)],
    )


def people(spark):
    return customers(
        spark, {"customer_id": "C1"}, {"customer_id": "P", "is_pep": True}, {"customer_id": "S"}
    )


def literal(spark, t, c, seeds, params=PARAMS, signed_net=False):
    """Union of the single signals, regrouped."""
    parts = [
        signals.signal_structuring(int_structuring_detection(t, params)),
        signals.signal_layering(int_layering_detection(t, params, signed_net=signed_net)),
        signals.signal_fatf(t, c, seeds.jurisdictions, params),
        signals.signal_pep(t, c, params),
        signals.signal_round_number(t, params),
    ]
    return as_candidates(agg_signals(signals.union_signals(*parts)), params)


def test_signals_per_transaction(spark):
    seeds = load_seeds(spark)
    out = by(int_str_candidates(table(spark), people(spark), seeds, PARAMS), "txn_id")
    assert {k: (r.str_indicators, r.max_risk_score, r.signal_details) for k, r in out.items()} == {
        "metro": (["JURIS_02"], 50, "Turkey"),  # METROBANK contains TR
        "two": (["JURIS_01", "JURIS_02"], 90, "Syria; Turkey"),
        "strange_round": (["ROUND_01"], 30, "100000.00"),
        "pep": (["PEP_01"], 75, "50000.00"),
        **{f"s{i}": (["STRUCT_01"], 70, None) for i in range(3)},
    }
    assert out["two"].str_confidence_level == "MEDIUM" and out["pep"].str_confidence_level == "LOW"


def test_one_pass_equals_the_union_of_signals(spark):
    seeds, t, c = load_seeds(spark), table(spark), people(spark)
    days = customer_day(t)
    hot = hot_groups(days, KEYS, "day_count", rows_per_split=2)
    expected = literal(spark, t, c, seeds)
    for job in (int_str_candidates(t, c, seeds, PARAMS), int_str_candidates(t, c, seeds, PARAMS, days, hot)):
        assert expected.exceptAll(job).count() == 0 and job.exceptAll(expected).count() == 0


def test_one_pass_with_signed_net_has_layering(spark):
    seeds, c = load_seeds(spark), people(spark)
    t = txns(
        spark,
        {"txn_id": "in", "transaction_direction": "CREDIT", "amount_php": 100000, "txn_type": "RTGS"},
        {"txn_id": "out", "amount_php": 95000, "txn_type": "RTGS", "txn_date_ph": date(2026, 6, 2)},
    )
    job = int_str_candidates(t, c, seeds, PARAMS, signed_net=True)
    expected = literal(spark, t, c, seeds, signed_net=True)
    assert by(job, "txn_id")["out"].str_indicators == ["LAYER_01"]
    assert expected.exceptAll(job).count() == 0 and job.exceptAll(expected).count() == 0
    assert int_str_candidates(t, c, seeds, PARAMS).count() == 0
    loose = replace(PARAMS, layering_max_net_ratio=2)
    assert by(int_str_candidates(t, c, seeds, loose), "txn_id")["out"].str_indicators == ["LAYER_01"]


def test_candidates_freeze_on_first_sight(spark, tmp_path):
    path, seeds = str(tmp_path / "candidates"), load_seeds(spark)
    t, c = table(spark), people(spark)
    first = append_new_only(int_str_candidates(t, c, seeds, PARAMS), path, ["str_candidate_id"]).count()
    later = replace(PARAMS, run_ts=datetime(2026, 7, 15, 2, 0, tzinfo=timezone.utc), pep_signal_score=99)
    again = append_new_only(int_str_candidates(t, c, seeds, later), path, ["str_candidate_id"])
    assert again.count() == first == 7
    assert by(again, "txn_id")["pep"].max_risk_score == 75
    assert {r.str_determination_ts.day for r in again.collect()} == {30}
    more = t.unionByName(txns(spark, {"txn_id": "new", "customer_id": "P", "amount_php": 60000}))
    grown = append_new_only(int_str_candidates(more, c, seeds, later), path, ["str_candidate_id"])
    assert grown.count() == first + 1
    assert by(grown, "txn_id")["new"].str_determination_ts.month == 7


def test_urgency_by_days_left(spark):
    """Determined 2026-06-30, so due 2026-07-07."""
    seeds, t, c = load_seeds(spark), table(spark), people(spark)
    found = int_str_candidates(t, c, seeds, PARAMS)
    seen = {}
    for today in (date(2026, 7, d) for d in (4, 5, 6, 7, 8)):
        at = replace(PARAMS, as_of=today)
        fact = fct_suspicious_transactions(found, t, seeds.indicators, seeds.holidays, at)
        row = by(fact, "txn_id")["two"]
        seen[today.day] = (row.days_to_deadline, row.filing_urgency)
    assert seen == {4: (3, "PENDING"), 5: (2, "DUE_SOON"), 6: (1, "DUE_SOON"), 7: (0, "OVERDUE"), 8: (-1, "OVERDUE")}
    assert (row.jurisdiction_risk, row.structuring_risk, row.transaction_amount_php) == (140, 0, 1000)
