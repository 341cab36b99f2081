"""Sinks, reports, quality checks and the daily run."""

import os
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import functions as F
from rows import PARAMS, by, customers, raw_customers, raw_documents, raw_screening, raw_txns, screening, txns

from amihan.operators import quality as dq
from amihan.operators.extensions import scd2_customers, signal_dormancy, signal_smurfing
from amihan.operators.skew import hot_groups, join_groups
from amihan.plans.daily import run_daily
from amihan.plans.reports import ctr_monthly, report_path, write_csv_report
from amihan.sources import sinks, star
from amihan.sources.raw import read_transactions_between
from amihan.sources.seeds import listed_rows, load_seeds, read_seed

SF_DIR = "/root/testdata/sf0.001"


def test_append_ignores_known_and_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["txn_id", "txn_date_ph"]
    sinks.append_ignore_conflict(raw_txns(spark, {"txn_id": "A", "amount_php": 1}), path, keys)
    batch = raw_txns(
        spark,
        {"txn_id": "A", "amount_php": 2},
        {"txn_id": "A", "amount_php": 3, "txn_date_ph": date(2026, 6, 2)},
        {"txn_id": "B", "amount_php": 5},
        {"txn_id": "B", "amount_php": 4},
    )
    out = sinks.append_ignore_conflict(batch, path, keys).collect()
    assert sorted((r.txn_id, r.txn_date_ph.day, int(r.amount_php)) for r in out) == [
        ("A", 1, 1), ("A", 2, 3), ("B", 1, 4),
    ]


def test_yearly_append_compares_with_the_dates_of_the_batch(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["txn_id", "txn_date_ph"]

    def put(*days):
        rows = [{"txn_id": name, "txn_date_ph": day, "amount_php": amount} for name, day, amount in days]
        return sinks.append_ignore_conflict(raw_txns(spark, *rows), path, keys, by_year=True)

    put(("A", date(2024, 12, 31), 1), ("B", date(2025, 1, 1), 1))
    put()
    out = put(("A", date(2024, 12, 31), 2), ("A", date(2025, 1, 2), 2), ("B", date(2025, 1, 1), 2), ("C", date(2026, 1, 1), 2))
    assert sorted((r.txn_id, r.txn_date_ph.year, int(r.amount_php)) for r in out.collect()) == [
        ("A", 2024, 1), ("A", 2025, 2), ("B", 2025, 1), ("C", 2026, 2),
    ]
    plan = sinks._on_dates_of(out, raw_txns(spark, {"txn_date_ph": date(2025, 1, 2)}))
    assert "PartitionFilters: [isnotnull(txn_year" in plan._jdf.queryExecution().executedPlan().toString()


def test_customer_upsert_changes_three_columns(spark):
    current = raw_customers(spark, {"customer_id": "A", "branch_code": "OLD"}, {"customer_id": "B"})
    incoming = raw_customers(
        spark,
        {"customer_id": "A", "customer_name": "New", "risk_tier": "HIGH", "kyc_last_update_date": None, "branch_code": "X"},
        {"customer_id": "C", "branch_code": "X"},
    )
    out = by(sinks.merge_customers(current, incoming), "customer_id")
    assert set(out) == {"A", "B", "C"}
    a = out["A"]
    assert (a.customer_name, a.risk_tier, a.kyc_last_update_date, a.branch_code) == ("New", "HIGH", None, "OLD")
    assert out["C"].branch_code == "X" and out["B"].customer_name == "Maria Cruz"


def test_year_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "years")
    rows = [{"txn_id": f"T{y}", "txn_date_ph": date(y, 3, 1)} for y in range(2019, 2026)]
    sinks.write_by_year(raw_txns(spark, *rows), path)
    out = read_transactions_between(spark, path, date(2021, 1, 1), date(2022, 12, 31))
    assert {r.txn_id for r in out.collect()} == {"T2021", "T2022"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_year" in plan


def test_report_is_written_in_order(spark, tmp_path):
    from amihan.catalog.lake import Lake

    covered = Lake(spark, SF_DIR).covered
    path = write_csv_report(ctr_monthly(covered, 2026, 6), report_path(str(tmp_path), "ctr", 2026, 6))
    assert path.endswith("/2026/06/ctr_report_202606.csv")
    lines = []
    for name in sorted(n for n in os.listdir(path) if n.startswith("part-")):
        with open(os.path.join(path, name)) as f:
            header, *body = f.read().splitlines()
            assert header == "CTR ID,Customer ID,Branch,Txn Date,Amount (PHP),Type,Status,Filed Date"
            lines += body
    days = [line.split(",")[3] for line in lines]
    assert len(lines) == covered.count() and days == sorted(days, reverse=True)
    assert ctr_monthly(covered, 2026, 7).count() == 0 and ctr_monthly(covered, 2025, 12).count() == 0


def test_quality_report_counts_failures(spark):
    tables = {
        "stg_transactions": txns(
            spark,
            {"txn_id": "A"},
            {"txn_id": "A", "transaction_direction": "X"},
            {"txn_id": None, "transaction_direction": "Y"},
            {"txn_id": None, "transaction_direction": None, "txn_type": None},
            {"txn_id": "E", "transaction_direction": "X"},
        ),
        "stg_customers": customers(spark, {"customer_id": "A", "account_status": None}),
        "stg_kyc_documents": spark.createDataFrame(
            [], "document_id string, customer_id string, document_type string, issue_date date, is_expired boolean"
        ),
        "stg_watchlist": screening(spark, {"match_confidence_pct": 101}, {"match_confidence_pct": None}),
    }
    out = {(r.table_name, r.column_name, r.test_name): r.failures for r in dq.dq_report(tables).collect()}
    assert len(out) == 28
    assert {k: v for k, v in out.items() if v} == {
        ("stg_transactions", "txn_id", "unique"): 1,
        ("stg_transactions", "txn_id", "not_null"): 2,
        ("stg_transactions", "txn_type", "not_null"): 1,
        ("stg_transactions", "transaction_direction", "accepted_values"): 2,
        ("stg_watchlist", "match_confidence_pct", "accepted_range"): 1,
    }


def test_landing_rows_outside_the_lists_are_quarantined(spark):
    rows = raw_txns(spark, {"txn_id": "A"}, {"txn_id": "B", "txn_type": "SWIFT"}, {"txn_id": "C", "txn_channel": None})
    good, bad = dq.landing_split(rows, "raw_transactions")
    assert {r.txn_id for r in good.collect()} == {"A", "C"} and {r.txn_id for r in bad.collect()} == {"B"}


def test_dormancy(spark):
    rows = [
        {"txn_id": "old", "txn_date_ph": date(2026, 1, 1)},
        {"txn_id": "woke", "txn_date_ph": date(2026, 4, 1), "transaction_direction": "CREDIT", "amount_php": 100000},
        {"txn_id": "small", "txn_date_ph": date(2026, 4, 1), "transaction_direction": "CREDIT", "amount_php": 99999},
        {"txn_id": "next", "txn_date_ph": date(2026, 4, 2), "transaction_direction": "CREDIT", "amount_php": 200000},
        {"txn_id": "first", "customer_id": "N", "transaction_direction": "CREDIT", "amount_php": 200000},
    ]
    out = by(signal_dormancy(txns(spark, *rows), PARAMS), "txn_id")
    assert {k: r.signal_detail for k, r in out.items()} == {"woke": "90"}


def test_smurfing_equals_brute_force(spark):
    """One account receives from most customers; weekends and a holiday lie between."""
    holidays = load_seeds(spark).holidays
    rows = [
        {
            "txn_id": f"T{i:03d}",
            "customer_id": f"C{(i * i) % 11}",
            "counterparty_account": "HOT" if i % 3 == 0 else f"A{i % 9}",
            "txn_date_ph": date(2026, 6, 1) + timedelta(days=(i * 5) % 28),
        }
        for i in range(120)
    ]
    rows.append({"txn_id": "none", "counterparty_account": None})

    def number(d):
        days = (date(2026, 5, 1) + timedelta(days=i) for i in range((d - date(2026, 5, 1)).days + 1))
        return sum(x.weekday() < 5 and x not in holidays for x in days)

    expected = {}
    for t in rows[:-1]:
        senders = {
            u["customer_id"]
            for u in rows[:-1]
            if u["counterparty_account"] == t["counterparty_account"]
            and 0 <= number(t["txn_date_ph"]) - number(u["txn_date_ph"]) <= 2
        }
        if len(senders) >= 3:
            expected[t["txn_id"]] = str(len(senders))
    out = by(signal_smurfing(txns(spark, *rows), PARAMS, holidays), "txn_id")
    assert {k: r.signal_detail for k, r in out.items()} == expected and len(expected) > 20


def test_scd2_history(spark):
    columns = "customer_id string, risk_tier string, valid_from date, valid_to date, is_current boolean"
    start, end = date(2025, 1, 1), date(2025, 6, 1)
    history = spark.createDataFrame(
        [
            ("same", "LOW", start, None, True),
            ("up", "MEDIUM", start, end, False),
            ("up", "LOW", end, None, True),
            ("gone", "LOW", start, None, True),
        ],
        columns,
    )
    now = spark.createDataFrame([("same", "LOW"), ("up", "HIGH"), ("new", "LOW")], "customer_id string, risk_tier string")
    out = sorted(tuple(r) for r in scd2_customers(history, now, PARAMS).fillna(0).collect())
    today = PARAMS.as_of
    assert out == sorted(
        [
            ("same", "LOW", start, None, True),
            ("up", "MEDIUM", start, end, False),
            ("up", "LOW", end, today, False),
            ("gone", "LOW", start, None, True),
            ("up", "HIGH", today, None, True),
            ("new", "LOW", today, None, True),
        ]
    )


def test_seed_types_and_bound(spark, tmp_path):
    assert read_seed(spark, "fatf_jurisdictions").filter("removal_date is not null").count() == 1
    counts = {"ph_branches": 36, "aml_risk_weights": 70, "ph_non_working_days": 37, "str_indicators_ref": 9}
    for name, n in counts.items():
        assert read_seed(spark, name).count() == n
    (tmp_path / "ph_non_working_days.csv").write_text("calendar_date,holiday_name,holiday_type\n2030-01-01,New Year,\n")
    own = read_seed(spark, "ph_non_working_days", str(tmp_path)).collect()
    assert [tuple(r) for r in own] == [(date(2030, 1, 1), "New Year", None)]
    assert len(listed_rows(spark.range(6_001))) == 6_001


def test_conflicts_in_a_batch_follow_the_load_order(spark, tmp_path):
    rows = [("A", 2, "second"), ("A", 1, "zz first"), ("B", 3, "only")]
    batch = spark.createDataFrame(rows, "txn_id string, load_no int, purpose string")
    out = sinks.append_ignore_conflict(batch, str(tmp_path / "t"), ["txn_id"], order="load_no")
    assert sorted(map(tuple, out.collect())) == [("A", "zz first"), ("B", "only")]

    def people(*rows):
        return spark.createDataFrame(
            rows, "customer_id string, load_no int, customer_name string, risk_tier string, kyc_last_update_date string, segment string"
        )

    current = people(("K", 0, "old", "LOW", "d0", "kept")).drop("load_no")
    incoming = people(
        ("K", 1, "b", "LOW", "d1", "x"), ("K", 2, "a", "HIGH", "d2", "y"), ("N", 2, "a", "LOW", "d2", "later"), ("N", 1, "b", "HIGH", "d1", "first")
    )
    merged = sorted(map(tuple, sinks.merge_customers(current, incoming, order="load_no").collect()))
    assert merged == [("K", "a", "HIGH", "d2", "kept"), ("N", "a", "LOW", "d2", "first")]


def test_append_new_only_stores_one_row_of_a_repeated_key(spark, tmp_path):
    new = spark.createDataFrame([("A", 1), ("A", 1), ("B", 2)], "id string, n int")
    path = str(tmp_path / "new")
    assert sinks.append_new_only(new, path, ["id"]).count() == 2
    assert sinks.append_new_only(new, path, ["id"]).count() == 2


def test_every_hot_group_is_split(spark):
    groups = spark.range(1_500).selectExpr("id as k", "3000000 as n")
    hot = hot_groups(groups, ["k"], "n")
    assert hot.count() == 1_500 and {r["_parts"] for r in hot.collect()} == {2}
    rows = spark.range(4_500).selectExpr("id % 1500 as k", "id as row")
    joined = join_groups(rows, groups.select("k", "n"), ["k"], F.col("row"), hot)
    assert joined.count() == 4_500


def test_daily_run_builds_all_tables_and_reruns(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for name in ("raw_transactions", "raw_customers", "raw_kyc_documents", "raw_watchlist_screening"):
        getattr(star, name)(spark, SF_DIR).write.parquet(f"{raw}/{name}")
    tables = run_daily(spark, raw, out, PARAMS)
    assert {name: df.count() for name, df in tables.items()} == {
        "stg_transactions": 1500,
        "stg_customers": 150,
        "stg_kyc_documents": 588,
        "stg_watchlist": 149,
        "customer_day": tables["customer_day"].count(),
        "int_ctr_candidates": 382,
        "int_structuring_detection": 121,
        "int_layering_detection": 150,
        "int_kyc_health": 150,
        "int_customer_risk_rating": 150,
        "int_str_candidates": 576,
        "dim_branches": 36,
        "dim_date": 1826,
        "dim_customers": 150,
        "fct_covered_transactions": 382,
        "fct_suspicious_transactions": 576,
        "fct_customer_compliance": 150,
        "fct_branch_compliance_summary": 36,
        "dq_report": 40,
    }
    report = {(r.table_name, r.column_name, r.test_name): r.failures for r in tables["dq_report"].collect()}
    assert report["raw_watchlist_screening", "customer_id", "foreign_key"] == 1
    assert report["raw_transactions", "txn_type", "accepted_values"] == 1
    assert {r.customer_name for r in spark.table("vw_dim_customers_masked").collect()} == {
        r.customer_name for r in tables["dim_customers"].collect()
    }
    from amihan.catalog.lake import Lake

    lake = Lake(spark, SF_DIR)
    for name, df in (
        ("int_structuring_detection", lake.structuring),
        ("int_layering_detection", lake.layering),
        ("int_str_candidates", lake.candidates),
        ("fct_branch_compliance_summary", lake.branch_summary),
    ):
        assert df.exceptAll(tables[name].select(*df.columns)).count() == 0
    next_day = replace(PARAMS, as_of=date(2026, 7, 1), run_ts=datetime(2026, 7, 1, 2, tzinfo=timezone.utc))
    again = run_daily(spark, raw, out, next_day)
    assert again["int_str_candidates"].count() == 576
    assert again["fct_suspicious_transactions"].select(F.max("days_to_deadline")).first()[0] == 6
