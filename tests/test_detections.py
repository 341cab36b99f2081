from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F
from rows import PARAMS, by, customers, txns

from amihan.operators.candidates import int_str_candidates
from amihan.operators.ctr import int_ctr_candidates
from amihan.operators.customer_day import KEYS, customer_day
from amihan.operators.layering import int_layering_detection
from amihan.operators.signals import signal_pep
from amihan.operators.skew import hot_groups
from amihan.operators.structuring import int_structuring_detection
from amihan.sources.seeds import load_seeds

DAY0 = date(2026, 6, 1)


def day(n):
    return DAY0 + timedelta(days=n)


def test_ctr_edges(spark):
    out = int_ctr_candidates(
        txns(
            spark,
            {"txn_id": "A1", "customer_id": "A", "amount_php": 500000},
            {"txn_id": "B2", "customer_id": "B", "amount_php": 250000},
            {"txn_id": "B1", "customer_id": "B", "amount_php": 250000, "transaction_direction": "CREDIT"},
            {"txn_id": "C1", "customer_id": "C", "amount_php": 499999.99},
            {"txn_id": "F1", "customer_id": "F", "amount_php": 560000, "txn_type": "RTGS", "currency_code": "USD"},
            {"txn_id": "F2", "customer_id": "F", "amount_php": 559999.99, "txn_type": "RTGS", "currency_code": "USD"},
            {"txn_id": "F3", "customer_id": "F", "amount_php": 900000, "txn_type": "RTGS"},
            {"txn_id": "F4", "customer_id": "F", "amount_php": 900000, "txn_type": "RTGS", "currency_code": None},
        ),
        PARAMS,
    ).collect()
    assert sorted((r.txn_id, r.ctr_type, r.ctr_amount_php) for r in out) == [
        ("A1", "RELATED_CASH", 500000),
        ("A1", "SINGLE_CASH", 500000),
        ("B1", "RELATED_CASH", 500000),
        ("F1", "FOREX_EQUIVALENT", 560000),
    ]
    assert len({r.ctr_candidate_id for r in out}) == 4


def test_structuring_window_is_eight_dates(spark):
    rows = [
        {"txn_id": "d0", "txn_date_ph": day(0), "amount_php": 200000},
        {"txn_id": "d7a", "txn_date_ph": day(7), "amount_php": 125000},
        {"txn_id": "d7b", "txn_date_ph": day(7), "amount_php": 125000},
        {"txn_id": "d8", "txn_date_ph": day(8), "amount_php": 490000},
        {"txn_id": "in", "txn_date_ph": day(7), "amount_php": 400000, "transaction_direction": "CREDIT"},
        {"txn_id": "wire", "txn_date_ph": day(7), "amount_php": 400000, "txn_type": "RTGS"},
    ]
    out = by(int_structuring_detection(txns(spark, *rows), PARAMS), "txn_id")
    assert {k: (r.txn_count_7d, r.txn_sum_7d, r.observation_window_start_date) for k, r in out.items()} == {
        "d7a": (3, 450000, day(0)),
        "d7b": (3, 450000, day(0)),
        "d8": (3, 740000, day(7)),
    }
    assert out["d7a"].is_structuring_pattern and out["d7a"].threshold_evasion_pct == -10
    assert not out["d8"].is_structuring_pattern and out["d8"].str_indicator_code is None
    assert out["d7a"].structuring_event_id == out["d7b"].structuring_event_id


def test_layering_never_fires_as_specified_but_does_with_signed_net(spark):
    rows = [
        {"txn_id": "in", "txn_date_ph": day(0), "transaction_direction": "CREDIT", "amount_php": 100000},
        {"txn_id": "out", "txn_date_ph": day(2), "amount_php": 95000},
        {"txn_id": "late", "txn_date_ph": day(3), "amount_php": 1000},
    ]
    table = txns(spark, *rows)
    assert int_layering_detection(table, PARAMS).filter("is_layering_pattern").count() == 0
    out = by(int_layering_detection(table, PARAMS, signed_net=True).filter("is_layering_pattern"), "txn_id")
    assert set(out) == {"out"}
    assert out["out"].net_amount_48h == 5000 and out["out"].net_position_pct == Decimal("2.56")


def test_layering_exactly_at_the_limit_does_not_fire(spark):
    rows = [
        {"txn_id": "in", "transaction_direction": "CREDIT", "amount_php": 110000},
        {"txn_id": "out", "amount_php": 90000},
    ]
    assert int_layering_detection(txns(spark, *rows), PARAMS, signed_net=True).filter("is_layering_pattern").count() == 0


def test_velocity_average_is_weighted_by_row(spark):
    """Counts 1, 1, 4: the average over rows is 18/6 = 3, over days it would be 2."""
    rows = [
        {"txn_id": "a", "txn_date_ph": day(0), "transaction_direction": "CREDIT"},
        {"txn_id": "b", "txn_date_ph": day(10)},
        *[{"txn_id": f"c{i}", "txn_date_ph": day(20)} for i in range(3)],
        {"txn_id": "c3", "txn_date_ph": day(20), "transaction_direction": "CREDIT"},
    ]
    table = txns(spark, *rows)
    assert int_layering_detection(table, PARAMS).count() == 0  # 4 is not above 2 * 3
    more = txns(spark, *rows, {"txn_id": "d", "txn_date_ph": day(21)}, {"txn_id": "e", "txn_date_ph": day(22)})
    out = by(int_layering_detection(more, PARAMS), "txn_id")
    assert set(out) == {"e"}  # 6 rows in the window, average 20/8 = 2.5
    assert out["e"].txn_count_48h == 6 and out["e"].avg_daily_velocity_90d == Decimal("2.50")


def test_salted_hot_days_give_the_same_rows(spark):
    """One customer-day with a third of all rows, split into many parts."""
    rows = [{"txn_id": f"h{i:03d}", "customer_id": "HOT", "amount_php": 5000 + i} for i in range(100)]
    rows += [
        {
            "txn_id": f"r{i:03d}",
            "customer_id": f"C{i % 7}",
            "txn_date_ph": day(i % 10),
            "amount_php": 60000,
            "transaction_direction": "CREDIT" if i % 3 else "DEBIT",
        }
        for i in range(200)
    ]
    table = txns(spark, *rows)
    days = customer_day(table)
    hot = hot_groups(days, KEYS, "day_count", rows_per_split=10)
    assert by(hot, "customer_id")["HOT"]._parts == 10
    for job in (int_structuring_detection, int_layering_detection):
        plain = job(table, PARAMS)
        salted = job(table, PARAMS, days, hot)
        assert plain.count() == salted.count() > 0
        assert plain.exceptAll(salted).count() == 0


def test_skewed_joins_are_split_at_run_time(spark):
    """Without stored days AQE splits the partition of a hot customer or day."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16KB",
    }
    is_hot = F.col("id") % 3 == 0
    spread = spark.range(0, 40000, 1, 8).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("txn_id"),
        F.when(is_hot, "HOT").otherwise(F.concat(F.lit("C"), F.col("id") % 5000)).alias("customer_id"),
        F.when(is_hot, F.lit(day(3)))
        .otherwise(F.date_add(F.lit(DAY0), (F.col("id") % 7).cast("int")))
        .alias("txn_date_ph"),
        F.lit("MKT001").alias("branch_code"),
        F.lit("CASH").alias("txn_type"),
        F.lit("DEBIT").alias("transaction_direction"),
        F.lit(60000).cast("decimal(19,2)").alias("amount_php"),
        F.lit(None).cast("string").alias("counterparty_bank"),
        F.lit(None).cast("string").alias("purpose_description"),
    )
    people = customers(spark, {"customer_id": "HOT", "is_pep": True})
    jobs = {
        "structuring": lambda: int_structuring_detection(spread, PARAMS),
        "candidates": lambda: int_str_candidates(spread, people, load_seeds(spark), PARAMS),
        "pep": lambda: signal_pep(spread, people, PARAMS),
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for name, job in jobs.items():
            df = job()
            assert len(df.collect()) >= 13334, name
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
