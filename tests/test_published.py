"""Published tables, the landing and monthly runs, seed files, and the joins with lists and calendars."""

import glob
import os
import random
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F
from rows import PARAMS, raw_customers, raw_documents, raw_screening, raw_txns

from amihan.catalog.lake import Lake
from amihan.functions.calendar import working_day_deadline
from amihan.functions.keys import with_dense_key
from amihan.functions.ordinals import span, with_working_day, working_day_calendar
from amihan.operators import quality as dq
from amihan.operators import signals
from amihan.operators.customer_day import customer_day
from amihan.operators.extensions import signal_flagged_customers, signal_smurfing
from amihan.operators.listed import containing
from amihan.operators.running import with_running_totals
from amihan.operators.skew import hot_groups
from amihan.plans.dimensions import create_masked_view, set_viewer_role
from amihan.plans.landing import run_landing
from amihan.plans.monthly import run_monthly
from amihan.plans.optional import run_optional
from amihan.sources import published, sinks
from amihan.sources.raw import read_raw, scan
from amihan.sources.seeds import SEEDS, bad_seed_lines, load_seeds, read_seed, write_seed_files


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, part int, n int")


def files_of(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def failing(df):
    """The same rows, the last of which cannot be computed."""
    return df.withColumn("n", F.when(F.col("id") == "boom", F.raise_error(F.lit("killed")).cast("int")).otherwise(F.col("n")))


@pytest.mark.parametrize("write", [published.publish, published.append])
def test_a_killed_write_leaves_the_former_table(spark, tmp_path, write):
    path = str(tmp_path / "t")
    published.publish(table(spark, ("a", 1, 1), ("b", 2, 2)), path)
    with pytest.raises(PySparkException):
        write(failing(table(spark, ("c", 1, 3), ("boom", 1, 4))), path)
    # Data without a manifest row, as of a run that died just before it published.
    published._written(table(spark, ("d", 1, 5)), path, None, (), 0)
    assert rows_of(published.read(spark, path)) == [("a", 1, 1), ("b", 2, 2)]
    out = write(table(spark, ("c", 1, 3)), path)
    assert ("c", 1, 3) in rows_of(out) and published.current(spark, path).number == 2


def test_a_table_is_rebuilt_from_itself_and_restored(spark, tmp_path):
    path = str(tmp_path / "t")
    assert published.read(spark, path) is None
    first = sinks.overwrite_table(table(spark, ("a", 1, 1), ("b", 2, 2)), path)
    second = sinks.overwrite_table(first.withColumn("n", (F.col("n") * 10).cast("int")), path)
    assert rows_of(second) == [("a", 1, 10), ("b", 2, 20)] and rows_of(first) == [("a", 1, 1), ("b", 2, 2)]
    assert rows_of(published.read(spark, path, 1)) == rows_of(first)
    assert rows_of(published.restore(spark, path, 1)) == rows_of(first)
    with pytest.raises(ValueError):
        published.restore(spark, path, 9)


def test_empty_tables_and_empty_appends(spark, tmp_path):
    path = str(tmp_path / "t")
    out = published.publish(table(spark), path, partition_by="part")
    assert out.columns == ["id", "part", "n"] and rows_of(out) == []
    assert rows_of(published.append(table(spark, ("a", None, 1)), path, partition_by="part")) == [("a", None, 1)]
    assert rows_of(published.append(table(spark), path, partition_by="part")) == [("a", None, 1)]
    with pytest.raises(ValueError):
        published.append(table(spark), path)
    with pytest.raises(ValueError):
        published.publish(table(spark).withColumnRenamed("n", "publication"), path)


def test_replaced_partitions_leave_the_files_of_others(spark, tmp_path):
    path = str(tmp_path / "t")
    before = published.publish(table(spark, ("a", 1, 1), ("b", 2, 2), ("c", 3, 3)), path, partition_by="part")
    kept = files_of(before.where("part <> 2"))
    after = published.replace_partitions(table(spark, ("x", 2, 9), ("y", 4, 9)), path, "part")
    assert rows_of(after) == [("a", 1, 1), ("c", 3, 3), ("x", 2, 9), ("y", 4, 9)]
    assert kept <= files_of(after) and not files_of(before.where("part = 2")) & files_of(after)
    with pytest.raises(PySparkException):
        published.replace_partitions(failing(table(spark, ("z", 1, 9), ("boom", 1, 0))), path, "part")
    assert rows_of(published.read(spark, path)) == rows_of(after)


def test_unused_folders_are_removed(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(table(spark, ("a", 1, 1), ("b", 2, 2)), path, partition_by="part")
    published.replace_partitions(table(spark, ("c", 2, 3)), path, "part")
    published._written(table(spark, ("lost", 1, 5)), path, "part", (), 0)
    assert published.remove_unused(spark, path, keep=2) == 1
    assert published.remove_unused(spark, path, keep=1) == 1
    assert rows_of(published.read(spark, path)) == [("a", 1, 1), ("c", 2, 3)]
    assert len(glob.glob(f"{path}/publications/*/part=*")) == 2


def test_late_transactions_rewrite_their_years_only(spark, tmp_path):
    path, keys = str(tmp_path / "t"), ["txn_id", "txn_date_ph"]

    def batch(*days):
        return raw_txns(spark, *[{"txn_id": name, "txn_date_ph": date(year, 3, 1), "amount_php": n} for name, year, n in days])

    before = sinks.write_by_year(batch(("A", 2023, 1), ("B", 2024, 1), ("C", 2024, 1), ("D", 2025, 1)), path)
    after = sinks.merge_late(batch(("C", 2024, 5), ("E", 2024, 6), ("E", 2024, 6)), path, keys)
    assert sorted((r.txn_id, r.txn_year, int(r.amount_php)) for r in after.collect()) == [
        ("A", 2023, 1), ("B", 2024, 1), ("C", 2024, 5), ("D", 2025, 1), ("E", 2024, 6),
    ]
    same = files_of(before.where("txn_year <> 2024"))
    assert same == files_of(after.where("txn_year <> 2024"))


def test_years_are_written_in_few_files(spark, tmp_path):
    years = spark.range(0, 40_000, 1, 16).selectExpr(
        "cast(id as string) as txn_id", "date_add(date '2019-01-01', cast(id % 1000 as int)) as txn_date_ph"
    )
    out = sinks.write_by_year(years, str(tmp_path / "t"))
    assert out.count() == 40_000 and len(files_of(out)) <= 2 * out.select("txn_year").distinct().count()


def test_batches_are_written_once_with_their_rejects(spark, tmp_path):
    rows = raw_txns(
        spark,
        {"txn_id": "A"},
        {"txn_id": "B", "txn_type": "SWIFT"},
        {"txn_id": "C", "txn_channel": None},
        {"txn_id": "D", "txn_type": "X", "transaction_direction": "Y"},
    )
    split = dq.quarantine(rows, "raw_transactions", str(tmp_path / "q"))
    assert (split.n_accepted, split.n_rejected) == (1, 3)
    assert split.accepted.columns == rows.columns and {r.txn_id for r in split.accepted.collect()} == {"A"}
    assert {r.txn_id: r.reasons for r in split.rejected.collect()} == {
        "B": ["txn_type:accepted_values"],
        "C": ["txn_channel:not_null"],
        "D": ["txn_type:accepted_values", "transaction_direction:accepted_values"],
    }
    assert len(published.versions(spark, str(tmp_path / "q")).collect()) == 1
    none = dq.quarantine(raw_txns(spark), "raw_transactions", str(tmp_path / "none"))
    assert (none.n_accepted, none.n_rejected, none.accepted.count()) == (0, 0, 0)


def test_rows_without_parent_are_quarantined(spark, tmp_path):
    parents = raw_customers(spark, {"customer_id": "C1"}, {"customer_id": "C1"}, {"customer_id": None})
    documents = raw_documents(spark, {"document_id": "D1"}, {"document_id": "D2", "customer_id": "X"}, {"document_id": "D3", "customer_id": None})
    split = dq.quarantine(documents, "raw_kyc_documents", str(tmp_path / "d"), parents)
    assert {r.document_id: r.reasons for r in split.rejected.collect()} == {
        "D2": ["customer_id:foreign_key"],
        "D3": ["customer_id:not_null"],
    }
    assert split.n_accepted == 1
    found = dq.orphans(raw_screening(spark, {"customer_id": "X"}, {"customer_id": "X"}, {"customer_id": "C1"}), parents, "customer_id")
    assert found.count() == 2 and found.columns == raw_screening(spark, {}).columns


def test_seed_files_are_read_by_declared_types(spark, tmp_path):
    root = str(tmp_path / "seeds")
    write_seed_files(spark, root)
    assert bad_seed_lines(spark, root).count() == 0
    for name in SEEDS:
        assert rows_of(read_seed(spark, name, root).fillna("")) == rows_of(read_seed(spark, name).fillna("")), name
    assert load_seeds(spark, root).holidays and read_seed(spark, "aml_risk_weights").where("description is null").count() == 0


def test_bad_seed_lines_are_reported(spark, tmp_path):
    root = str(tmp_path / "seeds")
    write_seed_files(spark, root)
    os.rename(f"{root}/ph_non_working_days.csv", f"{root}/old")
    text = "calendar_date,holiday_name,holiday_type\n2030-01-01,New Year,REGULAR_HOLIDAY\nsoon,Some Day,X\n2030-02-01,Too,Many,Columns\n2030-05-01,Short\n"
    (tmp_path / "seeds" / "ph_non_working_days.csv").write_text(text)
    good = read_seed(spark, "ph_non_working_days", root)
    assert [str(r.calendar_date) for r in good.collect()] == ["2030-01-01"] and good.select("holiday_name").count() == 1
    bad = {r.line for r in bad_seed_lines(spark, root).collect()}
    assert bad == {"soon,Some Day,X", "2030-02-01,Too,Many,Columns", "2030-05-01,Short"}


def test_landing_run_checks_merges_and_repeats(spark, tmp_path):
    root = str(tmp_path / "landing")
    people = raw_customers(spark, {"customer_id": "C1", "branch_code": "A"}, {"customer_id": "C2", "risk_tier": "ODD"})
    batches = {
        "raw_customers": people,
        "raw_kyc_documents": raw_documents(spark, {"document_id": "D1"}, {"document_id": "D1"}, {"document_id": "D2", "customer_id": "C2"}),
        "raw_transactions": raw_txns(spark, {"txn_id": "T1"}, {"txn_id": "T1"}, {"txn_id": "T2", "txn_channel": "FAX"}),
    }
    for _ in range(2):
        done = run_landing(spark, batches, root, "day-1")
        assert {n: df.count() for n, df in done.tables.items()} == {"raw_customers": 1, "raw_kyc_documents": 1, "raw_transactions": 1}
        assert {n: (s.n_accepted, s.n_rejected) for n, s in done.splits.items()} == {
            "raw_customers": (1, 1),
            "raw_kyc_documents": (2, 1),
            "raw_transactions": (2, 1),
        }
    more = {"raw_customers": raw_customers(spark, {"customer_id": "C1", "branch_code": "B", "risk_tier": "HIGH"}, {"customer_id": "C2"})}
    more["raw_watchlist_screening"] = raw_screening(spark, {"screening_id": "S1", "customer_id": "C2", "watchlist_source": "AMLC"})
    done = run_landing(spark, more, root, "day-2")
    found = {r.customer_id: (r.branch_code, r.risk_tier) for r in done.tables["raw_customers"].collect()}
    assert found == {"C1": ("A", "HIGH"), "C2": ("MKT001", "LOW")}
    assert done.tables["raw_watchlist_screening"].count() == 1 and done.tables["raw_transactions"].count() == 1
    assert scan(read_raw(spark, root, "raw_transactions"), "raw_transactions").count() == 1
    with pytest.raises(ValueError):
        run_landing(spark, {"odd": people}, root, "day-3")


def test_monthly_run_writes_reports_and_summary(spark, tmp_path):
    lake = Lake(spark, "/root/testdata/sf0.001")
    marts, out = str(tmp_path / "marts"), str(tmp_path / "reports")
    with pytest.raises(ValueError):
        run_monthly(spark, marts, out, 2026, 6)
    sinks.overwrite_table(lake.covered, f"{marts}/gold/fct_covered_transactions")
    sinks.overwrite_table(lake.suspicious, f"{marts}/gold/fct_suspicious_transactions")
    summary = {r.report: r for r in run_monthly(spark, marts, out, 2026, 6).collect()}
    assert summary["ctr"].row_count == lake.covered.count() and summary["str"].row_count == lake.suspicious.count()
    assert summary["str"].path == f"{out}/2026/06/str_report_202606.csv" and os.path.isdir(summary["str"].path)
    assert [r.row_count for r in run_monthly(spark, marts, out, 2026, 7).collect()] == [0, 0]
    assert published.read(spark, f"{out}/2026/06/summary").count() == 2


def test_masked_view_asks_for_the_role_when_queried(spark):
    people = spark.createDataFrame(
        [("C1", "Maria Cruz", "0123456789", None), ("C2", None, "12", "9876543210")],
        "customer_id string, customer_name string, sss_number string, tin_number string",
    )
    create_masked_view(people, PARAMS, "people_seen")
    read = lambda: {r.customer_id: tuple(r)[1:] for r in spark.sql("select * from people_seen").collect()}
    plain = {"C1": ("Maria Cruz", "0123456789", None), "C2": (None, "12", "9876543210")}
    assert read() == plain
    set_viewer_role(spark, PARAMS.masked_role)
    assert read() == {"C1": ("M***z", "***6789", None), "C2": (None, "***12", "***3210")}
    set_viewer_role(spark, "analyst' or 'x")
    assert read() == plain


def test_list_join_equals_brute_force(spark):
    pick = random.Random(3)
    letters = "ABCÑ %_"
    word = lambda low, high: "".join(pick.choice(letters) for _ in range(pick.randint(low, high)))
    rows = [(i, pick.choice([None, "", word(0, 12), "HOT TEXT ABC"]), word(0, 9)) for i in range(300)]
    entries = [(word(0, 3) or None, word(2, 6)) for _ in range(60)] + [("ABC", "ABC"), ("ABC", "ABC"), (None, None), ("A", "")]
    expected = {
        (i, a, b) for i, x, y in rows for a, b in entries if (a and x is not None and a in x) or (b and y is not None and b in y)
    }
    df = spark.createDataFrame(rows, "id int, x string, y string")
    listed = spark.createDataFrame(entries, "a string, b string")
    out = [tuple(r) for r in containing(df, ["id"], {"x": F.col("x"), "y": F.col("y")}, listed, {"x": "a", "y": "b"}).collect()]
    assert len(out) == len(set(out)) and set(out) == expected and len(expected) > 200


def test_long_lists_are_one_join(spark):
    listed = spark.range(100_000).select(F.format_string("BANK%06d", "id").alias("name"))
    rows = spark.range(2_000).select("id", F.concat(F.lit("VIA "), F.format_string("BANK%06d", F.col("id") * 77), F.lit(" CO")).alias("text"))
    out = containing(rows, ["id"], {"t": F.col("text")}, listed, {"t": "name"})
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 20_000 and "Cross" not in plan
    found = out.collect()
    assert len(found) == sum(1 for i in range(2_000) if i * 77 < 100_000)
    assert all(r.name == f"BANK{r.id * 77:06d}" for r in found)


def test_working_days_by_number_equal_the_search(spark):
    holidays = load_seeds(spark).holidays
    days = spark.range(900).select(F.date_add(F.lit(date(2024, 6, 1)), F.col("id").cast("int")).alias("d"))
    days = days.unionByName(spark.createDataFrame([(None,)], "d date"))
    closed = spark.createDataFrame([(h,) for h in holidays] + [(None,), (holidays[0],)], "calendar_date date")
    first, last = span(days, "d", 5, 3)
    calendar = working_day_calendar(spark, first, last, closed)
    for n, buffer in ((1, 3), (5, 3), (1, 2), (5, 2), (5, 1)):
        found = with_working_day(days, "d", "due", n, calendar, buffer)
        expected = days.withColumn("due", working_day_deadline(F.col("d"), n, holidays, buffer))
        assert rows_of(found.fillna("x").na.drop()) == rows_of(expected.na.drop())
        assert found.count() == days.count() and found.where("due is null").count() == expected.where("due is null").count()
    assert span(days.limit(0), "d", 1, 3) is None


def test_dense_keys_sort_only_keys(spark):
    df = spark.range(500).select(F.format_string("K%04d", F.lit(499) - F.col("id")).alias("k"), F.repeat(F.lit("x"), 50).alias("wide"))
    out = with_dense_key(df, "k", "sk")
    assert out.columns == ["sk", "k", "wide"]
    assert [(r.sk, r.k) for r in out.orderBy("sk").collect()] == [(i + 1, f"K{i:04d}") for i in range(500)]


def test_running_totals_equal_a_window(spark):
    rows = spark.range(3_000).select(
        F.format_string("T%05d", F.pmod(F.col("id") * 7919, F.lit(3_000))).alias("id"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("C"), F.col("id") % 40)).alias("c"),
        (F.col("id") % 2).alias("d"),
        F.when(F.col("id") % 11 > 0, F.col("id").cast("decimal(10,2)")).alias("amount"),
    )
    out = with_running_totals(rows, ["c", "d"], "id", {"total": F.col("amount"), "place": F.lit(1)})
    window = Window.partitionBy("c", "d").orderBy("id")
    expected = rows.withColumn("total", F.coalesce(F.sum("amount").over(window), F.lit(0))).withColumn("place", F.row_number().over(window))
    show = lambda df: sorted((r.id, r.c or "", r.d, float(r.total), r.place) for r in df.collect())
    assert show(out) == show(expected)
    assert with_running_totals(rows.limit(0), ["c", "d"], "id", {"total": F.col("amount")}).count() == 0


def test_optional_run_follows_the_published_tables(spark, tmp_path):
    lake, out = Lake(spark, "/root/testdata/sf0.001"), str(tmp_path)
    with pytest.raises(ValueError):
        run_optional(spark, out, PARAMS)
    for name, df in lake.bronze.items():
        sinks.overwrite_table(df, f"{out}/bronze/{name}")
    sinks.overwrite_table(customer_day(lake.transactions), f"{out}/silver/customer_day")
    sinks.overwrite_table(lake.dim_customers, f"{out}/gold/dim_customers")
    first = run_optional(spark, out, PARAMS)
    counts = {name: df.count() for name, df in first.items()}
    smurfing = signal_smurfing(lake.transactions, PARAMS, lake.seeds.holidays)
    assert first["signals"].where("indicator_code = 'PATTERN_01'").count() == smurfing.count() and counts["signals"] > 0
    assert counts["customer_history"] == 150 and counts["retained_transactions"] == 1500
    again = run_optional(spark, out, PARAMS)
    assert rows_of(again["customer_history"].select("customer_id", "risk_tier", "is_current")) == rows_of(
        first["customer_history"].select("customer_id", "risk_tier", "is_current")
    )
    assert published.current(spark, f"{out}/optional/customer_history").number == 2
    assert published.read(spark, f"{out}/optional/signals").count() == counts["signals"]


def test_salted_customers_give_the_same_signals(spark):
    lake = Lake(spark, "/root/testdata/sf0.001")
    sizes = lake.transactions.groupBy("customer_id").agg(F.count("*").alias("n"))
    hot = hot_groups(sizes, ["customer_id"], "n", rows_per_split=4)
    assert hot.count() > 50
    flagged = lake.customers.where("is_pep").select("customer_id")
    for build in (
        lambda h: signals.signal_fatf(lake.transactions, lake.customers, lake.seeds.jurisdictions, PARAMS, hot=h),
        lambda h: signals.signal_pep(lake.transactions, lake.customers, PARAMS, hot=h),
        lambda h: signal_flagged_customers(lake.transactions, flagged.unionByName(flagged), "X", 1, hot=h),
    ):
        plain, salted = build(None), build(hot)
        assert plain.columns == salted.columns
        show = lambda df: sorted(map(repr, df.collect()))
        assert show(plain) == show(salted) and plain.count() > 0
