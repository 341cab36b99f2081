"""Scans, seeds, sinks, reports and monitors."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.catalog.check_sql import RUN_EPOCH
from amihan.catalog.registry import query
from amihan.functions.calendar import loaded_at, loaded_at_manila
from amihan.operators import bronze
from amihan.operators.candidates import int_str_candidates
from amihan.operators.signals import jurisdiction_hit
from amihan.plans import reports
from amihan.session import run_folder
from amihan.sources import raw, sinks, star
from amihan.sources.seeds import load_seeds, write_seed_files

# Scans --------------------------------------------------------------------------
query(
    "scan_transactions",
    "txn_id customer_id branch_code txn_date_ph:d txn_time_ph txn_type txn_channel transaction_direction amount_local:n "
    "currency_code amount_php:n counterparty_name counterparty_account counterparty_bank purpose_code "
    "purpose_description reference_number source_system batch_id created_at:d updated_at:d",
    "select *, null as created_at, null as updated_at from raw_txn",
)(lambda x: raw.scan(x.raw_transactions, "raw_transactions"))
query(
    "scan_customers",
    "customer_id customer_name customer_type sss_number tin_number philhealth_id date_of_birth:d nationality is_pep "
    "pep_determination_date:d risk_tier account_status account_opened_date:d branch_code customer_segment kyc_status "
    "kyc_last_update_date:d created_at:d updated_at:d",
    "select *, null as created_at, null as updated_at from raw_cust",
)(lambda x: raw.scan(x.raw_customers, "raw_customers"))
query(
    "scan_kyc_documents",
    "document_id customer_id document_type document_number issue_date:d expiry_date:d issuing_country "
    "issuing_authority created_at:d updated_at:d",
    "select *, null as created_at, null as updated_at from raw_docs",
)(lambda x: raw.scan(x.raw_kyc_documents, "raw_kyc_documents"))
query(
    "scan_watchlist",
    "screening_id customer_id screening_date:d watchlist_source match_status matched_name match_score:n "
    "match_confidence_pct:n notes created_at:d updated_at:d",
    "select *, null as created_at, null as updated_at from raw_screening",
)(lambda x: raw.scan(x.raw_watchlist_screening, "raw_watchlist_screening"))


@query(
    "seed_csv_scan",
    "seed entry description rows_using_it:i",
    """
select 'ph_branches' as seed, branch_code as entry, branch_name as description, count(txn_id) as rows_using_it
from seed_branches left join txn using (branch_code) group by all
union all select 'ph_non_working_days', cast(calendar_date as varchar), holiday_name, count(txn_id)
from seed_holidays left join txn_history on calendar_date = txn_date_ph group by all
union all select 'aml_risk_weights', risk_category || '/' || risk_subcategory, description, count(customer_id)
from seed_weights left join cust on is_pep and risk_subcategory = 'PEP_CUSTOMER' group by all
union all select 'fatf_jurisdictions', iso2_code, country_name, count(txn_id) from seed_fatf left join txn
  on contains(upper(counterparty_bank), iso2_code) or contains(upper(purpose_description), country_name) group by all
union all select 'str_indicators_ref', indicator_code, description, count(str_candidate_id)
from seed_indicators left join candidates on list_contains(str_indicators, indicator_code) group by all
""",
)
def _seed_csv_scan(x):
    """Every entry of the five seeds, read from CSV files, with the rows that refer to it."""
    root = run_folder(x.spark, "seeds")
    write_seed_files(x.spark, root)
    s = load_seeds(x.spark, root)

    def used(seed: str, entries: DataFrame, uses: DataFrame) -> DataFrame:
        counts = uses.toDF("entry").groupBy("entry").agg(F.count("*").alias("_n"))
        return entries.toDF("entry", "description").join(counts, "entry", "left").select(
            F.lit(seed).alias("seed"), "entry", "description", F.coalesce("_n", F.lit(0)).alias("rows_using_it")
        )

    named = F.array_compact(F.array(*[F.when(jurisdiction_hit(j), j.iso2_code) for j in s.jurisdictions]))
    weight_key = F.concat_ws("/", "risk_category", "risk_subcategory")
    parts = [
        used("ph_branches", s.branches.select("branch_code", "branch_name"), x.transactions.select("branch_code")),
        used(
            "ph_non_working_days",
            s.non_working_days.select(F.col("calendar_date").cast("string"), "holiday_name"),
            x.history.select(F.col("txn_date_ph").cast("string")),
        ),
        used(
            "aml_risk_weights",
            s.weights.select(weight_key, "description"),
            x.customers.filter("is_pep").select(F.lit("PEP/PEP_CUSTOMER")),
        ),
        used("fatf_jurisdictions", s.fatf.select("iso2_code", "country_name"), x.transactions.select(F.explode(named))),
        used(
            "str_indicators_ref",
            s.indicators.select("indicator_code", "description"),
            x.candidates.select(F.explode("str_indicators")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


# Sinks --------------------------------------------------------------------------


@query("sink_table_overwrite", "ctr_candidate_id txn_id ctr_type amount_php:n", "select * from ctr")
def _sink_table_overwrite(x):
    """Two writes to one table: the second replaces the first."""
    path = run_folder(x.spark, "ctr")
    sinks.overwrite_table(x.ctr.filter("ctr_type = 'SINGLE_CASH'"), path)
    return sinks.overwrite_table(x.ctr, path, ["customer_id", "txn_date_ph"])


@query(
    "sink_incremental_new_only",
    "str_candidate_id txn_id str_indicators:a indicator_count:i str_determination_ts:t",
    """
select * replace (case when txn_date_ph <= date '2026-06-15' then timestamp '2026-06-16 10:00:00'
    else str_determination_ts end as str_determination_ts) from candidates
""",
)
def _sink_incremental_new_only(x):
    """Two runs: transactions until mid-month, then all; first sight keeps its time."""
    path = run_folder(x.spark, "candidates")
    first = x.params_at(run_ts=datetime(2026, 6, 16, 2, 0, tzinfo=timezone.utc))
    early = x.transactions.filter(F.col("txn_date_ph") <= F.lit(date(2026, 6, 15)))
    sinks.append_new_only(int_str_candidates(early, x.customers, x.seeds, first), path, ["str_candidate_id"])
    return sinks.append_new_only(x.candidates, path, ["str_candidate_id"])


@query(
    "sink_append_ignore_conflict",
    "txn_id txn_date_ph:d amount_php:n",
    """
select txn_id, txn_date_ph, if(txn_date_ph <= date '2026-06-20', amount_php, 2 * amount_php) as amount_php from raw_txn
""",
)
def _sink_append_ignore_conflict(x):
    """A second batch overlaps the first, repeats itself and carries other amounts."""
    path = run_folder(x.spark, "landing")
    keys = ["txn_id", "txn_date_ph"]
    table = x.raw_transactions
    sinks.append_ignore_conflict(table.filter("txn_date_ph <= date '2026-06-20'"), path, keys, by_year=True)
    again = table.withColumn("amount_php", (F.col("amount_php") * 2).cast("decimal(15,2)"))
    return sinks.append_ignore_conflict(again.unionByName(again), path, keys, by_year=True)


@query(
    "sink_upsert_customers",
    "customer_id customer_name risk_tier kyc_last_update_date:d account_status branch_code",
    """
select customer_id, if(is_pep, upper(customer_name), customer_name) as customer_name,
  if(is_pep, 'LOW', risk_tier) as risk_tier, if(is_pep, date '2026-06-29', kyc_last_update_date) as kyc_last_update_date,
  account_status, branch_code from raw_cust
union all select 'SUPP' || lpad(cast(s_suppkey as varchar), 12, '0'), s_name, 'MEDIUM', date '2026-06-29', 'ACTIVE', 'MKT003'
from supplier
""",
)
def _sink_upsert_customers(x):
    """Incoming: all PEP customers with changes, and the suppliers as new customers."""
    current = sinks.overwrite_table(x.raw_customers, run_folder(x.spark, "customers"))
    changed = x.raw_customers.filter("is_pep").withColumns(
        {
            "customer_name": F.upper("customer_name"),
            "risk_tier": F.lit("LOW"),
            "account_status": F.lit("CLOSED"),
            "branch_code": F.lit("MKT003"),
        }
    )
    new = {
        "customer_id": F.concat(F.lit("SUPP"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0")),
        "customer_name": F.col("s_name"),
        "risk_tier": F.lit("MEDIUM"),
        "account_status": F.lit("ACTIVE"),
        "branch_code": F.lit("MKT003"),
    }
    types = {f.name: f.dataType for f in x.raw_customers.schema}
    suppliers = x.spark.read.parquet(f"{x.sf_dir}/supplier.parquet").select(
        *[new.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()]
    )
    incoming = changed.unionByName(suppliers).withColumn("kyc_last_update_date", F.lit(date(2026, 6, 29)))
    return sinks.overwrite_table(sinks.merge_customers(current, incoming), run_folder(x.spark, "customers"))


@query(
    "partition_by_year",
    "txn_id txn_date_ph:d txn_year:i amount_php:n",
    "select *, year(txn_date_ph) as txn_year from txn_history "
    "where txn_date_ph between date '1996-06-01' and date '1998-03-31'",
)
def _partition_by_year(x):
    path = run_folder(x.spark, "by-year")
    sinks.write_by_year(x.history, path)
    return raw.read_transactions_between(x.spark, path, date(1996, 6, 1), date(1998, 3, 31))


@query(
    "partition_late_batch",
    "txn_id txn_date_ph:d txn_year:i amount_php:n rewritten",
    """
select txn_id, txn_date_ph, year(txn_date_ph) as txn_year, if(year(txn_date_ph) = 1997 and txn_type = 'CASH', 2, 1) * amount_php
  as amount_php, year(txn_date_ph) = 1997 as rewritten from txn_history
""",
)
def _partition_late_batch(x):
    """Corrections of one year arrive late: that year is rewritten, all others keep their files."""
    path = run_folder(x.spark, "by-year")
    files = lambda t: t.withColumn("_file", F.input_file_name())
    before = files(sinks.write_by_year(x.history, path)).select("_file").distinct()
    doubled = (F.col("amount_php") * 2).cast(x.history.schema["amount_php"].dataType)
    late = x.history.where("year(txn_date_ph) = 1997 and txn_type = 'CASH'").withColumn("amount_php", doubled)
    after = files(sinks.merge_late(late, path, ["txn_id", "txn_date_ph"]))
    return after.join(before.withColumn("_old", F.lit(True)), "_file", "left").withColumn("rewritten", F.col("_old").isNull())


# Reports and monitors -------------------------------------------------------------
CTR_SQL = """
select ctr_id, customer_id, branch_code as branch, cast(txn_date_ph as varchar) as txn_date, amount_php as amount, ctr_type,
  filing_status, cast(null as varchar) as filed from covered where txn_date_ph between date '2026-06-01' and date '2026-06-30'
"""
STR_SQL = """
select str_id, customer_id, branch_code as branch, strftime(str_determination_ts, '%Y-%m-%dT%H:%M:%S.000') as determined,
  max_risk_score as risk_score, indicator_count as indicators,
  filing_status, filing_urgency from suspicious
where str_determination_ts >= date '2026-06-01' and str_determination_ts < date '2026-07-01'
"""


def _written(x, report: DataFrame, kind: str) -> DataFrame:
    path = reports.report_path(run_folder(x.spark, "reports"), kind, 2026, 6)
    reports.write_csv_report(report, path)
    schema = ", ".join(f"`{f.name}` string" for f in report.schema)
    return x.spark.read.schema(schema).option("header", True).csv(path)


query(
    "report_ctr_monthly_csv",
    "ctr_id customer_id branch txn_date amount:n ctr_type filing_status filed",
    CTR_SQL,
)(
    lambda x: _written(x, reports.ctr_monthly(x.covered, 2026, 6), "ctr").toDF(
        "ctr_id", "customer_id", "branch", "txn_date", "amount", "ctr_type", "filing_status", "filed"
    )
)
query(
    "report_str_monthly_csv",
    "str_id customer_id branch determined risk_score:i indicators:i filing_status filing_urgency",
    STR_SQL,
)(
    lambda x: _written(x, reports.str_monthly(x.suspicious, 2026, 6), "str").toDF(
        "str_id", "customer_id", "branch", "determined", "risk_score", "indicators", "filing_status", "filing_urgency"
    )
)
query(
    "report_summary",
    "report_month report path row_count:i",
    f"""
select '202606' as report_month, 'ctr' as report, '/reports/2026/06/ctr_report_202606.csv' as path,
  (select count(*) from ({CTR_SQL})) as row_count
union all select '202606', 'str', '/reports/2026/06/str_report_202606.csv', (select count(*) from ({STR_SQL}))
""",
)(
    lambda x: reports.report_summary(
        reports.ctr_monthly(x.covered, 2026, 6), reports.str_monthly(x.suspicious, 2026, 6), "/reports", 2026, 6
    )
)
query(
    "monitor_ctr_daily",
    "day:d row_count:i",
    "select txn_date_ph as day, count(*) as row_count from covered group by 1",
)(lambda x: reports.rows_per_day(x.covered, "txn_date_ph"))
query(
    "monitor_str_daily",
    "day:d row_count:i",
    "select cast(str_determination_ts as date) as day, count(*) as row_count from suspicious group by 1",
)(lambda x: reports.rows_per_day(x.suspicious, "str_determination_ts"))
query(
    "project_audit_columns",
    "customer_id bronze_loaded_at:e gold_loaded_at:t",
    f"select customer_id, {RUN_EPOCH} as bronze_loaded_at, timestamp '2026-06-30 10:00:00' as gold_loaded_at from cust",
)(
    lambda x: bronze.stg_customers(star.raw_customers(x.spark, x.sf_dir), x.params).select(
        "customer_id",
        loaded_at(x.params).alias("bronze_loaded_at"),
        loaded_at_manila(x.params).alias("gold_loaded_at"),
    )
)
