"""Dimensions, facts, deadlines and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from amihan.catalog.check_sql import AS_OF
from amihan.catalog.registry import query
from amihan.functions.calendar import as_of, working_day_deadline, working_days_add
from amihan.functions.masking import mask_columns
from amihan.functions.ordinals import span, with_working_day, working_day_calendar
from amihan.functions.scoring import filing_urgency, tier_label
from amihan.plans import dimensions

# Small dimensions, shown with the transactions that refer to them.
DIM_BRANCH = "branch_sk:i branch_code branch_name region_name city_municipality province"


@query(
    "dim_branches",
    DIM_BRANCH + " txn_count:i",
    "select b.*, (select count(*) from txn where txn.branch_code = b.branch_code) as txn_count from dim_branch b",
)
def _dim_branches(x):
    used = x.transactions.groupBy("branch_code").agg(F.count("*").alias("_n"))
    joined = x.branches.join(used, "branch_code", "left")
    return joined.withColumn("txn_count", F.coalesce("_n", F.lit(0)))


DIM_DATE = (
    "date_id:i calendar_date:d calendar_year:i calendar_month:i calendar_quarter:i day_of_month:i day_of_week:i "
    "day_name is_ph_working_day is_current_week is_current_month is_current_year"
)


@query(
    "dim_date",
    DIM_DATE + " txn_count:i",
    "select d.*, coalesce(n, 0) as txn_count from dim_day d "
    "left join (select txn_date_ph, count(*) as n from txn group by 1) t on t.txn_date_ph = d.calendar_date",
)
def _dim_date(x):
    used = x.transactions.groupBy(F.col("txn_date_ph").alias("calendar_date")).agg(F.count("*").alias("_n"))
    return x.calendar.join(used, "calendar_date", "left").withColumn("txn_count", F.coalesce("_n", F.lit(0)))


DIM_CUSTOMER = (
    "customer_sk:i customer_id customer_name customer_type customer_segment sss_number tin_number date_of_birth:d "
    "nationality is_pep pep_determination_date:d risk_tier account_status account_opened_date:d branch_code "
    "overall_risk_score:i overall_risk_tier pep_risk_score:n customer_type_risk_score:i geography_risk_score:i "
    "kyc_health_risk_score:i account_status_risk_score:i watchlist_risk_score:i risk_factors:a valid_from:d valid_to:d "
    "is_current"
)
query("dim_customers", DIM_CUSTOMER, "select * from dim_cust")(lambda x: x.dim_customers)


def _unmasked_dimension(x):
    """The dimension with names and numbers as they were before it masked them."""
    plain = x.customers.select("customer_id", "customer_name", "sss_number", "tin_number")
    return x.dim_customers.drop("customer_name", "sss_number", "tin_number").join(plain, "customer_id")


query("vw_dim_customers_masked", DIM_CUSTOMER, "select * from dim_cust")(
    lambda x: dimensions.vw_dim_customers_masked(_unmasked_dimension(x), x.params.masked_role, x.params)
)


@query(
    "view_masked",
    "viewer customer_id customer_name sss_number tin_number overall_risk_tier is_current",
    """
select 'metabase_amlc_user' as viewer, customer_id, customer_name, sss_number, tin_number, overall_risk_tier, is_current from dim_cust
union all select 'analyst', c.customer_id, c.customer_name, c.sss_number, c.tin_number, d.overall_risk_tier, d.is_current
from cust c join dim_cust d on d.customer_id = c.customer_id
""",
)
def _view_masked(x):
    """One view, read by two roles."""
    dimensions.create_masked_view(_unmasked_dimension(x), x.params, "vw_dim_customers_masked")
    seen = []
    for role in (x.params.masked_role, "analyst"):
        dimensions.set_viewer_role(x.spark, role)
        seen.append(x.spark.table("vw_dim_customers_masked").withColumn("viewer", F.lit(role)))
    return seen[0].unionByName(seen[1])


query(
    "fn_role",
    "viewer customer_id customer_name sss_number tin_number",
    """
select 'metabase_amlc_user' as viewer, customer_id, customer_name[1] || '***' || customer_name[-1] as customer_name,
  '***' || right(sss_number, 4) as sss_number, '***' || right(tin_number, 4) as tin_number from cust
union all select 'analyst', customer_id, customer_name, sss_number, tin_number from cust
""",
)(
    lambda x: dimensions.vw_dim_customers_masked(x.customers, x.params.masked_role, x.params)
    .select(F.lit(x.params.masked_role).alias("viewer"), "customer_id", "customer_name", "sss_number", "tin_number")
    .unionByName(
        dimensions.vw_dim_customers_masked(x.customers, "analyst", x.params).select(
            F.lit("analyst").alias("viewer"), "customer_id", "customer_name", "sss_number", "tin_number"
        )
    )
)
query(
    "mask_customer_pii",
    "customer_id customer_name sss_number tin_number",
    "select * from dim_cust",
)(lambda x: dimensions.masked_customers(x.customers))
query(
    "mask_pii",
    "customer_id customer_name sss_number tin_number philhealth_id contact unknown_kind",
    """
select customer_id, customer_name[1] || '***' || right(customer_name, 2) as customer_name,
  '***' || right(sss_number, 4) as sss_number, '***' || right(tin_number, 4) as tin_number,
  '***' || right(philhealth_id, 4) as philhealth_id, lower(customer_id)[1] || '***@bank.example' as contact,
  cast(null as varchar) as unknown_kind
from cust
""",
)(
    lambda x: mask_columns(
        x.customers.withColumns(
            {
                "contact": F.concat(F.lower("customer_id"), F.lit("@bank.example")),
                "unknown_kind": F.col("customer_name"),
            }
        ),
        {
            "customer_name": "name",
            "sss_number": "account",
            "tin_number": "document",
            "philhealth_id": "phone",
            "contact": "email",
            "unknown_kind": "passport",
        },
    )
)

COVERED = (
    "ctr_id txn_id customer_id txn_date_id:i txn_date_ph:d branch_code amount_php:n transaction_direction ctr_type "
    "txn_channel filing_deadline:d filing_status filing_date:d amlc_ers_reference"
)
query("fct_covered_transactions", COVERED, "select * from covered")(lambda x: x.covered)
SUSPICIOUS = (
    "str_id txn_id customer_id branch_code txn_date_ph:d str_indicators:a indicator_count:i max_risk_score:i "
    "transaction_amount_php:n structuring_risk:i layering_risk:i jurisdiction_risk:i pep_risk:i str_determination_ts:t "
    "str_filing_deadline:d days_to_deadline:i filing_urgency filing_status filed_at:d amlc_ers_reference "
    "str_confidence_level signal_details"
)
query("fct_suspicious_transactions", SUSPICIOUS, "select * from suspicious")(lambda x: x.suspicious)
query(
    "fct_customer_compliance",
    "customer_id customer_type customer_segment branch_code nationality snapshot_date:d kyc_completeness_score:n "
    "kyc_freshness_flag kyc_exception days_since_kyc_update:i kyc_refresh_due_date:d has_primary_id:i "
    "has_address_verification:i has_valid_primary_id:i pep_screening_status earliest_expiry_date:d "
    "overall_risk_score:i risk_tier pep_risk_score:n customer_type_risk_score:i geography_risk_score:i "
    "kyc_health_risk_score:i account_status_risk_score:i watchlist_risk_score:i ctr_count_ytd:i str_count_ytd:i "
    "str_overdue_count_ytd:i is_pep account_status kyc_last_update_date:d",
    "select *, overall_risk_tier as risk_tier from compliance",
)(lambda x: x.compliance)
BRANCH_SUMMARY = (
    "branch_code branch_name region_name city_municipality province unique_customers:i high_risk_customers:i "
    "medium_risk_customers:i low_risk_customers:i pep_customers:i kyc_exceptions:i stale_kyc_customers:i "
    "avg_customer_risk_score:n ctr_count:i ctr_value_php:n ctr_inbound_count:i ctr_outbound_count:i "
    "ctr_max_amount_php:n ctr_avg_amount_php:n ctr_pending_count:i str_count:i overdue_strs:i due_soon_strs:i "
    "pending_strs:i avg_str_risk_score:n max_str_risk_score:i high_confidence_strs:i medium_confidence_strs:i "
    "branch_compliance_status"
)
query("fct_branch_compliance_summary", BRANCH_SUMMARY, "select * from branch_summary")(lambda x: x.branch_summary)

# Deadlines: on the transactions' own dates, which span years. --------------------


@query(
    "working_day_deadline",
    "txn_id txn_date_ph:d one_day:d five_days:d",
    "select t.txn_id, t.txn_date_ph, due1 as one_day, due5 as five_days "
    "from (from txn union all by name from txn_history) t join deadlines on d = t.txn_date_ph",
)
def _working_day_deadline(x):
    day, holidays = F.col("txn_date_ph"), x.seeds.holidays
    return x.transactions.unionByName(x.history).select(
        "txn_id",
        "txn_date_ph",
        working_day_deadline(day, 1, holidays).alias("one_day"),
        working_day_deadline(day, 5, holidays).alias("five_days"),
    )


@query(
    "working_days_add",
    "txn_id txn_date_ph:d one_day:d five_days:d",
    "select t.txn_id, t.txn_date_ph, add1 as one_day, add5 as five_days "
    "from (from txn union all by name from txn_history) t join deadlines on d = t.txn_date_ph",
)
def _working_days_add(x):
    day, holidays = F.col("txn_date_ph"), x.seeds.holidays
    return x.transactions.unionByName(x.history).select(
        "txn_id",
        "txn_date_ph",
        working_days_add(day, 1, holidays).alias("one_day"),
        working_days_add(day, 5, holidays).alias("five_days"),
    )


@query(
    "working_days_lookup",
    "txn_id txn_date_ph:d due_one:d due_five:d add_one:d add_five:d",
    "select t.txn_id, t.txn_date_ph, due1 as due_one, due5 as due_five, add1 as add_one, add5 as add_five "
    "from (from txn union all by name from txn_history) t join deadlines on d = t.txn_date_ph",
)
def _working_days_lookup(x):
    """Deadlines by the number of the working day: lookups in a calendar, no sequence per row."""
    rows = x.transactions.select("txn_id", "txn_date_ph").unionByName(x.history.select("txn_id", "txn_date_ph"))
    first, last = span(rows, "txn_date_ph", 5, 3)
    calendar = working_day_calendar(x.spark, first, last, x.seeds.non_working_days)
    for name, n, buffer in (("due_one", 1, 3), ("due_five", 5, 3), ("add_one", 1, 2), ("add_five", 5, 2)):
        rows = with_working_day(rows, "txn_date_ph", name, n, calendar, buffer)
    return rows


@query(
    "filing_urgency",
    "txn_id str_filing_deadline:d days_to_deadline:i filing_urgency",
    f"""
select txn_id, due5 as str_filing_deadline, due5 - {AS_OF} as days_to_deadline,
  case when due5 - {AS_OF} <= 0 then 'OVERDUE' when due5 - {AS_OF} <= 2 then 'DUE_SOON' else 'PENDING' end
    as filing_urgency
from txn join deadlines on d = txn_date_ph
""",
)
def _filing_urgency(x):
    deadline = working_day_deadline(F.col("txn_date_ph"), 5, x.seeds.holidays)
    return (
        x.transactions.select("txn_id", deadline.alias("str_filing_deadline"))
        .withColumn("days_to_deadline", F.datediff("str_filing_deadline", as_of(x.params)))
        .withColumn("filing_urgency", filing_urgency(F.col("days_to_deadline")))
    )


query(
    "risk_tier_label",
    "customer_id overall_risk_score:i tier",
    "select customer_id, overall_risk_score, case when overall_risk_score >= 75 then 'HIGH' "
    "when overall_risk_score >= 50 then 'MEDIUM' else 'LOW' end as tier from risk",
)(lambda x: x.risk.withColumn("tier", tier_label(F.col("overall_risk_score"), x.params)))
