"""The relational constructs the marts are made of, each on its own."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from amihan.catalog.check_sql import AS_OF, half_up
from amihan.catalog.detections import RISK
from amihan.catalog.marts import BRANCH_SUMMARY, COVERED
from amihan.catalog.registry import query
from amihan.functions.calendar import as_of, is_working_day, working_day_deadline
from amihan.functions.scoring import account_status_points, geography_points
from amihan.operators import customer_day as cd
from amihan.operators import kyc, risk, signals
from amihan.operators.listed import containing
from amihan.operators.running import with_running_totals
from amihan.operators.skew import join_groups
from amihan.operators.structuring import cash_debit_days
from amihan.plans import facts
from amihan.sources.sinks import rows_with_new_keys



def _is_cash():
    return F.col("txn_type") == "CASH"


# Filters ----------------------------------------------------------------------
query(
    "filter_cash_threshold",
    "txn_id amount_php:n",
    "select * from txn where txn_type = 'CASH' and amount_php >= 500000",
)(lambda x: x.transactions.filter(_is_cash() & (F.col("amount_php") >= x.params.ctr_php_threshold)))
query(
    "filter_not_in_list",
    "txn_id counterparty_bank",
    "select * from txn where counterparty_bank not in ('BDO', 'BPI')",
)(lambda x: x.transactions.filter(~F.col("counterparty_bank").isin("BDO", "BPI")))
query(
    "filter_in_list",
    "txn_id txn_type amount_php:n",
    "select * from txn where txn_type in ('WIRE', 'SWIFT', 'RTGS') "
    "or amount_php in (50000, 100000, 500000, 1000000, 5000000)",
)(
    lambda x: x.transactions.filter(
        F.col("txn_type").isin("WIRE", "SWIFT", "RTGS")
        | F.col("amount_php").isin(*[F.lit(a).cast("decimal(19,2)") for a in x.params.round_amounts])
    )
)
query(
    "filter_between_dates",
    "document_id expiry_date:d",
    f"select * from docs where expiry_date between {AS_OF} and {AS_OF} + 90",
)(lambda x: x.documents.filter(F.col("expiry_date").between(as_of(x.params), F.date_add(as_of(x.params), 90))))
query(
    "filter_like_pattern_column",
    "txn_id iso2_code",
    """
select txn_id, iso2_code from txn join seed_fatf
  on upper(counterparty_bank) like '%' || iso2_code || '%' or upper(purpose_description) like '%' || country_name || '%'
""",
)(
    lambda x: x.transactions.select(
        "txn_id",
        F.explode(
            F.array_compact(
                F.array(*[F.when(signals.jurisdiction_hit(j), j.iso2_code) for j in x.seeds.jurisdictions])
            )
        ).alias("iso2_code"),
    )
)
query(
    "filter_not_null",
    "txn_id counterparty_bank",
    "select * from txn where counterparty_bank is not null",
)(lambda x: x.transactions.filter(F.col("counterparty_bank").isNotNull()))
query(
    "filter_or_flags",
    "screening_id is_potential_match is_sanctions_confirmed",
    "select * from screening where is_potential_match or is_sanctions_confirmed",
)(lambda x: x.screening.filter(F.col("is_potential_match") | F.col("is_sanctions_confirmed")))
query(
    "filter_year_of_date",
    "txn_id txn_date_ph:d",
    "select * from txn_history where year(txn_date_ph) = 1997 and month(txn_date_ph) between 4 and 9",
)(
    lambda x: x.history.filter(
        (F.col("txn_date_ph") >= F.lit(date(1997, 4, 1))) & (F.col("txn_date_ph") < F.lit(date(1997, 10, 1)))
    )
)
query(
    "case_ladder",
    "customer_id account_status_risk_score:i geography_risk_score:i",
    "select * from risk_parts",
)(
    lambda x: x.customers.select(
        "customer_id",
        account_status_points(F.col("account_status")).alias("account_status_risk_score"),
        geography_points(F.col("nationality")).alias("geography_risk_score"),
    )
)
query(
    "project_typed_nulls",
    "ctr_id filing_status filing_date:d amlc_ers_reference",
    "select * from covered",
)(lambda x: x.covered)

# Joins ------------------------------------------------------------------------


@query("join_self_customer_day", "txn_id customer_id txn_date_ph:d day_total:n", "select * from cash_day_pairs")
def _join_self_customer_day(x):
    """The day's cash total on every cash row: an aggregate joined back, not pairs."""
    rows = x.transactions.filter(_is_cash()).select("txn_id", *cd.KEYS, "amount_php")
    totals = rows.groupBy(*cd.KEYS).agg(F.sum("amount_php").alias("day_total"))
    return join_groups(rows.drop("amount_php"), totals, cd.KEYS, F.col("txn_id"))


@query(
    "join_preaggregate_back",
    "txn_id customer_id txn_date_ph:d day_count:i",
    "select * from txn join day_counts using (customer_id, txn_date_ph)",
)
def _join_preaggregate_back(x):
    counts = cd.customer_day(x.transactions).select(*cd.KEYS, "day_count")
    return join_groups(x.transactions.select("txn_id", *cd.KEYS), counts, cd.KEYS, F.col("txn_id"))


query(
    "join_txn_customer_inner",
    "txn_id customer_id customer_type is_pep",
    "select txn_id, customer_id, customer_type, is_pep from txn join cust using (customer_id)",
)(
    lambda x: x.transactions.select("txn_id", "customer_id").join(
        x.customers.select("customer_id", "customer_type", "is_pep"), "customer_id"
    )
)


@query(
    "join_theta_like_or",
    "txn_id iso2_code fatf_list_type",
    """
select txn_id, iso2_code, fatf_list_type from txn left join seed_fatf
  on upper(counterparty_bank) like '%' || iso2_code || '%' or upper(purpose_description) like '%' || country_name || '%'
""",
)
def _join_theta_like_or(x):
    """The LEFT theta join with the seed list; rows without a match stay once."""
    matches = F.array_compact(
        F.array(
            *[
                F.when(
                    signals.jurisdiction_hit(j),
                    F.struct(F.lit(j.iso2_code).alias("iso2_code"), F.lit(j.fatf_list_type).alias("fatf_list_type")),
                )
                for j in x.seeds.jurisdictions
            ]
        )
    )
    return x.transactions.select("txn_id", F.explode_outer(matches).alias("_m")).select("txn_id", "_m.*")


@query(
    "join_list_by_grams",
    "txn_id iso2_code fatf_list_type",
    """
select txn_id, iso2_code, fatf_list_type from txn join seed_fatf
  on upper(counterparty_bank) like '%' || iso2_code || '%' or upper(purpose_description) like '%' || country_name || '%'
""",
)
def _join_list_by_grams(x):
    """The matches of the theta join, as the equality join that lists of any length take."""
    texts = {"bank": F.upper("counterparty_bank"), "purpose": F.upper("purpose_description")}
    entries = x.seeds.fatf.select("iso2_code", "country_name", "fatf_list_type")
    return containing(x.transactions, ["txn_id"], texts, entries, {"bank": "iso2_code", "purpose": "country_name"})


query(
    "join_constant_lookup",
    "customer_id weight:n",
    "select customer_id, weight_value as weight from cust left join seed_weights "
    "on risk_category = 'PEP' and risk_subcategory = 'PEP_CUSTOMER'",
)(lambda x: x.customers.select("customer_id", risk.pep_weight(x.seeds.weights, x.params).alias("weight")))
query(
    "join_left_multi_customer",
    "customer_id kyc_completeness_score:n overall_risk_score:i total_watchlist_hits:i",
    "select customer_id, kyc_completeness_score, overall_risk_score, total_watchlist_hits "
    "from cust left join (select customer_id, kyc_completeness_score from kyc) using (customer_id) "
    "left join (select customer_id, overall_risk_score from risk) using (customer_id) left join hits using (customer_id)",
)(
    lambda x: x.customers.select("customer_id")
    .join(x.kyc.select("customer_id", "kyc_completeness_score"), "customer_id", "left")
    .join(x.risk.select("customer_id", "overall_risk_score"), "customer_id", "left")
    .join(risk.agg_watchlist_hits(x.screening), "customer_id", "left")
)
query(
    "join_left_then_group",
    "customer_id valid_docs_count:i expired_docs_count:i earliest_expiry_date:d",
    "select * from doc_facts",
)(lambda x: kyc.agg_doc_completeness(x.customers, x.documents))
query("join_star_dims", COVERED, "select * from covered")(lambda x: x.covered)


@query(
    "join_array_membership",
    "str_candidate_id indicator_code base_risk_score:i",
    "select * from candidates join seed_indicators on list_contains(str_indicators, indicator_code)",
)
def _join_array_membership(x):
    codes = x.candidates.select("str_candidate_id", F.explode("str_indicators").alias("indicator_code"))
    return codes.join(x.seeds.indicators, "indicator_code")


query(
    "join_fact_enrich",
    "str_id txn_id transaction_amount_php:n str_filing_deadline:d jurisdiction_risk:i",
    "select * from suspicious",
)(lambda x: x.suspicious)
query("join_left_preaggs", BRANCH_SUMMARY, "select * from branch_summary")(lambda x: x.branch_summary)
query(
    "join_anti_not_in",
    "txn_id txn_date_ph:d",
    "select * from txn where txn_id not in (select txn_id from ctr) "
    "and txn_date_ph not in (select calendar_date from seed_holidays)",
)(
    lambda x: rows_with_new_keys(x.transactions, x.ctr, ["txn_id"]).join(
        x.seeds.non_working_days.select(F.col("calendar_date").alias("txn_date_ph")), "txn_date_ph", "left_anti"
    )
)
query(
    "join_left_is_null_flag",
    "txn_id txn_date_ph:d is_ph_working_day",
    "select txn_id, txn_date_ph, isodow(txn_date_ph) < 6 and calendar_date is null as is_ph_working_day "
    "from txn left join seed_holidays on calendar_date = txn_date_ph",
)(
    lambda x: x.transactions.select("txn_id", "txn_date_ph")
    .join(
        x.seeds.non_working_days.select(F.col("calendar_date").alias("_holiday")),
        F.col("txn_date_ph") == F.col("_holiday"),
        "left",
    )
    .withColumn("is_ph_working_day", is_working_day(F.col("txn_date_ph"), ()) & F.col("_holiday").isNull())
)
query(
    "join_correlated_deadline",
    "ctr_id txn_date_ph:d filing_deadline:d",
    "select * from covered",
)(
    lambda x: x.covered.select(
        "ctr_id",
        "txn_date_ph",
        working_day_deadline(F.col("txn_date_ph"), 1, x.seeds.holidays).alias("filing_deadline"),
    )
)

# Aggregations -----------------------------------------------------------------
query(
    "agg_daily_counts",
    "customer_id txn_date_ph:d day_count:i",
    "select * from day_counts",
)(lambda x: cd.customer_day(x.transactions))
query(
    "agg_watchlist_hits",
    "customer_id total_watchlist_hits:i confirmed_sanctions_hits:i potential_match_count:i highest_match_confidence:n",
    "select * from hits",
)(lambda x: risk.agg_watchlist_hits(x.screening))
query(
    "agg_doc_completeness",
    "customer_id customer_type risk_tier is_pep kyc_last_update_date:d has_primary_id:i has_address_verification:i "
    "has_valid_primary_id:i valid_docs_count:i expired_docs_count:i has_docs_expiring_90d:i earliest_expiry_date:d",
    "select * from doc_facts",
)(lambda x: kyc.agg_doc_completeness(x.customers, x.documents))
query(
    "agg_indicator_category_scores",
    "str_candidate_id structuring_risk:i layering_risk:i jurisdiction_risk:i pep_risk:i",
    "select str_id as str_candidate_id, structuring_risk, layering_risk, jurisdiction_risk, pep_risk from suspicious",
)(
    lambda x: x.candidates.select(
        "str_candidate_id", *[c.alias(n) for n, c in facts.category_scores(x.seeds.indicators).items()]
    )
)
query("agg_ctr_ytd", "customer_id ctr_count_ytd:i", "select * from ctr_ytd")(
    lambda x: facts.agg_ctr_ytd(x.covered, x.params)
)
query("agg_str_ytd", "customer_id str_count_ytd:i str_overdue_count_ytd:i", "select * from str_ytd")(
    lambda x: facts.agg_str_ytd(x.suspicious, x.params)
)
query(
    "agg_branch_customers",
    "branch_code unique_customers:i high_risk_customers:i medium_risk_customers:i low_risk_customers:i "
    "pep_customers:i kyc_exceptions:i stale_kyc_customers:i avg_customer_risk_score:n",
    "select * from branch_customers",
)(lambda x: facts.agg_branch_customers(x.compliance))
query(
    "agg_branch_ctr",
    "branch_code ctr_count:i ctr_value_php:n ctr_inbound_count:i ctr_outbound_count:i ctr_max_amount_php:n "
    "ctr_avg_amount_php:n ctr_pending_count:i",
    "select * from branch_ctr",
)(lambda x: facts.agg_branch_ctr(x.covered))
query(
    "agg_branch_str",
    "branch_code str_count:i overdue_strs:i due_soon_strs:i pending_strs:i avg_str_risk_score:n max_str_risk_score:i "
    "high_confidence_strs:i medium_confidence_strs:i",
    "select * from branch_str",
)(lambda x: facts.agg_branch_str(x.suspicious))

# Windows ----------------------------------------------------------------------


_DAY_WINDOW = "partition by customer_id, txn_date_ph order by txn_id"


@query(
    "win_running_sum_day",
    "txn_id customer_id txn_date_ph:d running_total:n",
    f"select *, sum(amount_php) over ({_DAY_WINDOW}) as running_total from txn where txn_type = 'CASH'",
)
def _running_sum_day(x):
    """Every cash row with the sum of its day so far."""
    return with_running_totals(x.transactions.filter(_is_cash()), cd.KEYS, "txn_id", {"running_total": F.col("amount_php")})


@query(
    "win_row_number_day",
    "txn_id customer_id txn_date_ph:d day_rank:i",
    f"select *, row_number() over ({_DAY_WINDOW}) as day_rank from txn where txn_type = 'CASH'",
)
def _row_number_day(x):
    """Every cash row with its place in its day; ``ctr_related_cash`` needs the first only and aggregates."""
    return with_running_totals(x.transactions.filter(_is_cash()), cd.KEYS, "txn_id", {"day_rank": F.lit(1).cast("long")})


@query(
    "win_range_7d",
    "txn_id txn_count_7d:i txn_sum_7d:n observation_window_start_date:d",
    "select * from cash_windows",
)
def _win_range_7d(x):
    windows = cd.structuring_windows(cash_debit_days(x.transactions), x.params)
    rows = x.transactions.filter(cd.cash_debit()).select("txn_id", *cd.KEYS)
    return join_groups(rows, windows, cd.KEYS, F.col("txn_id"))


@query(
    "win_range_48h",
    "txn_id amount_in_48h:n amount_out_48h:n net_amount_48h:n txn_count_48h:i",
    "select * from flow_windows",
)
def _win_range_48h(x):
    windows = cd.velocity_windows(cd.customer_day(x.transactions), x.params)
    return join_groups(x.transactions.select("txn_id", *cd.KEYS), windows, cd.KEYS, F.col("txn_id"))


@query(
    "win_range_90d_avg",
    "txn_id avg_daily_velocity_90d:n",
    f"select txn_id, {half_up('counts_90d', 'rows_90d')} as avg_daily_velocity_90d from flow_windows",
)
def _win_range_90d_avg(x):
    windows = cd.velocity_windows(cd.customer_day(x.transactions), x.params)
    return join_groups(x.transactions.select("txn_id", *cd.KEYS), windows, cd.KEYS, F.col("txn_id"))


query("win_surrogate_key", "customer_sk:i customer_id", "select * from dim_cust")(lambda x: x.dim_customers)


@query(
    "win_working_day_rank",
    "txn_id working_day:d place:i",
    "select txn_id, f.x as working_day, place from txn join following_days f on f.d = txn_date_ph",
)
def _win_working_day_rank(x):
    """The working days of the 15 days after each transaction with their rank."""
    days = F.sequence(F.date_add("txn_date_ph", 1), F.date_add("txn_date_ph", 15))
    working = F.filter(days, lambda d: is_working_day(d, x.seeds.holidays))
    return x.transactions.select("txn_id", F.posexplode(working).alias("_pos", "working_day")).withColumn(
        "place", F.col("_pos") + 1
    )


# Sorts and limits -------------------------------------------------------------
query("sort_report_desc", "ctr_id txn_date_ph:d", "select * from covered")(
    lambda x: x.covered.orderBy(F.desc("txn_date_ph"), "ctr_id")
)
query("sort_table_layout", "ctr_candidate_id txn_date_ph:d", "select * from ctr")(
    lambda x: x.ctr.sortWithinPartitions(F.desc("txn_date_ph"), "txn_id")
)
query(
    "limit_first_working_day",
    "txn_id first_working_day:d",
    "select txn_id, min(f.x) as first_working_day from txn left join following_days f on f.d = txn_date_ph and gap <= 3 "
    "group by txn_id",
)(
    lambda x: x.transactions.select(
        "txn_id", working_day_deadline(F.col("txn_date_ph"), 1, x.seeds.holidays).alias("first_working_day")
    )
)
query(
    "topk_customers_by_risk",
    RISK,
    "select * from risk order by overall_risk_score desc, customer_id limit 20",
)(lambda x: x.risk.orderBy(F.desc("overall_risk_score"), "customer_id").limit(20))
query(
    "topk_branches_overdue",
    BRANCH_SUMMARY,
    "select * from branch_summary order by overdue_strs desc, str_count desc, branch_code limit 10",
)(
    lambda x: x.branch_summary.orderBy(F.desc("overdue_strs"), F.desc("str_count"), "branch_code").limit(10)
)
