"""Relations of the check SQL: the same tables stated once more in plain SQL.

They are written for another engine and in the most direct form (self joins,
theta joins, row windows), so that they check the Spark jobs independently.
"""

from __future__ import annotations

import csv
import io

from amihan.sources import seeds as seed_texts

AS_OF = "date '2026-06-30'"
RUN_EPOCH = 1782784800
RUN_MANILA = "timestamp '2026-06-30 10:00:00'"


def _values(text: str, kinds: str) -> str:
    """A seed list as a VALUES relation; kinds: s text, d date, n number."""
    rows = list(csv.reader(io.StringIO(text)))

    def cell(value: str, kind: str) -> str:
        if value == "":
            return "cast(null as date)" if kind == "d" else "null"
        if kind == "n":
            return value
        quoted = "'" + value.replace("'", "''") + "'"
        return f"date {quoted}" if kind == "d" else quoted

    body = ", ".join("(" + ", ".join(cell(v, k) for v, k in zip(row, kinds)) + ")" for row in rows[1:])
    return f"select * from (values {body}) as v({', '.join(rows[0])})"


def half_up(numerator: str, denominator: str, digits: int = 2) -> str:
    """round(numerator / denominator, digits), half away from zero, for whole numbers."""
    scale = 10**digits
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    return f"(cast(sign({n}) * ((2 * {scale} * abs({n}) + {d}) // (2 * {d})) as double) / {scale})"


def key(*columns: str) -> str:
    parts = [f"coalesce(cast({c} as varchar), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return f"md5({" || '-' || ".join(parts)})"


def _pick(values: str, index: str) -> str:
    return f"([{values}])[cast({index} as bigint) + 1]"


_BRANCHES = "'MKT001','MKT002','CEB001','CEB002','DVO001','CDO001','ILO001','LEG001','PUA001','BAG001','TAC001','ZAM001'"

RELATIONS: dict[str, str] = {}


def _relation(name: str, sql: str) -> None:
    RELATIONS[name] = sql


# Seeds ---------------------------------------------------------------------
_relation("seed_branches", _values(seed_texts.PH_BRANCHES, "sssss"))
_relation("seed_fatf", _values(seed_texts.FATF_JURISDICTIONS, "sssdd"))
_relation("seed_weights", _values(seed_texts.AML_RISK_WEIGHTS, "ssns"))
_relation("seed_holidays", _values(seed_texts.PH_NON_WORKING_DAYS, "dss"))
_relation("seed_indicators", _values(seed_texts.STR_INDICATORS_REF, "ssssns"))

# Landing tables ------------------------------------------------------------
_TRANSACTIONS = """
select 'T' || lpad(cast(o as varchar), 12, '0') as txn_id,
  'CUST' || lpad(cast(c as varchar), 12, '0') as customer_id,
  {branch} as branch_code, {day} as txn_date_ph, '10:00:00' as txn_time_ph,
  {kind} as txn_type, {channel} as txn_channel,
  case when (o // 10) % 10 < 6 then 'DEBIT' else 'CREDIT' end as transaction_direction,
  amount as amount_local,
  case when o % 11 = 0 or o % 10 = 9 then 'USD' else 'PHP' end as currency_code,
  amount as amount_php, cast(null as varchar) as counterparty_name,
  '1234' || lpad(cast(o % 500 as varchar), 10, '0') as counterparty_account,
  {bank} as counterparty_bank, cast(null as varchar) as purpose_code,
  case when o % 13 = 0 then 'Remit to Iran' when o % 17 = 0 then 'REMIT TO TURKEY' else 'Fund transfer' end
    as purpose_description,
  'REF' || cast(o as varchar) as reference_number, 'TEMENOS' as source_system, 'B1' as batch_id
from (select o_orderkey as o, o_custkey as c, cast(o_orderdate as date) as ordered,
        cast(case when o_orderkey % 50 = 0 then {round}
             when o_orderkey % 4 = 0 then cast(o_totalprice as decimal(19,2)) * 2
             when o_orderkey % 10 = 9 then cast(o_totalprice as decimal(19,2)) * 3
             else cast(o_totalprice as decimal(19,2)) end as decimal(15,2)) as amount
      from orders)
"""


def _transactions(day: str) -> str:
    return _TRANSACTIONS.format(
        branch=_pick(_BRANCHES, "c % 12"),
        day=day,
        kind=_pick("'CASH','CASH','CASH','CASH','CASH','CASH','RTGS','PESONet','InstaPay','SWIFT'", "o % 10"),
        channel=_pick("'BRANCH','ATM','ONLINE','MOBILE'", "o % 4"),
        bank=_pick("'BDO','BPI','METROBANK','UNIONBANK','EASTWEST','SYRIA COMMERCIAL',null", "o % 7"),
        round=_pick("50000,100000,500000,1000000,5000000", "(o_orderkey // 50) % 5"),
    )


_relation("raw_txn", _transactions("date '2026-06-01' + cast((o * 7) % 30 as integer)"))
_relation("raw_txn_history", _transactions("ordered"))
_relation(
    "raw_cust",
    f"""
select 'CUST' || lpad(cast(k as varchar), 12, '0') as customer_id, c_name as customer_name,
  {_pick("'INDIVIDUAL','CORPORATE','SOLEPROPRIETOR','NGO','GOVERNMENT'", "k % 5")} as customer_type,
  lpad(cast(k as varchar), 10, '0') as sss_number, lpad(cast(k as varchar), 10, '0') as tin_number,
  lpad(cast(k as varchar), 10, '0') as philhealth_id, cast(null as date) as date_of_birth,
  case c_nationkey when 0 then 'KP' when 1 then 'IR' when 2 then 'BY' when 3 then 'TR' when 4 then 'PA' else 'PH' end
    as nationality,
  k % 20 = 0 as is_pep, case when k % 20 = 0 then {AS_OF} - 100 end as pep_determination_date,
  case when k % 20 = 0 or k % 10 = 9 then 'HIGH' when k % 10 between 6 and 8 then 'MEDIUM' else 'LOW' end as risk_tier,
  case k % 25 when 1 then 'DORMANT' when 2 then 'RESTRICTED' when 3 then 'FROZEN' when 4 then 'CLOSED' else 'ACTIVE' end
    as account_status,
  {AS_OF} - cast(365 + k % 1460 as integer) as account_opened_date, {_pick(_BRANCHES, "k % 12")} as branch_code,
  {_pick("'RETAIL','SME','CORPORATE'", "k % 3")} as customer_segment, 'COMPLETE' as kyc_status,
  {AS_OF} - cast((k * 37) % 2200 as integer) as kyc_last_update_date, c_mktsegment as market_segment
from (select c_custkey as k, * from customer)
""",
)
_relation(
    "raw_docs",
    f"""
select 'D' || lpad(cast(k as varchar), 12, '0') || '-' || i as document_id,
  case when k % 100 = 33 and i = 4 then 'GONE' else 'CUST' end || lpad(cast(k as varchar), 12, '0') as customer_id,
  case when (k + i) % 100 <> 0 then {_pick("'PASSPORT','NATIONAL_ID','DRIVERS_LICENSE','POSTAL_ID'", "i - 1")} end as document_type,
  'N' || k || i as document_number, case when k % 100 <> 7 then {AS_OF} - cast(30 + k % 1000 as integer) end as issue_date,
  case when (k + i) % 20 = 0 then null when (k * i) % 7 = 0 then {AS_OF} - cast(1 + k % 365 as integer)
    else {AS_OF} + cast((k * 13 + i * 50) % 1500 as integer) end as expiry_date,
  'PH' as issuing_country, 'DFA' as issuing_authority
from (select c_custkey as k, unnest([1, 2, 3, 4]) as i from customer)
""",
)
_relation(
    "raw_screening",
    f"""
select 'W' || lpad(cast(k as varchar), 12, '0') as screening_id,
  case when k % 100 = 66 then 'GONE' else 'CUST' end || lpad(cast(k as varchar), 12, '0') as customer_id,
  case when k % 100 <> 50 then {AS_OF} - cast(k % 60 as integer) end as screening_date,
  {_pick("'AMLC_LIST','UN_SANCTIONS','OFAC_SDN','INTERNAL_BLACKLIST'", "(k // 4) % 4")} as watchlist_source,
  {_pick("'NO_MATCH','POSSIBLE_MATCH','CONFIRMED_MATCH','FALSE_POSITIVE'", "(k // 16) % 4")} as match_status,
  c_name as matched_name, cast((k * 7) % 101 as decimal(5,2)) as match_score,
  cast(case when k % 100 = 25 then 105 else (k * 7) % 101 end as decimal(5,2)) as match_confidence_pct, cast(null as varchar) as notes
from (select c_custkey as k, c_name from customer)
""",
)

# Bronze --------------------------------------------------------------------
_STG_TXN = """
select * replace (upper(trim(txn_type)) as txn_type, upper(trim(txn_channel)) as txn_channel,
    upper(trim(transaction_direction)) as transaction_direction, upper(trim(currency_code)) as currency_code,
    cast(amount_php as decimal(19,2)) as amount_php, cast(amount_local as decimal(19,4)) as amount_local),
  epoch(cast(cast(txn_date_ph as varchar) || ' ' || txn_time_ph as timestamp)) - 8 * 3600 as txn_ts_ph
from {raw} where customer_id is not null and amount_php > 0 and txn_date_ph is not null
"""
_relation("txn", _STG_TXN.format(raw="raw_txn"))
_relation("txn_history", _STG_TXN.format(raw="raw_txn_history"))
_relation(
    "cust",
    """
select * replace (upper(trim(customer_type)) as customer_type, coalesce(is_pep, false) as is_pep,
  case when is_pep then 'HIGH' when upper(risk_tier) in ('HIGH', 'MEDIUM') then upper(risk_tier)
       when upper(risk_tier) = 'MED' then 'MEDIUM' else 'LOW' end as risk_tier)
from raw_cust where customer_id is not null and customer_name is not null and account_opened_date is not null
""",
)
_relation(
    "docs",
    f"""
select *, expiry_date - {AS_OF} as days_until_expiry, coalesce(expiry_date < {AS_OF}, false) as is_expired,
  coalesce(expiry_date - {AS_OF} between 0 and 90, false) as expiry_within_90_days
from raw_docs where customer_id is not null and document_type is not null and issue_date is not null
""",
)
_relation(
    "screening",
    """
select *, match_status in ('CONFIRMED_MATCH', 'POSSIBLE_MATCH') as is_potential_match,
  match_status = 'CONFIRMED_MATCH' and watchlist_source in ('UN_SANCTIONS', 'OFAC_SDN') as is_sanctions_confirmed
from raw_screening where customer_id is not null and screening_date is not null
""",
)

# Working days: per start date the n-th following working day -----------------
_relation(
    "start_days",
    f"select distinct txn_date_ph as d from txn union select distinct txn_date_ph from txn_history union select {AS_OF}",
)
_relation(
    "following_days",
    """
select d, x, x - d as gap, row_number() over (partition by d order by x) as place
from (select d, unnest([d + cast(g as integer) for g in range(1, 16)]) as x from start_days)
where isodow(x) <= 5 and x not in (select calendar_date from seed_holidays)
""",
)
_relation(
    "deadlines",
    """
select s.d, min(f.x) filter (place = 1 and gap <= 3) as due1, min(f.x) filter (place = 5 and gap <= 15) as due5,
  min(f.x) filter (place = 1 and gap <= 2) as add1, min(f.x) filter (place = 5 and gap <= 10) as add5
from start_days s left join following_days f on f.d = s.d group by s.d
""",
)

# Silver --------------------------------------------------------------------
_CTR_COLUMNS = (
    "txn_id, customer_id, branch_code, txn_date_ph, txn_type, txn_channel, amount_php, counterparty_name, "
    "counterparty_account, transaction_direction"
)
_relation(
    "ctr_single",
    f"select {_CTR_COLUMNS}, 'SINGLE_CASH' as ctr_type, amount_php as ctr_amount_php from txn "
    "where txn_type = 'CASH' and amount_php >= 500000",
)
_relation(
    "cash_day_pairs",
    """
select a.txn_id, a.customer_id, a.txn_date_ph, sum(b.amount_php) as day_total
from txn a join txn b on b.customer_id = a.customer_id and b.txn_date_ph = a.txn_date_ph
where a.txn_type = 'CASH' and b.txn_type = 'CASH' group by all
""",
)
_relation(
    "first_of_day",
    """
select *, row_number() over (partition by customer_id, txn_date_ph order by txn_id) as day_rank from cash_day_pairs
qualify day_rank = 1
""",
)
_relation(
    "ctr_related",
    f"select {', '.join('t.' + c.strip() for c in _CTR_COLUMNS.split(','))}, 'RELATED_CASH' as ctr_type, "
    "f.day_total as ctr_amount_php from first_of_day f join txn t using (txn_id) where f.day_total >= 500000",
)
_relation(
    "ctr_forex",
    f"select {_CTR_COLUMNS}, 'FOREX_EQUIVALENT' as ctr_type, amount_php as ctr_amount_php from txn "
    "where currency_code <> 'PHP' and amount_php >= 560000 and txn_type in ('WIRE', 'SWIFT', 'RTGS')",
)
_relation(
    "ctr",
    f"select *, true as is_ctr_candidate, {key('txn_id', 'ctr_type')} as ctr_candidate_id from "
    "(from ctr_single union all by name from ctr_related union all by name from ctr_forex)",
)
_relation(
    "cash_windows",
    """
select *, count(*) over w as txn_count_7d, sum(amount_php) over w as txn_sum_7d,
  min(txn_date_ph) over w as observation_window_start_date
from txn where txn_type = 'CASH' and transaction_direction = 'DEBIT'
window w as (partition by customer_id order by txn_date_ph range between interval 7 days preceding and current row)
""",
)
_relation(
    "structuring",
    f"""
select *, {key("customer_id", "txn_date_ph", "observation_window_start_date")} as structuring_event_id,
  amount_php < 490000 as is_structuring_pattern,
  case when amount_php < 490000 then 'STRUCT_01' end as str_indicator_code,
  case when amount_php < 490000 then 70 else 0 end as risk_score_structuring,
  {half_up("(txn_sum_7d * 100 - 50000000) * 100", "50000000")} as threshold_evasion_pct
from cash_windows where txn_count_7d >= 3 and txn_sum_7d >= 450000
""",
)
_relation(
    "day_counts",
    "select customer_id, txn_date_ph, count(*) as day_count from txn where amount_php > 0 group by all",
)
_relation(
    "flow_windows",
    """
select txn.*, day_count,
  coalesce(sum(amount_php) filter (transaction_direction = 'CREDIT') over short, 0) as amount_in_48h,
  coalesce(sum(amount_php) filter (transaction_direction = 'DEBIT') over short, 0) as amount_out_48h,
  sum(amount_php) over short as net_amount_48h, count(*) over short as txn_count_48h,
  sum(day_count) over long as counts_90d, count(*) over long as rows_90d
from txn join day_counts using (customer_id, txn_date_ph)
window short as (partition by customer_id order by txn_date_ph range between interval 2 days preceding and current row),
  long as (partition by customer_id order by txn_date_ph range between interval 90 days preceding and current row)
""",
)
_LAYERING = """
select *, {event} as layering_event_id, {pct} as net_position_pct, {avg} as avg_daily_velocity_90d,
  case when is_layering_pattern then 'LAYER_01' end as str_indicator_code,
  case when is_layering_pattern then 65 else 0 end as risk_score_layering
from (select * replace ({net} as net_amount_48h),
        amount_in_48h > 50000 and amount_out_48h > 50000
          and {net} < (amount_in_48h + amount_out_48h) * 0.10 as is_layering_pattern,
        txn_count_48h * rows_90d > 2 * counts_90d and amount_in_48h > 0 and amount_out_48h > 0 as velocity_anomaly
      from flow_windows)
where is_layering_pattern or velocity_anomaly
"""


def _layering(net: str) -> str:
    return _LAYERING.format(
        net=net,
        event=key("customer_id", "txn_date_ph"),
        pct=half_up("net_amount_48h * 10000", "(amount_in_48h + amount_out_48h) * 100"),
        avg=half_up("counts_90d", "rows_90d"),
    )


_relation("layering", _layering("net_amount_48h"))
_relation("layering_intent", _layering("abs(amount_in_48h - amount_out_48h)"))
_relation(
    "doc_facts",
    """
select c.customer_id, c.customer_type, c.risk_tier, c.is_pep, c.kyc_last_update_date,
  cast(count(*) filter (document_type in ('PASSPORT', 'NATIONAL_ID', 'DRIVERS_LICENSE')) > 0 as integer) as has_primary_id,
  cast(count(*) filter (document_type = 'POSTAL_ID') > 0 as integer) as has_address_verification,
  cast(count(*) filter (document_type in ('NATIONAL_ID', 'PASSPORT') and not is_expired) > 0 as integer)
    as has_valid_primary_id,
  count(*) filter (not is_expired) as valid_docs_count, count(*) filter (is_expired) as expired_docs_count,
  cast(count(*) filter (expiry_within_90_days) > 0 as integer) as has_docs_expiring_90d,
  min(expiry_date) as earliest_expiry_date
from cust c left join docs d on d.customer_id = c.customer_id group by all
""",
)
_relation(
    "kyc",
    f"""
select *, points / 100 as kyc_completeness_score, points < 8000 as kyc_exception,
  coalesce(kyc_last_update_date < cast({AS_OF} - to_years(years) as date), false) as kyc_freshness_flag,
  {AS_OF} - kyc_last_update_date as days_since_kyc_update,
  cast(kyc_last_update_date + to_years(years) as date) as kyc_refresh_due_date,
  case when is_pep then 'REQUIRES_SCREENING' else 'NOT_APPLICABLE' end as pep_screening_status
from (select *, has_primary_id * 30 + has_valid_primary_id * 20 + has_address_verification * 20
          + least(valid_docs_count, 3) * 10 as points,
        case risk_tier when 'HIGH' then 1 when 'MEDIUM' then 3 else 5 end as years
      from doc_facts)
""",
)
_relation(
    "hits",
    """
select customer_id, count(*) as total_watchlist_hits, count(*) filter (is_sanctions_confirmed) as confirmed_sanctions_hits,
  count(*) filter (is_potential_match) as potential_match_count, max(match_confidence_pct) as highest_match_confidence
from screening group by customer_id
""",
)
_relation(
    "risk_parts",
    """
select c.*, k.kyc_completeness_score, coalesce(h.total_watchlist_hits, 0) as hit_count,
  case when c.is_pep then coalesce((select weight_value from seed_weights
      where risk_category = 'PEP' and risk_subcategory = 'PEP_CUSTOMER'), 75) else 0 end as pep_risk_score,
  case c.customer_type when 'SOLEPROPRIETOR' then 35 when 'INDIVIDUAL' then 30 when 'CORPORATE' then 20
    when 'NGO' then 10 when 'GOVERNMENT' then 5 else 25 end as customer_type_risk_score,
  case when nationality in ('KP', 'IR', 'SY') then 90
    when nationality in ('BY', 'JO', 'LB', 'PA', 'TR', 'ZA') then 50 else 10 end as geography_risk_score,
  case when kyc_completeness_score < 60 then 40 when kyc_completeness_score < 80 then 25
    when kyc_completeness_score < 90 then 15 else 5 end as kyc_health_risk_score,
  case account_status when 'FROZEN' then 30 when 'RESTRICTED' then 25 when 'DORMANT' then 15
    when 'ACTIVE' then 0 when 'CLOSED' then 0 else 10 end as account_status_risk_score,
  case when confirmed_sanctions_hits > 0 then 50 when highest_match_confidence > 75 then 40
    when highest_match_confidence > 50 then 20 when total_watchlist_hits > 0 then 15 else 0 end as watchlist_risk_score
from cust c left join kyc k using (customer_id) left join hits h using (customer_id)
""",
)
_relation(
    "risk",
    """
select *, least(100, cast(round(total / 5.0) as integer)) as overall_risk_score,
  case when total >= 375 then 'HIGH' when total >= 250 then 'MEDIUM' else 'LOW' end as overall_risk_tier,
  list_filter([case when is_pep then 'PEP' end, case when account_status = 'FROZEN' then 'FROZEN_ACCOUNT' end,
    case when hit_count > 0 then 'WATCHLIST_HIT' end, case when kyc_completeness_score < 80 then 'INCOMPLETE_KYC' end],
    lambda f: f is not null) as risk_factors
from (select *, pep_risk_score + customer_type_risk_score + geography_risk_score + kyc_health_risk_score
        + account_status_risk_score + watchlist_risk_score as total from risk_parts)
""",
)
_relation(
    "sig_structuring",
    "select customer_id, txn_id, branch_code, txn_date_ph, 'STRUCT_01' as indicator_code, 70 as signal_risk_score, "
    "txn_count_7d, cast(null as varchar) as signal_detail from structuring where is_structuring_pattern",
)
_relation(
    "sig_layering",
    "select customer_id, txn_id, branch_code, txn_date_ph, 'LAYER_01' as indicator_code, 65 as signal_risk_score, "
    "cast(null as bigint) as txn_count_7d, cast(cast(net_position_pct as decimal(18,2)) as varchar) as signal_detail "
    "from layering where is_layering_pattern",
)


def _fatf(extra: str, name: str) -> str:
    return f"""
select t.customer_id, t.txn_id, t.branch_code, t.txn_date_ph,
  if(j.fatf_list_type = 'BLACKLIST', 'JURIS_01', 'JURIS_02') as indicator_code,
  if(j.fatf_list_type = 'BLACKLIST', 90, 50) as signal_risk_score, cast(null as bigint) as txn_count_7d,
  j.country_name as signal_detail
from seed_fatf j join txn t on (contains(upper(t.counterparty_bank), j.iso2_code)
    or contains(upper(t.purpose_description), {name})) {extra}
where t.customer_id in (select customer_id from cust)
"""


_relation("sig_fatf", _fatf("", "j.country_name"))
_relation(
    "sig_fatf_active",
    _fatf("and (j.removal_date is null or t.txn_date_ph < j.removal_date)", "upper(j.country_name)"),
)
_relation(
    "sig_pep",
    "select customer_id, txn_id, txn.branch_code, txn_date_ph, 'PEP_01' as indicator_code, 75 as signal_risk_score, "
    "cast(null as bigint) as txn_count_7d, cast(amount_php as varchar) as signal_detail "
    "from txn join cust using (customer_id) where is_pep and amount_php >= 50000",
)
_relation(
    "sig_round",
    "select customer_id, txn_id, branch_code, txn_date_ph, 'ROUND_01' as indicator_code, 30 as signal_risk_score, "
    "cast(null as bigint) as txn_count_7d, cast(amount_php as varchar) as signal_detail "
    "from txn where txn_type = 'CASH' and amount_php in (50000, 100000, 500000, 1000000, 5000000)",
)
_relation(
    "signals",
    "from sig_structuring union all from sig_layering union all from sig_fatf union all from sig_pep "
    "union all from sig_round",
)
_relation(
    "signal_groups",
    """
select customer_id, txn_id, branch_code, txn_date_ph, list(distinct indicator_code order by indicator_code) as str_indicators,
  count(distinct indicator_code) as indicator_count, max(signal_risk_score) as max_risk_score,
  string_agg(distinct signal_detail, '; ' order by signal_detail) as signal_details
from signals group by customer_id, txn_id, branch_code, txn_date_ph
""",
)
_relation(
    "candidates",
    f"""
select *, {key("customer_id", "txn_id")} as str_candidate_id, {RUN_MANILA} as str_determination_ts,
  {RUN_MANILA} as str_determination_date,
  case when indicator_count >= 3 then 'HIGH' when indicator_count = 2 then 'MEDIUM' else 'LOW' end as str_confidence_level
from signal_groups
""",
)

# Gold ----------------------------------------------------------------------
_relation(
    "dim_branch",
    "select row_number() over (order by branch_code) as branch_sk, * from seed_branches",
)
_relation(
    "dim_day",
    f"""
select cast(strftime(d, '%Y%m%d') as integer) as date_id, d as calendar_date, year(d) as calendar_year,
  month(d) as calendar_month, quarter(d) as calendar_quarter, day(d) as day_of_month, dayofweek(d) as day_of_week,
  dayname(d) as day_name, isodow(d) < 6 and d not in (select calendar_date from seed_holidays) as is_ph_working_day,
  date_trunc('week', d) = date_trunc('week', {AS_OF}) as is_current_week,
  date_trunc('month', d) = date_trunc('month', {AS_OF}) as is_current_month, year(d) = year({AS_OF}) as is_current_year
from (select unnest([cast({AS_OF} - interval 5 years as date) + cast(i as integer) for i in range(0, 1826)]) as d)
""",
)
_relation(
    "dim_cust",
    f"""
select row_number() over (order by c.customer_id) as customer_sk, c.customer_id,
  c.customer_name[1] || '***' || c.customer_name[-1] as customer_name, c.customer_type, c.customer_segment,
  '***' || right(c.sss_number, 4) as sss_number, '***' || right(c.tin_number, 4) as tin_number, c.date_of_birth,
  c.nationality, c.is_pep, c.pep_determination_date, c.risk_tier, c.account_status, c.account_opened_date, c.branch_code,
  r.overall_risk_score, r.overall_risk_tier, r.pep_risk_score, r.customer_type_risk_score, r.geography_risk_score,
  r.kyc_health_risk_score, r.account_status_risk_score, r.watchlist_risk_score, r.risk_factors, {AS_OF} as valid_from,
  cast(null as date) as valid_to, true as is_current
from cust c left join risk r on r.customer_id = c.customer_id
""",
)
_relation(
    "covered",
    """
select ctr_candidate_id as ctr_id, c.txn_id, c.customer_id, d.date_id as txn_date_id, c.txn_date_ph, b.branch_code,
  c.amount_php, c.transaction_direction, c.ctr_type, c.txn_channel, x.due1 as filing_deadline,
  'PENDING' as filing_status, cast(null as date) as filing_date, cast(null as varchar) as amlc_ers_reference
from ctr c left join dim_branch b on b.branch_code = c.branch_code left join dim_day d on d.calendar_date = c.txn_date_ph
left join deadlines x on x.d = c.txn_date_ph
""",
)
_relation(
    "category_scores",
    """
select str_candidate_id, sum(base_risk_score) filter (indicator_category = 'STRUCTURING') as structuring_risk,
  sum(base_risk_score) filter (indicator_category = 'LAYERING') as layering_risk,
  sum(base_risk_score) filter (indicator_category = 'JURISDICTION') as jurisdiction_risk,
  sum(base_risk_score) filter (indicator_category = 'PEP') as pep_risk
from candidates join seed_indicators on list_contains(str_indicators, indicator_code) group by str_candidate_id
""",
)
_relation(
    "suspicious",
    f"""
select s.str_candidate_id as str_id, s.*, t.amount_php as transaction_amount_php,
  coalesce(structuring_risk, 0) as structuring_risk, coalesce(layering_risk, 0) as layering_risk,
  coalesce(jurisdiction_risk, 0) as jurisdiction_risk, coalesce(pep_risk, 0) as pep_risk,
  x.due5 as str_filing_deadline, x.due5 - {AS_OF} as days_to_deadline,
  case when x.due5 - {AS_OF} <= 0 then 'OVERDUE' when x.due5 - {AS_OF} <= 2 then 'DUE_SOON' else 'PENDING' end
    as filing_urgency,
  'PENDING' as filing_status, cast(null as date) as filed_at, cast(null as varchar) as amlc_ers_reference
from candidates s left join txn t on t.txn_id = s.txn_id left join category_scores g on g.str_candidate_id = s.str_candidate_id
left join deadlines x on x.d = cast(s.str_determination_ts as date)
""",
)
_relation(
    "ctr_ytd",
    "select customer_id, count(*) as ctr_count_ytd from covered where year(txn_date_ph) = 2026 group by customer_id",
)
_relation(
    "str_ytd",
    "select customer_id, count(*) as str_count_ytd, count(*) filter (filing_urgency = 'OVERDUE') as str_overdue_count_ytd "
    "from suspicious where year(str_determination_ts) = 2026 group by customer_id",
)
_relation(
    "compliance",
    f"""
select c.*, {AS_OF} as snapshot_date, k.* exclude (customer_id, customer_type, risk_tier, is_pep, kyc_last_update_date),
  r.overall_risk_score, r.overall_risk_tier, r.pep_risk_score, r.customer_type_risk_score, r.geography_risk_score,
  r.kyc_health_risk_score, r.account_status_risk_score, r.watchlist_risk_score,
  coalesce(ctr_count_ytd, 0) as ctr_count_ytd, coalesce(str_count_ytd, 0) as str_count_ytd,
  coalesce(str_overdue_count_ytd, 0) as str_overdue_count_ytd
from (select * exclude (risk_tier) from cust) c left join kyc k on k.customer_id = c.customer_id
left join risk r on r.customer_id = c.customer_id left join ctr_ytd y on y.customer_id = c.customer_id
left join str_ytd z on z.customer_id = c.customer_id
""",
)
_relation(
    "branch_customers",
    f"""
select branch_code, count(distinct customer_id) as unique_customers,
  count(*) filter (overall_risk_tier = 'HIGH') as high_risk_customers,
  count(*) filter (overall_risk_tier = 'MEDIUM') as medium_risk_customers,
  count(*) filter (overall_risk_tier = 'LOW') as low_risk_customers, count(*) filter (is_pep) as pep_customers,
  count(*) filter (kyc_exception) as kyc_exceptions, count(*) filter (kyc_freshness_flag) as stale_kyc_customers,
  {half_up("sum(overall_risk_score)", "count(overall_risk_score)")} as avg_customer_risk_score
from compliance group by branch_code
""",
)
_relation(
    "branch_ctr",
    f"""
select branch_code, count(*) as ctr_count, sum(amount_php) as ctr_value_php,
  count(*) filter (transaction_direction = 'CREDIT') as ctr_inbound_count,
  count(*) filter (transaction_direction = 'DEBIT') as ctr_outbound_count, max(amount_php) as ctr_max_amount_php,
  {half_up("sum(amount_php) * 100", "count(amount_php) * 100")} as ctr_avg_amount_php,
  count(*) filter (filing_status = 'PENDING') as ctr_pending_count
from covered group by branch_code
""",
)
_relation(
    "branch_str",
    f"""
select branch_code, count(*) as str_count, count(*) filter (filing_urgency = 'OVERDUE') as overdue_strs,
  count(*) filter (filing_urgency = 'DUE_SOON') as due_soon_strs, count(*) filter (filing_urgency = 'PENDING') as pending_strs,
  {half_up("sum(max_risk_score)", "count(max_risk_score)")} as avg_str_risk_score, max(max_risk_score) as max_str_risk_score,
  count(*) filter (str_confidence_level = 'HIGH') as high_confidence_strs,
  count(*) filter (str_confidence_level = 'MEDIUM') as medium_confidence_strs
from suspicious group by branch_code
""",
)
_METRICS = (
    "unique_customers high_risk_customers medium_risk_customers low_risk_customers pep_customers kyc_exceptions "
    "stale_kyc_customers avg_customer_risk_score ctr_count ctr_value_php ctr_inbound_count ctr_outbound_count "
    "ctr_max_amount_php ctr_avg_amount_php ctr_pending_count str_count overdue_strs due_soon_strs pending_strs "
    "avg_str_risk_score max_str_risk_score high_confidence_strs medium_confidence_strs"
).split()
_relation(
    "branch_summary",
    f"""
select *, case when overdue_strs > 0 then 'CRITICAL' when due_soon_strs > 0 then 'AT_RISK'
    when kyc_exceptions > 5 then 'NEEDS_ATTENTION' else 'COMPLIANT' end as branch_compliance_status
from (select b.branch_code, b.branch_name, b.region_name, b.city_municipality, b.province,
        {", ".join(f"coalesce({m}, 0) as {m}" for m in _METRICS)}
      from seed_branches b left join branch_customers c on c.branch_code = b.branch_code
      left join branch_ctr x on x.branch_code = b.branch_code left join branch_str s on s.branch_code = b.branch_code)
""",
)
_relation(
    "numbered",
    """
select txn.*, (select count(*) from (select unnest([date '2026-05-01' + cast(i as integer) for i in range(0, 100)]) as b) w
    where isodow(b) < 6 and b not in (select calendar_date from seed_holidays) and b <= txn_date_ph) as n
from txn where counterparty_account is not null
""",
)
