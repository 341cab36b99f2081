"""The opt-in rules as registered queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from amihan.catalog.check_sql import AS_OF
from amihan.catalog.detections import LAYERING, SIGNAL
from amihan.catalog.registry import query
from amihan.functions.scoring import kyc_points
from amihan.operators import extensions as ext
from amihan.operators import signals
from amihan.operators.kyc import int_kyc_health
from amihan.operators.layering import int_layering_detection
from amihan.plans.dimensions import masked_customers

EXTRA_SIGNAL = "customer_id txn_id branch_code txn_date_ph:d indicator_code signal_risk_score:i signal_detail"

query("layering_net_intent", LAYERING, "select * from layering_intent where is_layering_pattern")(
    lambda x: int_layering_detection(x.transactions, x.params, signed_net=True).filter("is_layering_pattern")
)
query(
    "signal_dormancy",
    EXTRA_SIGNAL,
    """
select t.customer_id, t.txn_id, t.branch_code, t.txn_date_ph, 'DORMANCY_01' as indicator_code, 60 as signal_risk_score,
  cast(t.txn_date_ph - p.before as varchar) as signal_detail
from txn_history t join (select distinct a.txn_id, max(b.txn_date_ph) as before from txn_history a
    join txn_history b on b.customer_id = a.customer_id and b.txn_date_ph < a.txn_date_ph group by a.txn_id) p
  on p.txn_id = t.txn_id
where t.transaction_direction = 'CREDIT' and t.amount_php >= 100000 and t.txn_date_ph - p.before >= 90
""",
)(lambda x: ext.signal_dormancy(x.history, x.params))
query(
    "signal_smurfing",
    EXTRA_SIGNAL,
    """
select customer_id, txn_id, branch_code, txn_date_ph, 'PATTERN_01' as indicator_code, 80 as signal_risk_score,
  cast(depositors as varchar) as signal_detail
from (select t.*, (select count(distinct u.customer_id) from numbered u where u.counterparty_account = t.counterparty_account
        and u.n between t.n - 2 and t.n) as depositors from numbered t)
where depositors >= 3
""",
)(lambda x: ext.signal_smurfing(x.transactions, x.params, x.seeds.holidays))
query(
    "signal_kyc",
    EXTRA_SIGNAL,
    """
select customer_id, txn_id, txn.branch_code, txn_date_ph, 'KYC_DEFICIENCY' as indicator_code, 40 as signal_risk_score,
  cast(null as varchar) as signal_detail
from txn where customer_id in (select customer_id from kyc where points < 80)
""",
)(
    lambda x: ext.signal_flagged_customers(
        x.transactions,
        int_kyc_health(x.customers, x.documents, x.params, hundred_scale=True).filter("kyc_exception"),
        "KYC_DEFICIENCY",
        40,
    )
)
query(
    "signal_watchlist",
    EXTRA_SIGNAL,
    """
select customer_id, txn_id, txn.branch_code, txn_date_ph, 'WATCHLIST_MATCH' as indicator_code, 50 as signal_risk_score,
  cast(null as varchar) as signal_detail
from txn where customer_id in (select customer_id from screening where is_potential_match)
""",
)(
    lambda x: ext.signal_flagged_customers(
        x.transactions, x.screening.filter("is_potential_match"), "WATCHLIST_MATCH", 50
    )
)
query(
    "kyc_score_100",
    "customer_id kyc_completeness_score:n kyc_exception kyc_health_risk_score:i",
    """
select customer_id, points as kyc_completeness_score, points < 80 as kyc_exception,
  case when points < 60 then 40 when points < 80 then 25 when points < 90 then 15 else 5 end as kyc_health_risk_score
from kyc
""",
)(
    lambda x: int_kyc_health(x.customers, x.documents, x.params, hundred_scale=True).withColumn(
        "kyc_health_risk_score", kyc_points(F.col("kyc_completeness_score"))
    )
)
query("fatf_active_exact", SIGNAL, "select * from sig_fatf_active")(
    lambda x: signals.signal_fatf(x.transactions, x.customers, x.seeds.jurisdictions, x.params, active_only=True)
)


@query(
    "scd2_customers",
    "customer_id risk_tier valid_from:d valid_to:d is_current",
    f"""
with old as (select customer_id, if(account_status in ('DORMANT', 'CLOSED'), 'HIGH', risk_tier) as risk_tier from cust
    where nationality <> 'KP'),
  now as (select customer_id, risk_tier from cust)
select customer_id, old.risk_tier, date '2025-01-01' as valid_from,
  if(old.risk_tier <> now.risk_tier, {AS_OF}, null) as valid_to, old.risk_tier = now.risk_tier as is_current
from old join now using (customer_id)
union all
select customer_id, now.risk_tier, {AS_OF}, null, true from now left join old using (customer_id)
where old.risk_tier is distinct from now.risk_tier
""",
)
def _scd2_customers(x):
    """History in which some tiers were different and some customers unknown."""
    snapshot = masked_customers(x.customers)
    history = (
        snapshot.filter("nationality <> 'KP'")
        .withColumn(
            "risk_tier",
            F.when(F.col("account_status").isin("DORMANT", "CLOSED"), "HIGH").otherwise(F.col("risk_tier")),
        )
        .withColumns(
            {
                "valid_from": F.lit(date(2025, 1, 1)),
                "valid_to": F.lit(None).cast("date"),
                "is_current": F.lit(True),
            }
        )
    )
    return ext.scd2_customers(history, snapshot, x.params)


query(
    "retention_filter",
    "txn_id txn_date_ph:d",
    "select * from txn_history where txn_date_ph >= date '1997-06-30' union all by name select * from txn",
)(
    lambda x: ext.retention_filter(
        x.history.unionByName(x.transactions), x.params_at(retention_years=29)
    )
)
