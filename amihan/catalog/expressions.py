"""Scalar functions and generators on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from amihan.catalog.check_sql import AS_OF, RUN_EPOCH, half_up, key
from amihan.catalog.registry import query
from amihan.functions.calendar import as_of, manila_wall_clock, run_manila
from amihan.functions.keys import surrogate_key
from amihan.functions.masking import mask_ends, mask_tail
from amihan.functions.numeric import cents, rounded_ratio
from amihan.operators.risk import overall, risk_factors

query(
    "fn_upper_trim",
    "txn_id txn_type purpose_description",
    "select txn_id, upper(trim(txn_type)) as txn_type, trim(purpose_description) as purpose_description from raw_txn",
)(
    lambda x: x.raw_transactions.select(
        "txn_id", F.upper(F.trim("txn_type")).alias("txn_type"), F.trim("purpose_description").alias("purpose_description")
    )
)
query(
    "fn_substr_right_concat",
    "customer_id name_mask number_mask",
    "select customer_id, customer_name[1] || '***' || customer_name[-1] as name_mask, "
    "'***' || right(sss_number, 4) as number_mask from cust",
)(
    lambda x: x.customers.select(
        "customer_id",
        mask_ends(F.col("customer_name")).alias("name_mask"),
        mask_tail(F.col("sss_number")).alias("number_mask"),
    )
)
query(
    "fn_position",
    "txn_id place:i",
    "select txn_id, strpos(purpose_description, 'Iran') as place from txn",
)(lambda x: x.transactions.select("txn_id", F.instr("purpose_description", "Iran").alias("place")))
query(
    "fn_like_concat",
    "txn_id names_own_bank",
    "select txn_id, upper(counterparty_bank) like '%' || substring(counterparty_bank, 1, 2) || '%' as names_own_bank from txn",
)(
    lambda x: x.transactions.select(
        "txn_id",
        F.like(
            F.upper("counterparty_bank"), F.concat(F.lit("%"), F.substring("counterparty_bank", 1, 2), F.lit("%"))
        ).alias("names_own_bank"),
    )
)
query(
    "fn_md5_key",
    "txn_id row_key",
    f"select txn_id, {key('txn_id', 'counterparty_bank', 'txn_date_ph')} as row_key from txn",
)(lambda x: x.transactions.select("txn_id", surrogate_key("txn_id", "counterparty_bank", "txn_date_ph").alias("row_key")))
query(
    "fn_decimal_to_text",
    "txn_id amount_text",
    "select txn_id, cast(amount_php as varchar) as amount_text from txn",
)(lambda x: x.transactions.select("txn_id", F.col("amount_php").cast("string").alias("amount_text")))
query(
    "fn_as_of",
    "customer_id snapshot_date:d determined:t run_second:i",
    f"select customer_id, {AS_OF} as snapshot_date, timestamp '2026-06-30 10:00:00' as determined, "
    f"{RUN_EPOCH} as run_second from cust",
)(
    lambda x: x.customers.select(
        "customer_id",
        as_of(x.params).alias("snapshot_date"),
        run_manila(x.params).alias("determined"),
        F.unix_seconds("dbt_loaded_at").alias("run_second"),
    )
)
query(
    "fn_timezone",
    "txn_id txn_ts_ph:e manila:t",
    "select txn_id, txn_ts_ph, make_timestamp(cast((txn_ts_ph + 8 * 3600) * 1000000 as bigint)) as manila from txn",
)(lambda x: x.transactions.select("txn_id", "txn_ts_ph", manila_wall_clock(F.col("txn_ts_ph")).alias("manila")))
query(
    "fn_date_diff",
    "document_id days:i",
    f"select document_id, expiry_date - {AS_OF} as days from docs",
)(lambda x: x.documents.select("document_id", F.datediff("expiry_date", as_of(x.params)).alias("days")))
query(
    "fn_date_interval",
    "customer_id one_year:d three_years:d five_years_ago:d ninety_days:d",
    """
select customer_id, cast(d + interval 1 year as date) as one_year, cast(d + interval 3 years as date) as three_years,
  cast(d - interval 5 years as date) as five_years_ago, d + 90 as ninety_days
from (select customer_id, kyc_last_update_date as d from cust)
""",
)(
    lambda x: x.customers.select(
        "customer_id",
        F.add_months("kyc_last_update_date", 12).alias("one_year"),
        F.add_months("kyc_last_update_date", 36).alias("three_years"),
        F.add_months("kyc_last_update_date", -60).alias("five_years_ago"),
        F.date_add("kyc_last_update_date", 90).alias("ninety_days"),
    )
)
query(
    "fn_date_parts",
    "txn_id y:i m:i q:i d:i dow:i",
    "select txn_id, year(txn_date_ph) as y, month(txn_date_ph) as m, quarter(txn_date_ph) as q, day(txn_date_ph) as d, "
    "dayofweek(txn_date_ph) as dow from txn_history",
)(
    lambda x: x.history.select(
        "txn_id",
        F.year("txn_date_ph").alias("y"),
        F.month("txn_date_ph").alias("m"),
        F.quarter("txn_date_ph").alias("q"),
        F.dayofmonth("txn_date_ph").alias("d"),
        (F.dayofweek("txn_date_ph") - 1).alias("dow"),
    )
)
query(
    "fn_date_id",
    "txn_id date_id:i",
    "select txn_id, cast(strftime(txn_date_ph, '%Y%m%d') as integer) as date_id from txn_history",
)(lambda x: x.history.select("txn_id", F.date_format("txn_date_ph", "yyyyMMdd").cast("int").alias("date_id")))
query(
    "fn_week_trunc",
    "txn_id monday:d",
    "select txn_id, cast(date_trunc('week', txn_date_ph) as date) as monday from txn_history",
)(lambda x: x.history.select("txn_id", F.trunc("txn_date_ph", "week").alias("monday")))
query(
    "fn_round",
    "txn_id thousands:n",
    f"select txn_id, {half_up('amount_php * 100', '100000')} as thousands from txn",
)(
    lambda x: x.transactions.select(
        "txn_id", rounded_ratio(cents(F.col("amount_php")), F.lit(100_000)).alias("thousands")
    )
)


@query(
    "fn_least_divide",
    "customer_id overall_risk_score:i overall_risk_tier",
    "select * from risk",
)
def _fn_least_divide(x):
    score, tier = overall(x.params)
    return x.risk.select("customer_id", score.alias("overall_risk_score"), tier.alias("overall_risk_tier"))


query(
    "fn_coalesce_nullif",
    "txn_id bank other_than_bdo",
    "select txn_id, coalesce(counterparty_bank, 'NONE') as bank, nullif(counterparty_bank, 'BDO') as other_than_bdo from txn",
)(
    lambda x: x.transactions.select(
        "txn_id",
        F.coalesce("counterparty_bank", F.lit("NONE")).alias("bank"),
        F.nullif("counterparty_bank", F.lit("BDO")).alias("other_than_bdo"),
    )
)
query("fn_array_compact", "customer_id risk_factors:a", "select * from risk")(
    lambda x: x.risk.join(x.kyc.select("customer_id", F.col("kyc_completeness_score").alias("_kyc_score")), "customer_id", "left")
    .withColumn("_hits", F.when(F.col("watchlist_risk_score") > 0, 1))
    .select("customer_id", risk_factors().alias("risk_factors"))
)
query(
    "fn_array_any",
    "str_candidate_id has_blacklist",
    "select str_candidate_id, 'JURIS_01' = any(str_indicators) as has_blacklist from candidates",
)(
    lambda x: x.candidates.select(
        "str_candidate_id", F.array_contains("str_indicators", "JURIS_01").alias("has_blacklist")
    )
)
query(
    "fn_cast",
    "txn_id day:d whole:i amount:n text flag",
    "select txn_id, cast(txn_ts_ph as bigint) as whole, cast(to_timestamp(txn_ts_ph + 8 * 3600) as date) as day, "
    "cast(amount_php as decimal(19,4)) as amount, cast(amount_php as varchar) as text, "
    "cast(transaction_direction = 'DEBIT' as boolean) as flag from txn",
)(
    lambda x: x.transactions.select(
        "txn_id",
        manila_wall_clock(F.col("txn_ts_ph")).cast("date").alias("day"),
        F.unix_seconds("txn_ts_ph").cast("long").alias("whole"),
        F.col("amount_php").cast("decimal(19,4)").alias("amount"),
        F.col("amount_php").cast("string").alias("text"),
        (F.col("transaction_direction") == "DEBIT").cast("boolean").alias("flag"),
    )
)


@query(
    "gen_series",
    "customer_id day:d txn_count:i",
    """
select g.customer_id, g.day, count(t.txn_id) as txn_count
from (select customer_id, cast(unnest(generate_series(min(txn_date_ph), max(txn_date_ph), interval 1 day)) as date) as day
      from txn group by customer_id) g
left join txn t on t.customer_id = g.customer_id and t.txn_date_ph = g.day group by all
""",
)
def _gen_series(x):
    """Every day from a customer's first to last transaction with the day's transactions, idle days included."""
    counts = x.transactions.groupBy("customer_id", F.col("txn_date_ph").alias("day")).agg(F.count("*").alias("_n"))
    span = F.sequence(F.min("day"), F.max("day")).alias("days")
    days = counts.groupBy("customer_id").agg(span).select("customer_id", F.explode("days").alias("day"))
    joined = days.join(counts, ["customer_id", "day"], "left")
    return joined.withColumn("txn_count", F.coalesce("_n", F.lit(0)))
