"""Data-quality checks as registered queries.

The landing data of the star mapping has unique keys, so that check also runs
on columns known to repeat.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.catalog.registry import query
from amihan.operators import quality as dq
from amihan.session import run_folder

_SQL_NAMES = {
    "stg_transactions": "txn",
    "stg_customers": "cust",
    "stg_kyc_documents": "docs",
    "stg_watchlist": "screening",
    "raw_transactions": "raw_txn",
    "raw_customers": "raw_cust",
    "raw_kyc_documents": "raw_docs",
    "raw_watchlist_screening": "raw_screening",
}


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _each(mapping):
    for table, columns in mapping.items():
        for column in columns:
            yield table, column


def _unexpected_sql(expected) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, {c} as value, count(*) as n from {_SQL_NAMES[t]} "
        f"where {c} not in {_list(expected[t][c])} group by {c}"
        for t, c in _each(expected)
    )


def _unique_sql(pairs) -> str:
    return " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, cast({c} as varchar) as value, count(*) as n "
        f"from {_SQL_NAMES[t]} where {c} is not null group by {c} having count(*) > 1"
        for t, c in pairs
    )


# Beside the declared keys: columns known to repeat.
_UNIQUE_PAIRS = [*_each(dq.UNIQUE), ("stg_kyc_documents", "customer_id"), ("stg_transactions", "counterparty_account")]


@query("dq_unique", "table_name column_name value n:i", _unique_sql(_UNIQUE_PAIRS))
def _dq_unique(x):
    parts = [
        dq.duplicated(x.bronze[t], c).select(
            F.lit(t).alias("table_name"),
            F.lit(c).alias("column_name"),
            F.col(c).cast("string").alias("value"),
            F.col("occurrences").alias("n"),
        )
        for t, c in _UNIQUE_PAIRS
    ]
    return reduce(DataFrame.unionByName, parts)


# Beside the declared columns: columns known to hold NULL.
_NOT_NULL = {
    **dq.NOT_NULL,
    "stg_transactions": (*dq.NOT_NULL["stg_transactions"], "counterparty_bank"),
    "stg_kyc_documents": (*dq.NOT_NULL["stg_kyc_documents"], "expiry_date"),
}


query(
    "dq_not_null",
    "table_name column_name failures:i",
    " union all ".join(
        f"select '{t}' as table_name, '{c}' as column_name, count(*) as failures from {_SQL_NAMES[t]} where {c} is null"
        for t, c in _each(_NOT_NULL)
    ),
)(lambda x: dq.null_rows(x.bronze, _NOT_NULL))
# The declared lists, and one narrower than the data so that something is found.
_NARROWED = {
    **dq.ACCEPTED_VALUES,
    "stg_transactions": {**dq.ACCEPTED_VALUES["stg_transactions"], "txn_type": ("CASH", "RTGS")},
}
query(
    "dq_accepted_values",
    "table_name column_name value n:i",
    _unexpected_sql(_NARROWED),
)(
    lambda x: dq.unexpected_values(x.bronze, _NARROWED)
)
query(
    "dq_accepted_range",
    "screening_id match_confidence_pct:n",
    "select * from screening where match_confidence_pct < 0 or match_confidence_pct > 100",
)(
    lambda x: dq.out_of_range(
        x.screening, "match_confidence_pct", *dq.ACCEPTED_RANGE["stg_watchlist"]["match_confidence_pct"]
    )
)
query(
    "dq_check_enum",
    "table_name column_name value n:i",
    _unexpected_sql(dq.LANDING_VALUES),
)(lambda x: dq.unexpected_values(x.landing, dq.LANDING_VALUES))


_CHILD_IDS = {"raw_kyc_documents": "document_id", "raw_watchlist_screening": "screening_id"}


@query(
    "dq_foreign_key",
    "table_name row_id customer_id",
    " union all ".join(
        f"select '{t}' as table_name, {c} as row_id, customer_id from {_SQL_NAMES[t]} "
        "where customer_id not in (select customer_id from raw_cust)"
        for t, c in _CHILD_IDS.items()
    ),
)
def _dq_foreign_key(x):
    """Landing rows of customers that do not exist."""
    parts = [
        dq.orphans(x.landing[t], x.raw_customers, "customer_id").select(
            F.lit(t).alias("table_name"), F.col(c).alias("row_id"), "customer_id"
        )
        for t, c in _CHILD_IDS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _reasons_sql(table: str) -> str:
    rules = [(f"{c}:not_null", f"{c} is null") for c in dq.LANDING_NOT_NULL[table]]
    rules += [(f"{c}:accepted_values", f"{c} not in {_list(v)}") for c, v in dq.LANDING_VALUES[table].items()]
    if table in dq.FOREIGN_KEYS:
        key = dq.FOREIGN_KEYS[table]
        rules.append((f"{key}:foreign_key", f"{key} not in (select customer_id from raw_cust)"))
    found = ", ".join(f"case when {bad} then '{rule}' end" for rule, bad in rules)
    key = {"raw_transactions": "txn_id", "raw_customers": "customer_id", **_CHILD_IDS}[table]
    return (
        f"select '{table}' as table_name, cast({key} as varchar) as row_id, array_to_string([{found}], '|') as reasons "
        f"from {_SQL_NAMES[table]}"
    )


@query(
    "dq_quarantine",
    "table_name row_id reasons n_accepted:i n_rejected:i",
    " union all ".join(
        "select table_name, row_id, reasons, n_rows - n_rejected as n_accepted, n_rejected from "
        f"(select *, count(*) over () as n_rows, count(*) filter (reasons <> '') over () as n_rejected from ({_reasons_sql(t)})) "
        "where reasons <> ''"
        for t in dq.LANDING_VALUES
    ),
)
def _dq_quarantine(x):
    """The rejected rows of each landing table as written, with the counts of the write."""
    parts = []
    for table, df in x.landing.items():
        key = {"raw_transactions": "txn_id", "raw_customers": "customer_id", **_CHILD_IDS}[table]
        split = dq.quarantine(df, table, run_folder(x.spark, "quarantine"), x.raw_customers)
        parts.append(
            split.rejected.select(
                F.lit(table).alias("table_name"),
                F.col(key).alias("row_id"),
                F.array_join("reasons", "|").alias("reasons"),
                F.lit(split.n_accepted).alias("n_accepted"),
                F.lit(split.n_rejected).alias("n_rejected"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _report_sql() -> str:
    def row(table: str, column: str, test: str, count: str) -> str:
        return (
            f"select '{table}' as table_name, '{column}' as column_name, '{test}' as test_name, "
            f"({count}) as failures"
        )

    parts = []
    for t, c in _each(dq.UNIQUE):
        name = _SQL_NAMES[t]
        parts.append(row(t, c, "unique", f"select count(*) from (from {name} select {c} group by {c} having count(*) > 1)"))
    for t, c in _each(dq.NOT_NULL):
        parts.append(row(t, c, "not_null", f"select count(*) from {_SQL_NAMES[t]} where {c} is null"))
    for t, c in _each(dq.ACCEPTED_VALUES):
        bad = f"{c} not in {_list(dq.ACCEPTED_VALUES[t][c])}"
        parts.append(row(t, c, "accepted_values", f"select count(distinct {c}) from {_SQL_NAMES[t]} where {bad}"))
    for t, c in _each(dq.ACCEPTED_RANGE):
        low, high = dq.ACCEPTED_RANGE[t][c]
        parts.append(row(t, c, "accepted_range", f"select count(*) from {_SQL_NAMES[t]} where {c} < {low} or {c} > {high}"))
    return " union all ".join(parts)


query("dq_report", "table_name column_name test_name failures:i", _report_sql())(lambda x: dq.dq_report(x.bronze))
