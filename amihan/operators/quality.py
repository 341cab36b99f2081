"""Data-quality checks on the bronze and landing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from amihan.sources import published

# ---------------------------------------------------------------------------
# The declared checks.
# ---------------------------------------------------------------------------
UNIQUE = {
    "stg_transactions": ("txn_id",),
    "stg_customers": ("customer_id",),
    "stg_kyc_documents": ("document_id",),
    "stg_watchlist": ("screening_id",),
}
NOT_NULL = {
    "stg_transactions": ("txn_id", "customer_id", "txn_date_ph", "amount_php", "txn_type", "currency_code"),
    "stg_customers": ("customer_id", "is_pep", "account_opened_date"),
    "stg_kyc_documents": ("document_id", "customer_id", "issue_date", "is_expired"),
    "stg_watchlist": ("screening_id", "customer_id", "screening_date"),
}
ACCEPTED_VALUES = {
    "stg_transactions": {"transaction_direction": ("DEBIT", "CREDIT")},
    "stg_customers": {
        "customer_type": ("INDIVIDUAL", "CORPORATE", "SOLEPROPRIETOR", "NGO", "GOVERNMENT"),
        "risk_tier": ("LOW", "MEDIUM", "HIGH"),
        "account_status": ("ACTIVE", "DORMANT", "CLOSED", "RESTRICTED", "FROZEN"),
    },
    "stg_kyc_documents": {
        "document_type": (
            "PASSPORT",
            "NATIONAL_ID",
            "DRIVERS_LICENSE",
            "POSTAL_ID",
            "SENIOR_CITIZEN_ID",
            "PWD_ID",
            "BIRTH_CERTIFICATE",
        )
    },
    "stg_watchlist": {
        "watchlist_source": (
            "AMLC_LIST",
            "UN_SANCTIONS",
            "OFAC_SDN",
            "EU_CONSOLIDATED_LIST",
            "INTERNAL_BLACKLIST",
        ),
        "match_status": ("NO_MATCH", "POSSIBLE_MATCH", "CONFIRMED_MATCH", "FALSE_POSITIVE"),
    },
}
ACCEPTED_RANGE = {"stg_watchlist": {"match_confidence_pct": (0, 100)}}
LANDING_VALUES = {
    "raw_transactions": {
        "txn_type": ("CASH", "RTGS", "PESONet", "InstaPay"),
        "txn_channel": ("BRANCH", "ATM", "ONLINE", "MOBILE"),
        "transaction_direction": ("DEBIT", "CREDIT"),
    },
    "raw_customers": {
        "customer_type": ("INDIVIDUAL", "CORPORATE", "SOLEPROPRIETOR", "NGO"),
        "risk_tier": ("HIGH", "MEDIUM", "LOW"),
        "account_status": ("ACTIVE", "DORMANT", "RESTRICTED", "CLOSED", "FROZEN"),
        "customer_segment": ("RETAIL", "SME", "CORPORATE"),
    },
    "raw_kyc_documents": {"document_type": ("PASSPORT", "NATIONAL_ID", "DRIVERS_LICENSE", "POSTAL_ID")},
    "raw_watchlist_screening": {
        "watchlist_source": ("AMLC", "UN_SANCTIONS", "OFAC_SDN", "INTERNAL_BLACKLIST"),
        "match_status": ("CONFIRMED_MATCH", "POSSIBLE_MATCH", "FALSE_POSITIVE", "NO_MATCH"),
    },
}
LANDING_NOT_NULL = {
    "raw_transactions": (
        "txn_id",
        "customer_id",
        "branch_code",
        "txn_date_ph",
        "txn_time_ph",
        "txn_type",
        "txn_channel",
        "transaction_direction",
        "amount_local",
        "currency_code",
        "amount_php",
    ),
    "raw_customers": (
        "customer_id",
        "customer_name",
        "customer_type",
        "is_pep",
        "risk_tier",
        "account_status",
        "account_opened_date",
        "branch_code",
    ),
    "raw_kyc_documents": ("document_id", "customer_id", "document_type", "document_number", "issue_date"),
    "raw_watchlist_screening": ("screening_id", "customer_id", "screening_date", "watchlist_source", "match_status"),
}
FOREIGN_KEYS = {"raw_kyc_documents": "customer_id", "raw_watchlist_screening": "customer_id"}


@dataclass(frozen=True)
class TableChecks:
    not_null: Sequence[str] = ()
    accepted: Mapping[str, Sequence[str]] = None
    ranges: Mapping[str, tuple[float, float]] = None


def _not_in(column: str, values: Sequence[str]) -> Column:
    """True for a value outside the list; NULL passes."""
    return F.coalesce(~F.col(column).isin(*values), F.lit(False))


def _outside(column: str, low: float, high: float) -> Column:
    return F.coalesce((F.col(column) < low) | (F.col(column) > high), F.lit(False))


def _failures(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def row_checks(df: DataFrame, table: str, checks: TableChecks) -> DataFrame:
    """All per-row checks of a table in one pass.

    Rows are first grouped by the checked enumeration columns, whose
    combinations are few; the null and range failures are counted on the
    way.  From these groups the distinct bad values follow.
    """
    accepted, ranges = checks.accepted or {}, checks.ranges or {}
    tests = {(c, "not_null"): _failures(F.col(c).isNull()) for c in checks.not_null}
    tests |= {(c, "accepted_range"): _failures(_outside(c, *limits)) for c, limits in ranges.items()}
    slots = {key: f"_t{i}" for i, key in enumerate(tests)}
    counted = [test.alias(slots[key]) for key, test in tests.items()]
    groups = df.groupBy(*accepted).agg(*counted) if counted else df.select(*accepted).distinct()
    totals = {key: F.coalesce(F.sum(slots[key]), F.lit(0)) for key in tests}
    totals |= {
        (c, "accepted_values"): F.countDistinct(F.when(_not_in(c, values), F.col(c)))
        for c, values in accepted.items()
    }
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(test).alias("test_name"),
                total.cast("long").alias("failures"),
            )
            for (column, test), total in totals.items()
        ]
    )
    return groups.agg(rows.alias("_rows")).select(F.inline("_rows"))


def duplicated(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULL is not counted."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def _unique_check(df: DataFrame, table: str, column: str) -> DataFrame:
    return duplicated(df, column).agg(F.count("*").alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit("unique").alias("test_name"),
        "failures",
    )


def dq_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared check of the bronze tables, with its failures."""
    parts = []
    for table, df in tables.items():
        parts.append(
            row_checks(
                df,
                table,
                TableChecks(
                    NOT_NULL.get(table, ()), ACCEPTED_VALUES.get(table, {}), ACCEPTED_RANGE.get(table, {})
                ),
            )
        )
        parts += [_unique_check(df, table, c) for c in UNIQUE.get(table, ())]
    return reduce(DataFrame.unionByName, parts)


def landing_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared value list and foreign key of the landing tables, with its failures.

    Lists count different unknown values, foreign keys the rows without a parent.
    """
    parts = [row_checks(tables[t], t, TableChecks(accepted=LANDING_VALUES[t])) for t in LANDING_VALUES]
    for table, key in FOREIGN_KEYS.items():
        lost = orphan_keys(tables[table], tables["raw_customers"], key)
        rows = tables[table].groupBy(key).agg(F.count("*").alias("_n")).join(lost, key, "left_semi")
        parts.append(
            rows.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("failures")).select(
                F.lit(table).alias("table_name"),
                F.lit(key).alias("column_name"),
                F.lit("foreign_key").alias("test_name"),
                "failures",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def unexpected_values(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Mapping[str, Sequence[str]]]
) -> DataFrame:
    """Table, column, value and rows of every value outside its list."""
    parts = []
    for table, columns in expected.items():
        for column, values in columns.items():
            parts.append(
                tables[table]
                .filter(_not_in(column, values))
                .groupBy(F.col(column).alias("value"))
                .agg(F.count("*").alias("n"))
                .select(F.lit(table).alias("table_name"), F.lit(column).alias("column_name"), "value", "n")
            )
    return reduce(DataFrame.unionByName, parts)


def null_rows(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with NULL per declared column, one pass per table."""
    parts = [row_checks(tables[table], table, TableChecks(not_null=names)) for table, names in columns.items()]
    return reduce(DataFrame.unionByName, parts)


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.filter(_outside(column, low, high))


def landing_split(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined) landing rows by the declared value lists."""
    bad = reduce(lambda a, b: a | b, [_not_in(c, v) for c, v in LANDING_VALUES[table].items()])
    return df.filter(~bad), df.filter(bad)


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no parent; NULL keys pass.

    Keys meet the parents once each, so a key with a third of all rows is one
    row of that join; whole rows meet only the keys found without a parent.
    """
    return children.join(orphan_keys(children, parents, key), key, "left_semi").select(*children.columns)


def orphan_keys(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Each key of the children that no parent has."""
    named = children.select(key).where(F.col(key).isNotNull()).distinct()
    return named.join(parents.select(key), key, "left_anti")


def with_reasons(df: DataFrame, table: str, parents: DataFrame | None = None) -> DataFrame:
    """Adds ``reasons``: the declared landing rules that a row breaks, such as ``txn_type:accepted_values``.

    An empty array is a clean row.  Parents are the rows a declared foreign
    key refers to; without them that rule is not tested.
    """
    broken = {f"{c}:not_null": F.col(c).isNull() for c in LANDING_NOT_NULL[table]}
    broken |= {f"{c}:accepted_values": _not_in(c, values) for c, values in LANDING_VALUES[table].items()}
    rows = df
    if parents is not None and table in FOREIGN_KEYS:
        key = FOREIGN_KEYS[table]
        missing = orphan_keys(df, parents, key).select(F.col(key).alias("_missing"))
        rows = df.join(missing, F.col(key) == F.col("_missing"), "left")
        broken[f"{key}:foreign_key"] = F.col("_missing").isNotNull()
    reasons = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in broken.items()]))
    return rows.select(*[rows[c] for c in df.columns], reasons.alias("reasons"))


@dataclass(frozen=True)
class Split:
    """Rows of a landing batch as written, and how many there are of each kind."""

    accepted: DataFrame
    rejected: DataFrame
    n_accepted: int
    n_rejected: int


def quarantine(df: DataFrame, table: str, path: str, parents: DataFrame | None = None) -> Split:
    """Write a batch once, accepted and rejected rows in folders of their own, counted on the way.

    The rejected rows keep their ``reasons``.  The counts come from the write
    itself; they are compared with what can be read back, so a batch is
    either wholly published or an error.
    """
    seen = Observation(f"{table} landing")
    clean = F.size("reasons") == 0
    flagged = with_reasons(df, table, parents).withColumn("accepted", clean)
    counted = flagged.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col("accepted")).alias("accepted"))
    written = published.publish(counted, path, partition_by="accepted")
    counts = seen.get
    found = {r["accepted"]: r["n"] for r in written.groupBy("accepted").agg(F.count("*").alias("n")).collect()}
    n_accepted, n_rejected = counts["accepted"], counts["rows"] - counts["accepted"]
    if (found.get(True, 0), found.get(False, 0)) != (n_accepted, n_rejected):
        raise RuntimeError(f"{table}: {n_accepted} accepted and {n_rejected} rejected rows were written, read back: {found}")
    return Split(
        written.where("accepted").select(*df.columns),
        written.where("not accepted").select(*df.columns, "reasons"),
        n_accepted,
        n_rejected,
    )
