"""Sinks: how result rows reach Parquet tables.

Every table is published (see ``published``): a run that dies half-way leaves
the former table, and a table may be rebuilt from itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.sources import published
from amihan.sources.raw import with_year

# The columns an incoming customer may change.
UPSERT_COLUMNS = ("customer_name", "risk_tier", "kyc_last_update_date")


#: Transactions of one file of a year.
ROWS_PER_FILE = 5_000_000


def overwrite_table(df: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table; ``cluster_by`` sorts within files for min/max pruning."""
    return published.publish(df, path, cluster_by)


def one_per_key(df: DataFrame, keys: Sequence[str], order: str | None = None, last: bool = False) -> DataFrame:
    """One row per key: the first, or the last, by the order column of a load sequence.

    Without such a column it is the smallest row, so that a retried task
    chooses the same; rows of one place in the order are told apart that way.

    The minimum is combined before the shuffle, so a key repeated in a third
    of all rows sends one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    leading = [order] if order else []
    whole = F.struct(*leading, *[c for c in others if c not in leading])
    return (
        df.groupBy(*keys)
        .agg((F.max if last else F.min)(whole).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def rows_with_new_keys(new: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """The rows of ``new`` whose key is not in ``existing``."""
    if existing is None:
        return new
    return new.join(existing.select(*keys), list(keys), "left_anti")


def append_new_only(new: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Append one row for each unknown key; known keys keep their first row."""
    fresh = rows_with_new_keys(one_per_key(new, keys), published.read(new.sparkSession, path), keys)
    return published.append(fresh.select(*new.columns), path)


def _on_dates_of(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The rows of a year-partitioned table within the date range of a batch.

    The key holds the date, so older rows cannot conflict: a daily batch
    reads the keys of its own days, not of the whole history.
    """
    first, last = batch.agg(F.min("txn_date_ph"), F.max("txn_date_ph")).first()
    if first is None:
        return table.filter(F.lit(False))
    return table.filter(
        F.col("txn_year").between(first.year, last.year) & F.col("txn_date_ph").between(first, last)
    )


def append_ignore_conflict(
    batch: DataFrame, path: str, keys: Sequence[str], by_year: bool = False, order: str | None = None
) -> DataFrame:
    """Append a batch, leaving out rows whose primary key exists or repeats.

    ``by_year`` is for transactions, whose key is id and date.  Of a key
    repeated in the batch the first row by ``order`` stays; the order column
    is not stored.
    """
    existing = published.read(batch.sparkSession, path)
    if by_year and existing is not None:
        existing = _on_dates_of(existing, batch)
    stored = [c for c in batch.columns if c != order]
    fresh = rows_with_new_keys(one_per_key(batch, keys, order), existing, keys).select(*stored)
    if by_year:
        return published.append(_by_year(fresh), path, ["txn_date_ph"], "txn_year", ROWS_PER_FILE)
    return published.append(fresh, path)


def merge_customers(current: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """Upsert customers: known ones change three columns only, new ones are added.

    ``current`` holds one row per customer.  Of a customer repeated in
    ``incoming`` the last row by ``order`` gives the three columns and the
    first one the others.
    """
    is_known = F.col("cur._known").isNotNull()
    is_incoming = F.col("inc._known").isNotNull()
    old_rows = current.withColumn("_known", F.lit(True)).alias("cur")
    new_rows = one_per_key(incoming, ["customer_id"], order)
    if order:
        last = one_per_key(incoming, ["customer_id"], order, last=True).select("customer_id", *UPSERT_COLUMNS)
        new_rows = new_rows.drop(*UPSERT_COLUMNS).join(last, "customer_id")
    new_rows = new_rows.withColumn("_known", F.lit(True)).alias("inc")
    joined = old_rows.join(new_rows, F.col("cur.customer_id") == F.col("inc.customer_id"), "full_outer")

    def pick(name: str):
        old, new = F.col(f"cur.{name}"), F.col(f"inc.{name}")
        if name in UPSERT_COLUMNS:
            return F.when(is_incoming, new).otherwise(old).alias(name)
        return F.when(is_known, old).otherwise(new).alias(name)

    return joined.select(*[pick(c) for c in current.columns])


def _by_year(transactions: DataFrame) -> DataFrame:
    """Rows dealt by year: small years come together in one task, large ones are split, by their bytes."""
    return with_year(transactions).hint("rebalance", F.col("txn_year"))


def write_by_year(transactions: DataFrame, path: str) -> DataFrame:
    """Write transactions in one folder per year.

    Adaptive execution deals the rows so that a year has few files of bounded
    size and no task gathers a whole one.  Files are sorted by date, so that
    row groups can be skipped.
    """
    return published.publish(_by_year(transactions), path, ["txn_date_ph"], "txn_year", ROWS_PER_FILE)


def replace_years(transactions: DataFrame, path: str) -> DataFrame:
    """Replace the years that occur in the rows; all other years keep their files."""
    return published.replace_partitions(_by_year(transactions), path, "txn_year", ["txn_date_ph"], ROWS_PER_FILE)


def merge_late(late: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Put late or corrected transactions into their years: a row replaces that of its key.

    Only the years of the batch are read and written.  A corrected row that
    moves to another year is another key, as the key holds the date.
    """
    table = published.read(late.sparkSession, path)
    if table is None:
        return write_by_year(one_per_key(late, keys), path)
    # A batch touches few years; a year is one folder.
    years = [r[0] for r in with_year(late).select("txn_year").distinct().collect()]
    kept = rows_with_new_keys(table.where(F.col("txn_year").isin(years)).drop("txn_year"), late, keys)
    return replace_years(kept.unionByName(one_per_key(late, keys).select(*kept.columns)), path)
