"""Landing tables in Parquet, one folder per table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.schemas import RAW
from amihan.sources import published


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One landing table with its declared columns, published or a plain folder.

    The schema is declared, so nothing is inferred; Catalyst prunes columns
    and pushes filters into the scan.
    """
    landed = published.read(spark, f"{root.rstrip('/')}/{name}")
    if landed is not None:
        return scan(landed, name)
    return spark.read.schema(RAW[name]).parquet(f"{root.rstrip('/')}/{name}")


def scan(df: DataFrame, name: str) -> DataFrame:
    """The declared columns of a landing table, in declared order."""
    return df.select(*RAW[name].fieldNames())


def with_year(transactions: DataFrame) -> DataFrame:
    """Add the partition column of the transaction table."""
    return transactions.withColumn("txn_year", F.year("txn_date_ph"))


def read_transactions_between(spark: SparkSession, path: str, first: date, last: date) -> DataFrame:
    """Transactions of a date range from a year-partitioned table.

    The year predicate prunes folders; the date predicate prunes row groups.
    """
    return published.read(spark, path).filter(
        F.col("txn_year").between(first.year, last.year) & F.col("txn_date_ph").between(first, last)
    )
