"""Monthly reports and daily monitors."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Report columns and their titles.
CTR_REPORT = {
    "ctr_id": "CTR ID",
    "customer_id": "Customer ID",
    "branch_code": "Branch",
    "txn_date_ph": "Txn Date",
    "amount_php": "Amount (PHP)",
    "ctr_type": "Type",
    "filing_status": "Status",
    "filing_date": "Filed Date",
}
STR_REPORT = {
    "str_id": "STR ID",
    "customer_id": "Customer ID",
    "branch_code": "Branch",
    "str_determination_ts": "Determination Date",
    "max_risk_score": "Risk Score",
    "indicator_count": "Indicators",
    "filing_status": "Status",
    "filing_urgency": "Urgency",
}


def _in_month(column: Column, kind: str, year: int, month: int) -> Column:
    """A half-open range, which prunes files where a year/month test would not."""
    after = date(year + month // 12, month % 12 + 1, 1)
    return (column >= F.lit(str(date(year, month, 1))).cast(kind)) & (column < F.lit(str(after)).cast(kind))


def ctr_monthly(covered: DataFrame, year: int, month: int) -> DataFrame:
    """The month's covered transactions, newest first."""
    rows = covered.filter(_in_month(F.col("txn_date_ph"), "date", year, month))
    ordered = rows.orderBy(F.desc("txn_date_ph"), "ctr_id")
    return ordered.select(*[F.col(c).alias(title) for c, title in CTR_REPORT.items()])


def str_monthly(suspicious: DataFrame, year: int, month: int) -> DataFrame:
    """The suspicious transactions determined in the month, newest first."""
    rows = suspicious.filter(_in_month(F.col("str_determination_ts"), "timestamp_ntz", year, month))
    ordered = rows.orderBy(F.desc("str_determination_ts"), "str_id")
    return ordered.select(*[F.col(c).alias(title) for c, title in STR_REPORT.items()])


def report_path(root: str, kind: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/{year}/{month:02d}/{kind}_report_{year}{month:02d}.csv"


def write_csv_report(report: DataFrame, path: str) -> str:
    """Write a sorted report as CSV with a header.

    The path is a folder of part files in report order: a report of any size
    is written by all tasks, never gathered into one.
    """
    report.write.mode("overwrite").option("header", True).csv(path)
    return path


def report_summary(
    ctr: DataFrame, suspicious: DataFrame, root: str, year: int, month: int
) -> DataFrame:
    """Month, report paths and row counts in one row."""
    counts = [
        report.agg(F.count("*").alias("row_count")).select(
            F.lit(f"{year}{month:02d}").alias("report_month"),
            F.lit(kind).alias("report"),
            F.lit(report_path(root, kind, year, month)).alias("path"),
            "row_count",
        )
        for kind, report in (("ctr", ctr), ("str", suspicious))
    ]
    return counts[0].unionByName(counts[1])


def rows_per_day(fact: DataFrame, column: str) -> DataFrame:
    """Rows of a fact per day, newest first."""
    return (
        fact.groupBy(F.col(column).cast("date").alias("day"))
        .agg(F.count("*").alias("row_count"))
        .orderBy(F.desc("day"))
    )
