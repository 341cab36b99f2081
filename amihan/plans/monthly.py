"""The monthly run: two reports of a month and a summary of what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.plans import reports
from amihan.sources import published

#: The fact, its report and the kind in the report's name.
REPORTS = {
    "ctr": ("fct_covered_transactions", reports.ctr_monthly),
    "str": ("fct_suspicious_transactions", reports.str_monthly),
}


def run_monthly(spark: SparkSession, mart_root: str, report_root: str, year: int, month: int) -> DataFrame:
    """Write both reports of a month from the published facts; month, paths and row counts.

    The counts are of the files as written, read back by their header.  The
    summary is written last, so a month with a summary has both reports.
    """
    parts = []
    for kind, (fact, build) in REPORTS.items():
        rows = published.read(spark, f"{mart_root.rstrip('/')}/gold/{fact}")
        if rows is None:
            raise ValueError(f"{fact} has not been published below {mart_root}")
        report = build(rows, year, month)
        path = reports.write_csv_report(report, reports.report_path(report_root, kind, year, month))
        schema = ", ".join(f"`{c}` string" for c in report.columns)
        written = spark.read.schema(schema).option("header", True).csv(path)
        parts.append(
            written.agg(F.count("*").alias("row_count")).select(
                F.lit(f"{year}{month:02d}").alias("report_month"), F.lit(kind).alias("report"), F.lit(path).alias("path"), "row_count"
            )
        )
    summary = parts[0].unionByName(parts[1])
    return published.publish(summary.coalesce(1), f"{report_root.rstrip('/')}/{year}/{month:02d}/summary")
