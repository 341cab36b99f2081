"""Running totals inside groups of which one may hold most of the rows.

A window over a group sorts the whole group in one task.  Here rows are sorted
by ranges of group and order, so a large group lies in many ranges; each range
sums its part, and what earlier ranges hold of the same group is added.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.session import run_folder


def with_running_totals(rows: DataFrame, keys: Sequence[str], order_by: str, totals: Mapping[str, Column]) -> DataFrame:
    """Adds, by name, the sum of a column over the rows of the group up to and with each row.

    ``order_by`` tells the rows of a group apart.  Null keys are a group of
    their own.  The ranges are stored, so both readings see the same ones
    when executors are lost; a range is never one task's burden beyond the
    size that the session's shuffle partitions give it.
    """
    spark = rows.sparkSession
    path = run_folder(spark, "running")
    valued = rows.withColumns({f"_value_{name}": value for name, value in totals.items()})
    valued.repartitionByRange(*keys, order_by).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    # A row for each group and range; only groups that go on from an earlier range matter.
    parts = ranged.groupBy("_range", *keys).agg(*[F.sum(f"_value_{n}").alias(f"_part_{n}") for n in totals])
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(
        F.col("_range").alias("_r"),
        F.struct(*keys).alias("_k"),
        *[F.sum(f"_part_{n}").over(earlier).alias(f"_before_{n}") for n in totals],
        F.lag("_range").over(Window.partitionBy(*keys).orderBy("_range")).isNotNull().alias("_goes_on"),
    ).where("_goes_on")
    inside = Window.partitionBy("_range", *keys).orderBy(order_by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumns({f"_inside_{n}": F.sum(f"_value_{n}").over(inside) for n in totals})
    same = (F.col("_range") == F.col("_r")) & F.struct(*keys).eqNullSafe(F.col("_k"))
    joined = summed.join(before, same, "left")
    zero = F.lit(0)
    added = [(F.coalesce(f"_before_{n}", zero) + F.coalesce(f"_inside_{n}", zero)).alias(n) for n in totals]
    return joined.select(*[c for c in rows.columns if c not in totals], *added)
