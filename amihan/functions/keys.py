"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.session import ensure_checkpoint_dir

# Fixed value: the text that stands for NULL in a hashed key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the columns as text, joined with '-'; NULL has its own text."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_KEY_TEXT)) for c in parts]))


def with_dense_key(df: DataFrame, order_by: str, name: str) -> DataFrame:
    """Number the rows 1..n in ``order_by`` order without a one-task window.

    Only the key column is sorted: a global sort leaves ordered ranges in the
    partitions, and a key takes its place within its partition plus the keys
    of all earlier ones.  The sorted keys are checkpointed, so that both
    readings below see one and the same partitioning even when executors are
    lost in between; whole rows join their number by the key when they are
    read.  Keys are unique and not null.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.select(F.col(order_by).alias("_key"))
    placed = keys.orderBy("_key").withColumn("_place", F.monotonically_increasing_id()).checkpoint()
    placed = placed.withColumn("_part", F.shiftright("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND((1 << 33) - 1)
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    # One row per sort partition: the broadcast is bounded by their number.
    numbered = placed.join(F.broadcast(offsets), "_part").select(
        "_key", (F.col("_offset") + F.col("_place") + 1).cast("long").alias("_number")
    )
    return df.join(numbered, F.col(order_by) == F.col("_key")).select(F.col("_number").alias(name), *[df[c] for c in df.columns])
