"""Joining rows to per-group facts when one group may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A group above this number of rows is split into parts of about it.
ROWS_PER_SPLIT = 2_000_000


def hot_groups(
    groups: DataFrame, keys: Sequence[str], size: str, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """All groups above a size with the number of parts each is to be split into.

    There are at most as many as the rows fill parts; how they reach the
    rows - broadcast or shuffled - Catalyst decides by their measured size.
    """
    parts = F.ceil(F.col(size) / rows_per_split).cast("int").alias("_parts")
    return groups.filter(F.col(size) > rows_per_split).select(*keys, parts)


def join_groups(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    spread: Column,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner join of rows with one fact row per group.

    Without ``hot`` the join is a plain equi join on the group key, which AQE
    splits where a group is oversized (the rows are the streamed side).  With
    ``hot`` (see :func:`hot_groups`) the large groups are salted: their rows
    spread over the parts by a hash of ``spread``, and their fact row is
    repeated once per part.
    """
    keys = list(keys)
    if hot is None:
        return rows.join(groups, keys)
    parts = F.coalesce("_parts", F.lit(1))
    salted_rows = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), parts).cast("int"))
    salted_groups = groups.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), parts - 1))
    )
    joined = salted_rows.drop("_parts").join(salted_groups.drop("_parts"), [*keys, "_salt"])
    return joined.drop("_salt")


def keep_groups(rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread: Column, hot: DataFrame | None = None) -> DataFrame:
    """The rows whose group is among ``groups``, in which keys may repeat; large groups are salted as in :func:`join_groups`."""
    named = groups.select(*keys)
    if hot is None:
        return rows.join(named, list(keys), "left_semi")
    return join_groups(rows, named.distinct(), keys, spread, hot).select(*rows.columns)
