"""The landing run: batches in, checked and without conflicts, into the landing tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from amihan.operators.quality import Split, quarantine
from amihan.schemas import PRIMARY_KEYS, RAW
from amihan.sources import published
from amihan.sources.raw import scan
from amihan.sources.sinks import append_ignore_conflict, merge_customers, one_per_key, overwrite_table


@dataclass(frozen=True)
class Landed:
    """The landing tables after a load, and what became of its batches."""

    tables: Mapping[str, DataFrame]
    splits: Mapping[str, Split]


def run_landing(spark: SparkSession, batches: Mapping[str, DataFrame], root: str, load: str) -> Landed:
    """Bring batches, by landing table, into the tables below ``root``.

    Customers come first, as the others refer to them: known ones change
    three columns, new ones are added.  Of the other tables a row whose
    primary key is known, or repeats in the batch, is passed over.  Rows that
    break a declared rule go to ``quarantine/<table>/<load>`` with their
    reasons.  Every table is published whole, so a load that died can be
    started again under its name and adds nothing twice.
    """
    unknown = batches.keys() - RAW.keys()
    if unknown:
        raise ValueError(f"no landing tables: {', '.join(sorted(unknown))}")
    root = root.rstrip("/")
    tables: dict[str, DataFrame] = {}
    splits: dict[str, Split] = {}

    def split(name: str, parents: DataFrame | None = None) -> DataFrame:
        splits[name] = quarantine(scan(batches[name], name), name, f"{root}/quarantine/{name}/{load}", parents)
        return splits[name].accepted

    name = "raw_customers"
    known = published.read(spark, f"{root}/{name}")
    if name in batches:
        new = split(name)
        merged = merge_customers(known, new) if known is not None else one_per_key(new, PRIMARY_KEYS[name])
        known = overwrite_table(merged, f"{root}/{name}")
    if known is not None:
        tables[name] = known
    for name in RAW.keys() - {"raw_customers"}:
        path = f"{root}/{name}"
        if name in batches:
            # Without any customer there is nothing to refer to: every key is an orphan.
            parents = known if known is not None else spark.createDataFrame([], RAW["raw_customers"])
            rows = split(name, parents)
            tables[name] = append_ignore_conflict(rows, path, PRIMARY_KEYS[name], by_year=name == "raw_transactions")
        elif (table := published.read(spark, path)) is not None:
            tables[name] = table
    return Landed(tables, splits)
