"""How a query is registered and how its columns are shown.

A column list is one text: names with an optional kind after a colon.
Both the Spark result and the check SQL show a kind in the same way:
``i`` whole number, ``n`` double, ``d`` date as text, ``t`` wall-clock time
as text, ``e`` instant as epoch seconds, ``a`` array joined with '|'.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amihan.catalog.check_sql import RELATIONS
from amihan.catalog.lake import Lake, lake

_SPARK_SHOW: dict[str, Callable[[Column], Column]] = {
    "": lambda c: c,
    "i": lambda c: c.cast("long"),
    "n": lambda c: c.cast("double"),
    "d": lambda c: c.cast("string"),
    "t": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"),
    "e": lambda c: F.unix_seconds(c),
    "a": lambda c: F.array_join(c, "|"),
}
_SQL_SHOW = {
    "": "{}",
    "i": "cast({} as bigint)",
    "n": "cast({} as double)",
    "d": "cast({} as varchar)",
    "t": "strftime({}, '%Y-%m-%d %H:%M:%S')",
    "e": "cast({} as bigint)",
    "a": "array_to_string({}, '|')",
}


@dataclass(frozen=True)
class Query:
    build: Callable[[Lake], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(lake(spark, sf_dir))
        return df.select(*[_SPARK_SHOW[kind](F.col(f"`{name}`")).alias(name) for name, kind in self.columns])

    def check_sql(self) -> str | None:
        if self.sql is None:
            return None
        quoted = [(f'"{name}"', kind) for name, kind in self.columns]
        shown = ", ".join(f"{_SQL_SHOW[kind].format(f'q.{name}')} as {name}" for name, kind in quoted)
        return f"{with_clause(self.sql)}select {shown} from ({self.sql}) as q"


def with_clause(sql: str) -> str:
    """The relations a text names, directly or through others, in order."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & RELATIONS.keys() - needed:
            needed.add(name)
            pending.append(RELATIONS[name])
    if not needed:
        return ""
    return "with " + ",\n".join(f"{n} as ({RELATIONS[n]})" for n in RELATIONS if n in needed) + "\n"


REGISTRY: dict[str, Query] = {}


def query(key: str, columns: str, sql: str | None):
    """Register a Spark job under a key with its shown columns and check SQL."""
    pairs = tuple((name, kind) for name, _, kind in (word.partition(":") for word in columns.split()))

    def register(build: Callable[[Lake], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"query {key} registered twice")
        REGISTRY[key] = Query(build, pairs, sql)
        return build

    return register
