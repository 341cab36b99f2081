"""Texts against a list of parts that may be long: which rows contain which entries.

Containment is no equality, so a plain join would compare every row with
every entry.  Here each entry is filed under one of its grams (runs of a
fixed number of characters), each text looks up all of its own grams in an
equality join, and only entries met there are compared in full.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 3


def grams(text: Column, size: int) -> Column:
    """All different runs of ``size`` characters; none of a shorter or null text."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    found = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))


def containing(rows: DataFrame, keys: Sequence[str], texts: Mapping[str, Column], entries: DataFrame, parts: Mapping[str, str]) -> DataFrame:
    """Each row and entry where any text contains its part, once each: the keys and the entry's columns.

    ``texts`` and ``parts`` have the same names: the text ``bank`` is searched
    for each entry's column ``parts["bank"]``; a null or empty part is in no
    text.  Keys tell rows apart.  Different texts are looked up once each, so
    a text that a third of all rows share meets the list once; matches then go
    back to the rows by the text, which AQE splits where one text is hot.
    """
    listed = entries.select(F.struct(*[entries[c] for c in entries.columns]).alias("_entry")).distinct()
    found = []
    for name, text in texts.items():
        part = F.col("_entry").getField(parts[name])
        named = rows.select(text.alias("_text")).where(F.col("_text").isNotNull()).distinct()
        each = named.withColumn("_gram", F.explode(F.concat(*[grams(F.col("_text"), n) for n in range(1, GRAM + 1)])))
        # An entry is filed under the gram that fewest texts hold, a shorter one under its whole text.
        own = F.when(F.length(part) < GRAM, F.array(part)).otherwise(grams(part, GRAM))
        held = each.groupBy("_gram").agg(F.count("*").alias("_texts"))
        candidates = listed.where(F.length(part) > 0).withColumn("_gram", F.explode(own)).join(held, "_gram")
        filed = candidates.groupBy("_entry").agg(F.min(F.struct("_texts", "_gram")).alias("_least"), F.count("*").alias("_held"))
        # A part some of whose grams no text holds is in no text.
        filed = filed.where(F.col("_held") == F.size(own)).select("_entry", "_least._gram")
        matches = each.join(filed, "_gram").where(F.contains("_text", part)).select("_text", "_entry")
        found.append(rows.select(*keys, text.alias("_text")).join(matches, "_text").select(*keys, "_entry"))
    return reduce(DataFrame.unionByName, found).distinct().select(*keys, "_entry.*")
