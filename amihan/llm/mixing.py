"""Mixing sources to target weights by Poisson replication.

A source s of size z (characters, one more per document) with weight w gets
the mean rate  budget * Z * w / z,  Z being the size of all sources.  Each
document is repeated by a Poisson count with that mean: a hash of its id and
the seed is a uniform number, and the count inverts the distribution there.
The copies are then put in one global random order.

Only DataFrame expressions run.  The sizes are combined before the shuffle,
so a source with a third of all rows is no hot key; the rates hold one row
per source and are broadcast only if a count proves them few, otherwise the
join is salted.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import stored

#: The largest mean that one inversion takes; larger means are sums of several counts.
PIECE = 16.0
#: Beyond 80 a Poisson count of mean 16 has a chance below 2 ** -90, less than the 52 bits tell apart.
TERMS = 80
BROADCAST_ROWS = 10_000
SALTS = 64


def uniform(*parts: Column) -> Column:
    """A number between 0 and 1 from 52 bits of the parts' MD5."""
    digest = F.md5(F.concat_ws("|", *parts))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))


def poisson_cdf(mean: Column) -> Column:
    """The chances of at most 0, 1, ... copies, as an array."""
    first = F.exp(-mean)
    zero = F.struct(first.alias("p"), F.array(first).alias("c"))
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        zero,
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["c"], F.array(F.element_at(acc["c"], -1) + acc["p"] * mean / k)).alias("c"),
        ),
    )
    return grown["c"]


def source_rates(
    docs: DataFrame,
    source_col: str,
    size: Column,
    weights: Mapping[str, float] | None,
    temperature: float,
    budget: float,
) -> DataFrame:
    """(source, rate): the mean number of copies of each document of a source.

    Without weights a source counts by its size to the power of the
    temperature.  Sources that given weights leave out get the rate 0.
    """
    sizes = stored(docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(size).alias("size")), "mix-sizes")
    if weights is None:
        weight = F.pow(F.col("size").cast("double"), F.lit(float(temperature)))
    else:
        listed = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        weight = F.coalesce(F.create_map(*listed)[F.col("source")], F.lit(0.0)) if listed else F.lit(0.0)
    weighed = sizes.withColumn("weight", weight)
    total = weighed.agg(F.sum("size").alias("size"), F.sum("weight").alias("weight")).first()
    scale = budget * total["size"] / total["weight"] if total["weight"] else 0.0
    return weighed.select("source", (F.lit(scale) * F.col("weight") / F.col("size")).alias("rate"))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = 0.5,
    budget: float = 1.0,
    seed: int = 17,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Every copy of every document, with copy_no (from 1), n_copies and shuffle_key, in global order of the key.

    Nulls: a null source is a source of its own (rate 0 under given weights),
    a null text has size 1, a null id hashes as its text.  Rows that repeat an
    id (or a text, without an id) get the same count each and stay apart.  An empty table gives no rows.
    Input columns of the three added names are replaced; all others stay, whatever their names.
    """
    size = F.coalesce(F.length(text_col), F.lit(0)).cast("long") + 1
    rates = source_rates(docs, source_col, size, weights, temperature, budget)
    pieces = F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int")
    # Names that no input column begins with.
    own = "__"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    kept = [c for c in docs.columns if c not in ("copy_no", "n_copies", "shuffle_key")]
    plan = rates.select(
        F.col("source").alias(f"{own}source"), pieces.alias(f"{own}pieces"), poisson_cdf(F.col("rate") / pieces).alias(f"{own}cdf")
    )
    same = docs[source_col].eqNullSafe(plan[f"{own}source"])
    if rates.count() <= BROADCAST_ROWS:
        joined = docs.join(F.broadcast(plan), same)
    else:
        plan = plan.withColumn(f"{own}part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        docs = docs.withColumn(f"{own}salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int"))
        joined = docs.join(plan, docs[source_col].eqNullSafe(plan[f"{own}source"]) & (docs[f"{own}salt"] == plan[f"{own}part"]))
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))))
    draws = F.transform(
        F.sequence(F.lit(1), F.col(f"{own}pieces")),
        lambda i: F.size(F.filter(F.col(f"{own}cdf"), lambda c: c < uniform(F.lit(str(seed)), name, i.cast("string")))),
    )
    counted = joined.withColumn("n_copies", F.aggregate(draws, F.lit(0), lambda a, n: a + n).cast("long"))
    copies = counted.where(F.col("n_copies") > 0).select(
        *kept, "n_copies", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_copies"))).alias("copy_no")
    )
    key = F.md5(F.concat_ws("|", F.lit(f"{seed} order"), name, F.col("copy_no").cast("string")))
    return copies.withColumn("shuffle_key", key).orderBy("shuffle_key", id_col, "copy_no")
