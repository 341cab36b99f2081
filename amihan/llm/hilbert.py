"""Shards along a Hilbert curve: runs of documents that are alike in several columns at once.

Each dimension is quantised to a few bits, the cells are numbered along a
Hilbert curve, rows are sorted by that number, and the order is cut into runs
of equal counts.  A run covers a compact region, so the smallest and largest
values of its file prune it for filters on any of the dimensions.

Only DataFrame expressions run.  The order is a range partitioning; a row's
place is its place in its range plus the rows of all earlier ranges, so no
task sees more than a range, and nothing but one count a range is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.llm.common import stored


@lru_cache
def curve_steps(dims: int) -> tuple[tuple[int, ...], tuple[int, ...]]:
    """(digit along the curve, next state) for state * 2 ** dims + bits of the coordinates.

    A state is the corner where the curve enters a cell and the axis along
    which it leaves: the coordinates are turned so that both become standard,
    where the curve visits the corners in the order of the reflected code.
    """
    size = 1 << dims
    turn = lambda x, k: (x >> k | x << (dims - k)) & (size - 1)
    gray = lambda x: x ^ x >> 1
    rank = {gray(i): i for i in range(size)}
    trailing = lambda x: (x ^ x + 1).bit_length() - 1 if x >= 0 else 0
    enter = lambda i: 0 if i == 0 else gray(2 * ((i - 1) // 2))
    axis = lambda i: 0 if i == 0 else (trailing(i - 1) if i % 2 == 0 else trailing(i)) % dims
    digits, following = [], []
    for state in range(size * dims):
        corner, along = divmod(state, dims)
        k = (along + 1) % dims
        for bits in range(size):
            digit = rank[turn(bits ^ corner, k)]
            digits.append(digit)
            next_corner = corner ^ turn(enter(digit), (dims - k) % dims)
            following.append(next_corner * dims + (along + axis(digit) + 1) % dims)
    return tuple(digits), tuple(following)


def curve_index(coordinates: Sequence[Column], bits: int) -> Column:
    """The place along the curve of a cell with whole coordinates below 2 ** bits."""
    dims = len(coordinates)
    digits, following = (F.from_json(F.lit(str(list(t))), "array<int>") for t in curve_steps(dims))
    cell = F.array(*[c.cast("int") for c in coordinates])

    def down(acc: Column, level: Column) -> Column:
        # The first coordinate is the lowest bit.
        here = F.aggregate(
            F.sequence(F.lit(dims - 1), F.lit(0), F.lit(-1)),
            F.lit(0),
            lambda x, d: x * 2 + F.call_function("shiftright", F.get(cell, d), level).bitwiseAND(F.lit(1)),
        )
        at = acc["state"] * (1 << dims) + here
        return F.struct(
            (acc["index"] * (1 << dims) + F.get(digits, at)).alias("index"), F.get(following, at).alias("state")
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    levels = F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1))
    return F.aggregate(levels, start, down, lambda acc: acc["index"])


def by_magnitude(value: Column, bits: int, steps: int = 3) -> Column:
    """Whole numbers on a logarithmic scale: the number of bits and the next ``steps`` bits; null and less than 1 are 0."""
    own = F.greatest(F.coalesce(value.cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
    digits = F.bin(own)
    mantissa = F.conv(F.rpad(F.substring(digits, 2, steps), steps, "0"), 2, 10).cast("int")
    scale = F.when(own == 0, 0).otherwise((F.length(digits) - 1) * (1 << steps) + mantissa + 1)
    return F.least(scale, F.lit((1 << bits) - 1)).cast("int")


def by_share(rows: DataFrame, value: Column, name: str, bits: int) -> DataFrame:
    """Adds the cell of a value: the share of rows with smaller values, on the whole scale; null is lowest.

    One row for each value is counted, numbered and joined back; values are
    counted before the shuffle, and the join is left to Catalyst, which
    broadcasts a short list and splits hot values of a long one.
    """
    counts = rows.groupBy(value.alias("value")).agg(F.count("*").alias("weight"))
    placed = with_places(counts, [F.col("value")], F.col("weight"))
    cell = F.expr(f"(cast(place as decimal(19,0)) * {1 << bits}) div total").cast("int")
    cells = placed.select(F.col("value").alias("cell_value"), cell.alias(name))
    return rows.join(cells, value.eqNullSafe(F.col("cell_value")), "left").drop("cell_value")


def with_places(rows: DataFrame, order_by: Sequence[Column], weight: Column | None = None) -> DataFrame:
    """Rows in order with ``place``, the weight of all rows before (their number by default), and ``total``.

    Rows equal in all of ``order_by`` are alike for the order and dealt at random
    between ranges, so that no run of equal rows is one task.
    """
    keys = [*order_by, F.col("dealt")]
    dealt = rows.withColumn("dealt", F.rand(5)).withColumn("weight", weight if weight is not None else F.lit(1).cast("long"))
    ranged = stored(dealt.repartitionByRange(*keys).withColumn("range", F.spark_partition_id()), "curve-order")
    before = lambda w: F.coalesce(F.sum("weight").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row a range.
    sums = ranged.groupBy("range").agg(F.sum("weight").alias("weight"))
    offsets = sums.select(
        "range", before(Window.orderBy("range")).alias("offset"), F.sum("weight").over(Window.partitionBy()).alias("total")
    )
    inside = ranged.withColumn("inside", before(Window.partitionBy("range").orderBy(*keys)))
    placed = inside.join(F.broadcast(offsets), "range").withColumn("place", F.col("offset") + F.col("inside"))
    return placed.drop("range", "dealt", "weight", "offset", "inside")


def shards(docs: DataFrame, n_shards: int, categories: Sequence[str], magnitudes: Sequence[str], ties: Sequence[str], bits: int = 8) -> DataFrame:
    """All rows and columns with curve, shard (from 0) and slot (from 0 in each shard); counts differ by one at most.

    Dimensions are the categories by share and the magnitudes by logarithm;
    rows of one cell follow in the order of ``ties``.  Null values of any
    column come first.  Rows equal in all ties get neighbouring slots.  An
    empty table gives no rows.  Input columns of the three added names are
    replaced; all others stay, whatever their names.
    """
    added = ("curve", "shard", "slot")
    # Input columns stay inside one struct, so no name of theirs meets one of these.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    of = lambda c: F.col("row").getField(c)
    named = [f"cell_{i}" for i in range(len(categories))]
    for name, column in zip(named, categories):
        rows = by_share(rows, of(column), name, bits)
    cells = [F.col(c) for c in named] + [by_magnitude(of(c), bits) for c in magnitudes]
    rows = rows.select("row", curve_index(cells, bits).alias("curve"))
    placed = with_places(rows, [F.col("curve"), *[of(c) for c in ties]])
    shard = F.expr(f"(cast(place as decimal(19,0)) * {n_shards}) div total")
    begin = F.expr(f"(cast(shard as decimal(19,0)) * total + {n_shards - 1}) div {n_shards}")
    placed = placed.withColumn("shard", shard.cast("int")).withColumn("slot", (F.col("place") - begin).cast("long"))
    return placed.select(*[of(c).alias(c) for c in docs.columns if c not in added], *added)


def write_shards(sharded: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """Parquet files by shard; each holds a run of slots, so that filters on the dimensions skip most of them."""
    run = F.floor(F.col("slot") / rows_per_file)
    dealt = sharded.repartition(F.col("shard"), run).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path)


def bounds(sharded: DataFrame, columns: Sequence[str], rows_per_run: int = 1_000_000) -> DataFrame:
    """(shard, run, rows, and least and most of each column): what a reader needs to skip runs."""
    run = F.floor(F.col("slot") / rows_per_run).alias("run")
    ends = [x for c in columns for x in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}"))]
    return sharded.groupBy("shard", run).agg(F.count("*").alias("rows"), *ends)
