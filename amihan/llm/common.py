"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import os
import shutil
import tempfile
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute  # noqa: F401  used as pa.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amihan.session import run_folder

#: Rows of one call into Python below which no further splitting is done; texts are split by bytes first.
SLICE_BYTES = 8 << 20
#: Bytes of text whose rows are turned into Python objects at once.
ROW_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


#: Spark's own setting; releases that don't know it keep shuffle files until their frames are collected.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, free: bool = False) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    With ``free`` the shuffle files of the write go when it ends.
    """
    spark = df.sparkSession
    path = run_folder(spark, label)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    if free:
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if free:
            spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(), "amihan"), "zip", root, "amihan")
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | T.StructType
) -> DataFrame:
    """mapInArrow by a function of this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


_STATE: dict[Hashable, Any] = {}


def worker_state(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps between its tasks, made when it is first asked for.

    Workers are used again by later stages: only the last state asked for is
    kept, and the memory of the one before goes back to the machine.
    """
    if key not in _STATE:
        _STATE.clear()
        gc.collect()
        give_back()
        _STATE[key] = make()
    return _STATE[key]


def give_back() -> None:
    """Return freed memory to the machine; C libraries without this call do so by themselves."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def block_of(key: Column, starts: list[int]) -> Column:
    """The last place of a descending list that is not below the key, by bisection."""
    listed = F.array(*[F.lit(s) for s in starts])
    halves = F.sequence(F.lit(1), F.lit(max(1, len(starts).bit_length())))
    zero = F.struct(F.lit(0).alias("low"), F.lit(len(starts)).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        right = (acc["high"] - acc["low"] > 1) & (F.get(listed, middle) >= key)
        return F.struct(
            F.when(right, middle).otherwise(acc["low"]).alias("low"),
            F.when(right | (acc["high"] - acc["low"] <= 1), acc["high"]).otherwise(middle).alias("high"),
        )

    return F.aggregate(halves, zero, halve, lambda acc: acc["low"])


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of one text column pass a limit; a longer text is alone."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        size = size or 0
        if i > begin and held + size > limit:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def by_row(
    function: Callable[..., Iterable[tuple[Any, ...]]],
    columns: tuple[str, ...],
    schema: pa.Schema,
    done: Callable[[], None] | None = None,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that gives each row's columns to a generator of output rows; ``done`` ends a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for whole in batches:
                for batch in slices(whole, columns[-1], ROW_BYTES):
                    rows = [r for values in zip(*(batch.column(c).to_pylist() for c in columns)) for r in function(*values)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema
                    )
        finally:
            if done is not None:
                done()

    return run


def raw_bytes(batch: pa.RecordBatch, column: str) -> list[memoryview]:
    """The UTF-8 bytes of each text without copying; a null text is empty."""
    array = batch.column(column)
    array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
    _, offsets, data = array.buffers()
    at = memoryview(offsets).cast("q")[array.offset : array.offset + len(array) + 1] if len(array) else [0]
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[at[i] : at[i + 1]] if array[i].is_valid else view[:0] for i in range(len(array))]
