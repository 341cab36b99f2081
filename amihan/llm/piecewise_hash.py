"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes ends a chunk wherever its low bits are
all ones; how many bits is the block size, as a power of two: the smallest
for which a text has at most 64 chunks.  A fingerprint is the block size and
the chunk hashes (12 bits each, two base64 characters) at that size and at the
next one.  Ends at a larger size are ends at the smaller one too, so two
fingerprints are comparable when their block sizes are equal or next to each
other; their likeness is one minus the insert-delete edit distance of the
chunk sequences over the sum of their lengths.

Long texts are read in segments: memory does not grow with a text beyond its
own bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import block_of, map_arrow

WINDOW = 7
MAX_CHUNKS = 64
LEAST_BITS = 2
MOST_BITS = 31
SEGMENT = 1 << 20
#: Texts compared at once.
PAIRS = 512
#: Odd multipliers of the rolling hash and of the chunk hash, and the base64 alphabet.
ROLL, POWER, MIX = np.uint32(0x9E3779B1), 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MASK64 = (1 << 64) - 1


@lru_cache(maxsize=2)
def _powers(base: int = POWER) -> np.ndarray:
    row = np.full(SEGMENT, base, np.uint64)
    row[0] = 1
    return np.cumprod(row)


def _back(places: np.ndarray) -> np.ndarray:
    """The inverse powers of places in a text."""
    near = _powers(pow(POWER, -1, 1 << 64))[places % SEGMENT]
    segments = places // SEGMENT
    for s in np.unique(segments[segments > 0]).tolist():
        near[segments == s] *= np.uint64(pow(POWER, -s * SEGMENT, 1 << 64))
    return near


@dataclass(frozen=True)
class Fingerprint:
    bits: int
    first: np.ndarray
    second: np.ndarray

    def __str__(self) -> str:
        shown = ["".join(ALPHABET[c >> 6] + ALPHABET[c & 63] for c in chunks.tolist()) for chunks in (self.first, self.second)]
        return f"{1 << self.bits}:{shown[0]}:{shown[1]}"


def _rolling(data: np.ndarray, begin: int, end: int) -> np.ndarray:
    """The rolling hash at each byte of a segment; before the text are zeros."""
    near = data[max(0, begin - WINDOW + 1) : end]
    short = WINDOW - 1 - (begin - max(0, begin - WINDOW + 1))
    if short:
        near = np.concatenate([np.zeros(short, np.uint8), near])
    wide = near.astype(np.uint32)
    wide += np.uint32(1)
    n = end - begin
    h = wide[:n].copy()
    for k in range(1, WINDOW):
        h *= ROLL
        h += wide[k : k + n]
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    h ^= h >> np.uint32(13)
    return h


def _bits_of(h: np.ndarray) -> np.ndarray:
    """How many low bits are ones."""
    return np.bitwise_count(h & ~(h + np.uint32(1)))


def fingerprint(text: bytes) -> Fingerprint:
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    segments = [(b, min(b + SEGMENT, n)) for b in range(0, n, SEGMENT)]
    kept = {segments[0]: _rolling(data, *segments[0])} if len(segments) == 1 else {}

    def hashes(segment: tuple[int, int]) -> np.ndarray:
        return kept[segment] if segment in kept else _rolling(data, *segment)

    least = max(LEAST_BITS, (n >> 8).bit_length())
    while True:
        low = np.uint32((1 << least) - 1)
        counts = np.zeros(33, np.int64)
        for s in segments:
            h = hashes(s)
            counts += np.bincount(_bits_of(h[(h & low) == low]), minlength=33)
        if counts.sum() >= MAX_CHUNKS or least == LEAST_BITS:
            break
        least = max(LEAST_BITS, least - 2)
    at_least = counts[::-1].cumsum()[::-1]
    bits = next(k for k in range(least, 34) if k == 33 or at_least[k] < MAX_CHUNKS)

    ends: dict[int, list[np.ndarray]] = {bits: [], bits + 1: []}
    marks: dict[int, list[np.ndarray]] = {bits: [], bits + 1: []}
    total = 0
    for begin, end in segments:
        h = hashes((begin, end))
        sums = data[begin:end].astype(np.uint64)
        sums += np.uint64(1)
        sums *= _powers()[: end - begin]
        np.cumsum(sums, out=sums)
        scale = pow(POWER, begin, 1 << 64)
        # Ends at the larger size are among those at the smaller one.
        at = np.flatnonzero((h & np.uint32((1 << min(bits, 32)) - 1)) == np.uint32((1 << min(bits, 32)) - 1)) if bits < 33 else np.empty(0, np.int64)
        for k in ends:
            if k > bits:
                low = np.uint32((1 << min(k, 32)) - 1)
                at = at[(h[at] & low) == low] if k < 33 else at[:0]
            ends[k].append(at + (begin + 1))
            marks[k].append(sums[at] * np.uint64(scale) + np.uint64(total))
        total = (total + scale * int(sums[-1])) & MASK64
    chunks = []
    for k in ends:
        own_ends, own_marks = np.concatenate([*ends[k], [n]]), np.concatenate([*marks[k], np.array([total], np.uint64)])
        if not n or (len(own_ends) > 1 and own_ends[-2] == n):
            own_ends, own_marks = own_ends[:-1], own_marks[:-1]
        before = np.concatenate(([0], own_ends[:-1])).astype(np.int64)[: len(own_ends)]
        own = own_marks.copy()
        own[1:] -= own_marks[:-1]
        own *= _back(before)
        mixed = (own ^ (own >> np.uint64(31))) * MIX
        chunks.append((mixed >> np.uint64(52)).astype(np.uint16))
    return Fingerprint(bits, *chunks)


def _common(a: np.ndarray, a_len: np.ndarray, b: np.ndarray, b_len: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of rows of chunks, 64 columns wide, a bit for each chunk of a."""
    inside = np.arange(MAX_CHUNKS)[None, :] < a_len[:, None]
    free = np.full(len(a), MASK64, np.uint64)
    for j in range(int(b_len.max(initial=0))):
        equal = (a == b[:, j : j + 1]) & inside & (j < b_len)[:, None]
        bits = np.packbits(equal, axis=1, bitorder="little").view("<u8")[:, 0]
        hit = free & bits
        free = (free + hit) | (free - hit)
    return np.bitwise_count(~free)


def likeness(pairs: list[tuple[Fingerprint, Fingerprint]]) -> np.ndarray:
    """From 0 to 1 for each pair; equal fingerprints are 1, incomparable ones 0."""
    chosen = []
    for x, y in pairs:
        a, b = {0: (x.first, y.first), 1: (x.first, y.second), -1: (x.second, y.first)}.get(x.bits - y.bits, (x.first[:0], y.first[:0]))
        chosen.append((a, b))
    out = np.zeros(len(pairs))
    if not pairs:
        return out
    lengths = np.array([(len(a), len(b)) for a, b in chosen])
    left, right = (np.zeros((len(pairs), MAX_CHUNKS), np.uint16) for _ in range(2))
    for i, (a, b) in enumerate(chosen):
        left[i, : len(a)], right[i, : len(b)] = a, b
    both = lengths.sum(axis=1)
    common = _common(left, lengths[:, 0], right, lengths[:, 1])
    np.divide(2.0 * common, both, out=out, where=both > 0)
    same = [x.bits == y.bits and np.array_equal(x.first, y.first) and np.array_equal(x.second, y.second) for x, y in pairs]
    out[same] = 1.0
    return out


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the following text."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness and that to the next document.

    The next document has the next smaller id (after the smallest: the
    largest).  Documents are dealt into ranges of ids; a range also gets the
    first document of the following one.  A null text is empty, a null id
    comes after all others; rows that repeat an id follow each other by text.
    A single document is its own next.  An empty table gives no rows; other
    columns take no part.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(lowest)).alias("key"),
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = rows.select("key").repartitionByRange(parts, F.desc("key"))
    found = ranges.groupBy(F.spark_partition_id().alias("part")).agg(F.max("key").alias("key")).collect()
    # At most one number for each partition.
    starts = sorted({r["key"] for r in found}, reverse=True) or [lowest]
    own = rows.withColumn("block", block_of(F.col("key"), starts))
    first_of = F.array_contains(F.array(*[F.lit(s) for s in starts]), F.col("key"))
    also = F.when(first_of, F.array(F.struct((F.when(F.col("block") == 0, len(starts)).otherwise(F.col("block")) - 1).alias("block"), F.lit(True).alias("carried"))))
    here = F.array(F.struct(F.col("block").alias("block"), F.lit(False).alias("carried")))
    dealt = own.select("doc_id", "text", "key", F.inline(F.concat(here, F.coalesce(also, F.array().cast("array<struct<block:int,carried:boolean>>")))))
    dealt = dealt.repartition(parts, "block").sortWithinPartitions("block", "carried", F.desc("key"), "text")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_text", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )

    def finished(held: list[tuple]) -> pa.RecordBatch:
        near_edited = likeness([(own, edited) for _, _, _, own, edited, _ in held])
        near_next = likeness([(own, following) for _, _, _, own, _, following in held])
        columns = [
            [h[0] for h in held], [h[1] for h in held], [h[2] for h in held], [str(h[3]) for h in held], [str(h[4]) for h in held], near_edited, near_next,
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple | None = None
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for i in range(batch.num_rows):
                doc_id, text, block, carried = (batch.column(c)[i].as_py() for c in ("doc_id", "text", "block", "carried"))
                if waiting is None and carried:
                    continue
                own = fingerprint(text.encode())
                if waiting is not None:
                    edited = edited_text(waiting[1], text)
                    held.append((waiting[0], len(waiting[1]), edited, waiting[2], fingerprint(edited.encode()), own))
                    size += len(edited)
                waiting = None if carried else (doc_id, text, own)
                if len(held) >= PAIRS or size >= SEGMENT * 8:
                    yield finished(held)
                    held, size = [], 0
        if held:
            yield finished(held)

    return map_arrow(
        dealt.select("doc_id", "text", "block", "carried"),
        run,
        "doc_id bigint, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )
