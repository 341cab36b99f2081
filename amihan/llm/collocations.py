"""Collocations: frequent phrases of two to four words whose parts rarely stand apart.

Texts are read in slices of whole documents.  Prefix sums of a polynomial over
the bytes give the hash of each word, a second polynomial over the words the
fingerprint of each n-gram, all by whole-array steps.  A shuffle sums the
occurrences of each fingerprint and keeps one pointer (document, word).  Only
frequent fingerprints go back to the text: the phrase is read at its pointer
and hashed afresh by itself.

Fingerprints have 64 bits and beside them 32 bits of an independent
polynomial; two phrases that collide in the first are told apart by the
second, and reading the text at the pointer confirms both.

A phrase can only be frequent if its parts are, so longer n-grams are emitted
where all their words (then all their pairs) are frequent.  This is looked up
in a bitmap of a fixed size: it can pass too many n-grams, never too few, so
results do not depend on it.  Nothing else is sent to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.llm.common import map_arrow, raw_bytes, slices, stored
from amihan.llm.shingles import mix

#: Fixed values of the tokeniser: what parts pieces, and what parts the words of a piece.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b"\x20\x09"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
KIND = np.array([2 if b in PIECE_ENDS else 1 if b in BLANKS else 0 for b in range(256)], np.uint8)

LONGEST = 4
#: Odd multipliers of the polynomials over bytes and over words.
BYTE_BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
WORD_BASE, CHECK_WORD = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
#: Bytes of text that are hashed at once, and n-grams that are sorted at once.
SLICE, STEP = 1_000_000, 1 << 19
#: The bitmap of frequent fingerprints has 2 ** 26 bits, 8 MB, whatever the corpus.
BITMAP_BITS = 26

OCCURRENCES = "fingerprint long, check int, occurrences long, document long, place long"
_SCHEMA = pa.schema(
    [("fingerprint", pa.int64()), ("check", pa.int32()), ("occurrences", pa.int64()), ("document", pa.int64()), ("place", pa.int64())]
)
PHRASES = "lang string, phrase string, words int, occurrences long"


#: The longest row of powers of each base so far: that of a segment.
_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int, base: int) -> np.ndarray:
    held = _POWERS.get(base)
    if held is None or len(held) < n:
        held = np.full(1 << max(10, (n - 1).bit_length()), base, np.uint64)
        held[0] = 1
        _POWERS[base] = held = np.cumprod(held)
    return held


def _segment(part: bytes) -> tuple[np.ndarray, ...]:
    """Word hashes, check hashes, begins, ends and pieces of one segment."""
    data = np.frombuffer(part, np.uint8)
    n, kind = len(data), KIND[data]
    word = np.zeros(n + 2, bool)
    np.equal(kind, 0, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    begins, ends = edges[::2], edges[1::2]
    pieces = np.cumsum(kind == 2, dtype=np.int32)[begins] if n else np.empty(0, np.int32)
    sums, hashes = np.zeros(n + 1, np.uint64), []
    values = data.astype(np.uint64) + np.uint64(1)
    for base in (BYTE_BASE, CHECK_BASE):
        np.cumsum(values * _powers(n, base)[:n], out=sums[1:])
        hashes.append(mix((sums[ends] - sums[begins]) * _powers(n, pow(base, -1, 1 << 64))[begins]))
    return *hashes, begins, ends, pieces


def tokens(text: bytes) -> tuple[np.ndarray, ...]:
    """The words of a lower-cased text as arrays; long texts go by in segments that end between words."""
    if len(text) <= SLICE:
        return _segment(text)
    parts, at, pieces = [], 0, 0
    while at < len(text):
        cut = min(len(text), at + SLICE)
        while cut < len(text) and KIND[text[cut]] == 0:
            cut += 1
        one = _segment(text[at:cut])
        held = np.frombuffer(text, np.uint8)[at:cut]
        parts.append((one[0], one[1], one[2] + at, one[3] + at, one[4] + np.int32(pieces)))
        pieces += int(np.count_nonzero(KIND[held] == 2))
        at = cut
    return tuple(np.concatenate(x) for x in zip(*parts))


def language_seed(lang: str) -> int:
    """Phrases of different languages have fingerprints of their own."""
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def fingerprints(words: np.ndarray, checks: np.ndarray, seeds: np.ndarray, size: int, mask: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and check of every run of ``size`` words, pieces disregarded."""
    n = max(0, len(words) - size + 1)
    first, second = words[:n] + np.uint64(size), checks[:n] + seeds[:n]
    for k in range(1, size):
        first = first * WORD_BASE + words[k : n + k]
        second = second * CHECK_WORD + checks[k : n + k]
    return mix(first ^ seeds[:n]) & np.uint64(mask), (mix(second) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def bitmap_of(frequent: DataFrame) -> np.ndarray:
    """The leading bits of all fingerprints as a bitmap of at most 2 ** BITMAP_BITS bits."""
    at = F.shiftrightunsigned("fingerprint", 64 - BITMAP_BITS) + 1
    rows = frequent.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
    filled = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for r in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect():
        part = np.frombuffer(bytes(r["bits"]), np.uint8)
        filled[(r["bucket"] - 1) * len(part) :][: len(part)] = part
    return filled


def _combined(prints: np.ndarray, checks: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
    """Equal fingerprints side by side: which, how often, and where first.

    Sorting leading bits with the position in the low ones is one plain sort;
    fingerprints that share these bits may leave several parts, which the shuffle sums.
    """
    low = np.uint64((1 << max(1, len(prints).bit_length())) - 1)
    order = np.sort((prints & ~low) | np.arange(len(prints), dtype=np.uint64)) & low
    prints, checks = prints[order], checks[order]
    new = np.ones(len(prints), bool)
    new[1:] = (prints[1:] != prints[:-1]) | (checks[1:] != checks[:-1])
    at = np.flatnonzero(new)
    return prints[at], checks[at], np.diff(np.append(at, len(prints))), places[order[at]]


def occurrences(sizes: tuple[int, ...], parts: int, bitmap, mask: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function over (document, lang, text): the n-grams of each slice, combined.

    Only n-grams whose runs of ``parts`` words are all in the bitmap are given
    out.  Size 0 stands for the number of words of a language.
    """

    def grams(words, checks, seeds, pieces, size, known):
        n = len(words) - size + 1
        for begin in range(0, max(0, n), STEP):
            end = min(n, begin + STEP)
            upto = slice(begin, end + size - 1)
            keep = pieces[begin:end] == pieces[begin + size - 1 : end + size - 1]
            for k in range(size - parts + 1 if known is not None else 0):
                keep &= known[begin + k : end + k]
            prints, marks = fingerprints(words[upto], checks[upto], seeds[upto], size, mask)
            if keep.any():
                yield _combined(prints[keep], marks[keep], np.flatnonzero(keep) + begin)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bitmap.value, np.uint8) if bitmap is not None else None
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = [bytes(t).translate(LOWER) for t in raw_bytes(batch, "text")]
                documents = batch.column("document").to_numpy()
                lang_seeds = np.array([language_seed(x) for x in batch.column("lang").to_pylist()], np.uint64)
                words, checks, begins, _, pieces = tokens(b"\n".join(texts))
                starts = np.cumsum([0] + [len(t) + 1 for t in texts])
                firsts = np.searchsorted(begins, starts)
                owner = np.repeat(np.arange(len(texts)), np.diff(firsts))
                seeds = lang_seeds[owner]
                known = None
                if held is not None:
                    known = in_bitmap(held, fingerprints(words, checks, seeds, parts, mask)[0])
                for size in sizes:
                    if not size:
                        named, counts = np.unique(seeds, return_counts=True)
                        at = [int(np.argmax(lang_seeds == x)) for x in named]
                        rows = named, np.zeros(len(named), np.int32), counts, documents[at], np.zeros(len(named), np.int64)
                        yield _batch(rows)
                        continue
                    for prints, marks, counts, places in grams(words, checks, seeds, pieces, size, known):
                        own = owner[places]
                        yield _batch((prints, marks, counts, documents[own], (places - firsts[own]) * 8 + size))

    return run


def _batch(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(c).astype(np.uint64).view(np.int64) if f.type == pa.int64() else c, f.type) for c, f in zip(columns, _SCHEMA)]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def phrases_at(mask: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function over (lang, found, text): the phrases at the pointers, checked by their own hashes."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("occurrences", pa.int64())])

    def read(lang: str, text: bytes, found: list[dict]) -> Iterator[tuple]:
        _, _, begins, ends, _ = tokens(text)
        seed = language_seed(lang)
        named = []
        for one in found:
            at, size = one["place"] >> 3, one["place"] & 7
            if not size:
                if one["fingerprint"] & (2**64 - 1) == seed:
                    yield lang, "", 0, one["occurrences"]
            elif at + size <= len(begins):
                named.append((size, b" ".join(text[b:e] for b, e in zip(begins[at : at + size], ends[at : at + size])), one))
        # All phrases are hashed in one go, each by itself: a phrase a line, in the order of their sizes.
        named.sort(key=lambda x: x[0])
        words, checks, *_ = tokens(b"\n".join(p for _, p, _ in named))
        seeds, firsts = np.full(len(words), seed, np.uint64), np.cumsum([0] + [size for size, _, _ in named])
        for size in {s for s, _, _ in named}:
            own, marks = fingerprints(words, checks, seeds, size, mask)
            own = own.view(np.int64)
            for (n, phrase, one), at in zip(named, firsts):
                if n == size and int(own[at]) == one["fingerprint"] and int(marks[at]) == one["check"]:
                    yield lang, phrase.decode(), size, one["occurrences"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                texts = [bytes(t).translate(LOWER) for t in raw_bytes(batch, "text")]
                langs, found = batch.column("lang").to_pylist(), batch.column("found")
                rows = [r for i, t in enumerate(texts) for r in read(langs[i], t, found[i].as_py())]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def frequent_phrases(docs: DataFrame, least: int = 30, mask: int = 2**64 - 1, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, phrase, words, occurrences) of every phrase of one to four words found ``least`` times in a language.

    A row without words holds the number of words of its language.  The mask
    narrows fingerprints, for tests of collisions.
    """
    spark = docs.sparkSession
    lang = F.coalesce(F.col(lang_col), F.lit("und"))
    # Equal rows have one pointer; different rows with one pointer are told apart when the phrase is checked.
    texts = docs.select(F.xxhash64(*[c for c in ("doc_id",) if c in docs.columns], lang, text_col).alias("document"), lang.alias("lang"), F.col(text_col).alias("text"))
    texts = texts.where(F.length("text") > 0)

    def level(sizes: tuple[int, ...], parts: int, shorter: DataFrame | None) -> DataFrame:
        bitmap = spark.sparkContext.broadcast(bitmap_of(shorter).tobytes()) if shorter is not None else None
        rows = map_arrow(texts, occurrences(sizes, parts, bitmap, mask), OCCURRENCES)
        # Both firsts of a group are taken from one row.
        summed = rows.groupBy("fingerprint", "check").agg(
            F.sum("occurrences").alias("occurrences"), F.first("document").alias("document"), F.first("place").alias("place")
        )
        return stored(summed.where((F.col("occurrences") >= least) | (F.col("place") == 0)), "collocation-level")

    words = level((0, 1), 1, None)
    pairs = level((2,), 1, words)
    longer = level((3, 4), 2, pairs)
    pointers = words.unionByName(pairs).unionByName(longer).groupBy("document")
    # At most the different phrases of one document.
    pointers = pointers.agg(F.collect_list(F.struct("fingerprint", "check", "occurrences", "place")).alias("found"))
    pointers = stored(pointers, "collocation-pointers")
    named = texts.join(pointers.select("document"), "document", "left_semi").distinct()
    read = named.join(pointers, "document").select("lang", "found", "text")
    found = map_arrow(read, phrases_at(mask), PHRASES)
    grouped = found.groupBy("lang", "phrase", "words").agg(F.max("occurrences").alias("occurrences"))
    return stored(grouped, "collocation-phrases")


def _sub(words: Column, begin: int, size: int) -> Column:
    return F.array_join(F.slice(words, begin, size), " ")


def _cuts(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Each candidate's lowest-scoring cut as ``cut``: score, k, l and r."""
    parts = F.split("phrase", " ")
    cut = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cut = cut.select(
        "lang", "phrase", "words", "a", "k",
        F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"),
    )
    named = lambda key, value: counts.select("lang", F.col("phrase").alias(key), F.col("occurrences").alias(value))
    cut = cut.join(named("left", "l"), ["lang", "left"]).join(named("right", "r"), ["lang", "right"])
    # Products may pass 64 bits; integral division of decimals is exact.
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    cut = cut.withColumn("score", score)
    return cut.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, mask: int = 2**64 - 1, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Nulls: a null text has no words, a null language is ``und``; ids are not
    used but for pointers, so null and repeated ids and repeated rows count as
    rows of their own.  Texts without words and empty tables give no rows.
    Ties go by score, occurrences, then the bytes of the phrase.  Other
    columns are ignored, whatever their names.
    """
    found = frequent_phrases(docs, least, mask, lang_col, text_col)
    counts = found.where("words > 0")
    candidates = counts.where("words > 1").withColumnRenamed("occurrences", "a")
    parts = F.split("phrase", " ")
    inner = F.array(
        *[F.when(F.col("words") > size, _sub(parts, begin, size)) for size in (2, 3) for begin in range(1, LONGEST - size + 2)]
    )
    fits = F.filter(inner, lambda x: x.isNotNull() & (x != F.col("phrase")))
    sizes = F.filter(fits, lambda x: F.size(F.split(x, " ")) > 1)
    # The slice of a three-word phrase that runs over its end is a single word, and is left out above.
    longest = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(sizes)).alias("phrase"), "a")
    longest = longest.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    scored = _cuts(candidates, counts).join(longest, ["lang", "phrase"], "left")
    free = F.col("longer").isNull() | F.expr("cast(longer as decimal(19,0)) * 100 < cast(a as decimal(19,0)) * 80")
    scored = scored.where(free).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    totals = found.where("words = 0").select("lang", F.col("occurrences").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
