"""Language identification by cross-parsing against suffix automata.

For each language the suffix automaton of a bounded sample of its labelled
text knows every substring of it.  A text is parsed into the longest pieces
that occur in the sample; the bits this takes per letter - pieces times the
logarithm of the sample's length - estimate the cross entropy, and the
language that needs the fewest wins.

The automaton is laid out as a table (state, letter) -> state, with the start
of a new piece already followed, so that thousands of text segments step
through it at once.  A language's table has columns for its own letters only.
Frequent letters are one symbol, all others are spelled by their UTF-8 bytes,
so every letter keeps its identity.  Texts are cut into segments of fixed
length; every letter of every segment counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from amihan.llm.common import map_arrow, slices, worker_state

#: Bounds of the sample of one language: documents, and characters of each from a place that a hash chooses.
SAMPLE_DOCS = 128
SAMPLE_CHARS = 512
#: Bytes of the tables of all languages; of many languages shorter samples are used.
TABLE_BYTES = 256 << 20
#: Bytes of text parsed at once; its symbols and counts take about twenty times as much.
PARSED_BYTES = 1 << 20
#: Letters with a symbol of their own, the most frequent of the sample beside a to z; others are spelled.
MAX_LETTERS = 100
SEGMENT = 1024
NEW_PIECE = np.int32(-(1 << 31))
UNKNOWN = "und"
#: Symbols: all that is no letter, filling, the bytes of spelled letters, letters, and the end of a text.
GAP, FILLING, BYTES, LETTERS = 0, 1, 2, 130
SPELLED, END_OF_TEXT = 254, 255
ASCII = "abcdefghijklmnopqrstuvwxyz"


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from; those without an id are among them."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(3)) == 1, F.lit(True))


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """(language, text) by language: bounded for each, chosen by a hash of the id."""
    order = F.xxhash64(F.col(id_col).cast("string"))
    start = F.pmod(order, F.greatest(F.length(text_col) - SAMPLE_CHARS, F.lit(0)).cast("long") + 1).cast("int") + 1
    pick = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    rows = (
        docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
        .select(F.col(lang_col).alias("lang"), order.alias("order"), F.substring(F.col(text_col), start, F.lit(SAMPLE_CHARS)).alias("text"))
        .withColumn("n", pick)
        .where(F.col("n") <= SAMPLE_DOCS)
        .select("lang", "text", "n")
        .collect()
    )
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["n"], r["text"]))
    return [(lang, "\n".join(t for _, t in sorted(texts))) for lang, texts in sorted(by_lang.items())]


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """The smallest automaton that knows all substrings: a row for each state, the state each symbol leads to or 0.

    No arrow leads to state 0, the start.  Rows are filled in place, so nothing
    but the table is held; memory of rows beyond the last state is never touched.
    """
    rows = np.zeros((2 * len(symbols) + 1, width), np.int32)
    arrows = memoryview(rows.reshape(-1))
    link, longest, last = [-1], [0], 0
    for symbol in symbols:
        new = len(link)
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and not arrows[at * width + symbol]:
            arrows[at * width + symbol] = new
            at = link[at]
        if at >= 0:
            to = arrows[at * width + symbol]
            if longest[to] == longest[at] + 1:
                link[new] = to
            else:
                copy = len(link)
                rows[copy] = rows[to]
                longest.append(longest[at] + 1)
                link.append(link[to])
                link[to] = link[new] = copy
                while at >= 0 and arrows[at * width + symbol] == to:
                    arrows[at * width + symbol] = copy
                    at = link[at]
        last = new
    return rows[: len(link)]


class CrossParser:
    def __init__(self, samples: tuple[tuple[str, str], ...], table_bytes: int = TABLE_BYTES) -> None:
        self.langs = [lang for lang, _ in samples]
        counted = Counter(c for _, text in samples for c in text.lower() if c.isalpha() and c not in ASCII)
        letters = ASCII + "".join(sorted(counted, key=lambda c: (-counted[c], c))[: MAX_LETTERS - len(ASCII)])
        self.classes = np.fromiter((SPELLED if chr(c).isalpha() else GAP for c in range(0x110000)), np.uint8, 0x110000)
        self.classes[[ord(c) for c in letters]] = np.arange(LETTERS, LETTERS + len(letters))
        self.classes[0] = END_OF_TEXT
        #: Per language: its table, and the column of each symbol in it.
        self.tables, self.columns, self.bits = [], [], []
        for _, text in samples:
            symbols = self.symbols([text])
            symbols = symbols[symbols != END_OF_TEXT]
            # An automaton has fewer than two states a symbol, a state four bytes a column.
            width = len(np.unique(symbols)) + 2
            symbols = symbols[: max(1, table_bytes // (len(samples) * 8 * width))]
            table, column = self._table(symbols)
            self.tables.append(table)
            self.columns.append(column)
            self.bits.append(math.log2(max(2, len(symbols))))

    @staticmethod
    def _table(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A flat table of what each state and own symbol lead to; column 0 is of all symbols the sample lacks, 1 of filling."""
        own = np.unique(symbols)
        column = np.zeros(256, np.int32)
        column[own] = np.arange(2, 2 + len(own))
        column[FILLING] = 1
        width = len(own) + 2
        table = suffix_automaton(column[symbols].tolist(), width)
        table *= width
        root = table[0].copy()
        for symbol in range(width):
            to = table[:, symbol]
            to[to == 0] = root[symbol] | NEW_PIECE
        table[:, 1] = np.arange(len(table), dtype=np.int32) * width
        return table.ravel(), column

    def symbols(self, texts: list[str]) -> np.ndarray:
        """Symbols of all letters in order; runs of other characters are one gap; each text ends with a mark."""
        whole = "".join(t.replace("\x00", " ").lower() + "\x00" for t in texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes[points]
        spelled = classes == SPELLED
        if spelled.any():
            # All spelled letters are beyond ASCII: two bytes or more.
            rare = points[spelled]
            sizes = np.ones(len(points), np.int64)
            sizes[spelled] = 2 + (rare >= 0x800) + (rare >= 0x10000)
            letters = rare.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            classes, place = np.repeat(classes, sizes), np.repeat(spelled, sizes)
            classes[place] = np.frombuffer(letters, np.uint8) - np.uint8(0x80 - BYTES)
        gap = classes == GAP
        return classes[np.concatenate(([True], ~(gap[1:] & gap[:-1])))] if len(classes) else classes

    def pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) numbers of pieces, and the number of letters of each text."""
        symbols = self.symbols(texts)
        ends = np.flatnonzero(symbols == END_OF_TEXT)
        begins = np.concatenate(([0], ends[:-1] + 1))
        lengths = ends - begins
        # A spelled letter counts by its first byte.
        later = (symbols >= BYTES) & (symbols < BYTES + 0x40)
        letters = np.concatenate(([0], np.cumsum((symbols != GAP) & (symbols != END_OF_TEXT) & ~later)))
        n_letters = letters[ends] - letters[begins]
        lanes = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), lanes)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = begins[owner] + nth * SEGMENT
        size = np.minimum(SEGMENT, lengths[owner] - nth * SEGMENT)
        # The longest segments first: those still under way are always the first lanes.
        order = np.argsort(-size, kind="stable")
        owner, start, size = owner[order], start[order], size[order]
        under_way = np.searchsorted(-size, -np.arange(SEGMENT), side="left")
        at = np.zeros((len(self.langs), len(owner)), np.int32)
        counts = np.ones(at.shape, np.int32)
        for t in range(int(size.max(initial=0))):
            n = int(under_way[t])
            seen = symbols[start[:n] + t]
            for i, (table, column) in enumerate(zip(self.tables, self.columns)):
                step = table.take(at[i, :n] + column.take(seen))
                counts[i, :n] += step < 0
                at[i, :n] = step & ~NEW_PIECE
        out = np.zeros((len(texts), len(self.langs)))
        for i in range(len(self.langs)):
            out[:, i] = np.bincount(owner, counts[i], minlength=len(texts))
        return out, n_letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and bits per letter of each text."""
        if not self.langs or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
        pieces, letters = self.pieces(texts)
        bits = pieces * np.array(self.bits)
        best = bits.argmin(axis=1)
        rows = np.arange(len(texts))
        least = bits[rows, best]
        bits[rows, best] = np.inf
        second = bits.min(axis=1)
        spoken = letters > 0
        score = np.where(spoken, np.where(np.isinf(second), 1.0, 1.0 - least / np.maximum(second, 1e-9)), 0.0)
        names = [self.langs[b] if s else UNKNOWN for b, s in zip(best, spoken)]
        return names, np.clip(score, 0.0, 1.0), np.where(spoken, least / np.maximum(letters, 1), 0.0)


def parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return worker_state(("languages", samples), lambda: CrossParser(samples))


def with_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Every row with held_out, lang_pred, score and bits_per_letter; input columns of these names are replaced.

    Learned languages are the labels of documents that are not held out; a
    tie goes to the first by name.  A text that is null or has no letter is
    ``und`` with score 0, and so is every text if nothing could be learned.
    The score is the share of bits saved against the second best language (1
    where only one is known).  Repeated rows and null ids stay as rows; an
    empty table gives no rows.
    """
    samples = tuple(labelled_sample(docs, id_col, text_col, lang_col))
    sent = docs.sparkSession.sparkContext.broadcast(samples)
    added = ("lang_pred", "score", "bits_per_letter")
    asked = docs.drop(*added).withColumn("held_out", held_out(id_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parse = parser(sent.value)
        for whole in batches:
            for batch in slices(whole, text_col, PARSED_BYTES):
                names, score, bits = parse.predict([t or "" for t in batch.column(text_col).to_pylist()])
                columns = [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *added])

    schema = T.StructType([*asked.schema.fields, *(T.StructField(n, k) for n, k in zip(added, (T.StringType(), T.DoubleType(), T.DoubleType())))])
    return map_arrow(asked, run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_letter) of each row, as in :func:`with_language`."""
    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    return with_language(asked).select("doc_id", "held_out", "lang_pred", "score", "bits_per_letter")
