"""Exact removal of long repeated strings across documents, by run-length indexes.

A byte goes if a string of 50 bytes that covers it also starts in a document
with a smaller id.  Documents lie in shards: ranges of ids of about equal
bytes, so an earlier shard means a smaller id.

1. Each shard parts all 50-byte windows into groups by their anchor (see
   window_groups) and sends the hashes of its distinct groups and their sides.
2. By anchor it is found which groups also occur in an earlier shard - all
   their windows go - and which share a side with one of different bytes: a
   common window holds the anchor and at least half of what it has beside it on
   one side, so only those can have windows in common.  Grams that texts share
   by chance, of which there are ever more in more texts, are done here.
3. Each shard sends the spans that are decided, and the bytes of the first
   occurrence of each undecided group, with the list of the other places the
   group has in that document or in rows that repeat its id: what is found of
   the one sent goes at all of them.
4. The undecided groups of one anchor are ranked by document.  For each binary
   digit of the rank a run-length index is built of groups with digit 0, and
   those with digit 1 are streamed against the index of their own higher
   digits: their matching statistics tell which windows start in an earlier
   document.  Any two groups meet at one digit.  The hashes of the windows tell
   which must: a group and the first ones that have its first and its last
   window of those found before it.  A group of which the index does not find
   both meets all groups before it.
   An anchor with more bytes of undecided groups than one index may hold is
   too common for one task: its windows are dealt by their own hashes instead.
5. The documents are dealt to their shards again, and the spans are cut out.

Shards, and pieces of very long texts in them, have bounded size; of what many
documents share only one row a shard travels.  What a step finds is stored
without the texts, and its shuffle files are freed before the next step deals
the texts: the disk holds one dealing of them at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amihan.llm.common import block_of, give_back, raw_bytes, ship_package, stored
from amihan.llm.run_index import RunIndex
from amihan.llm.shingles import mix
from amihan.llm.window_groups import GRAM, POWER, Groups, powers, window_groups
from amihan.operators.skew import hot_groups, join_groups

SHARD_BYTES = 20 << 20
#: Bytes hashed at once; longer texts are cut into pieces that overlap by a window.
SLICE_BYTES = 256 << 10
#: Bytes of undecided groups in one index, about; an anchor with more is dealt by windows.
INDEX_BYTES = 12 << 20
#: Bytes of groups in one task's index at a time, about; an anchor is never cut.
INDEXED = 3 << 20
#: Groups of a shard whose bytes are copied at once.
COPIED = 32_768
#: Groups that are streamed at once.
STREAMED = 32_768
#: Places of one group that a row lists; a group with more is sent in several rows.
PLACES = 8_192
MAX_ID = (1 << 63) - 1
#: A decided span (kind 0), or an undecided group with its other places (kind 1).
MARKED = "kind int, uid bigint, begin bigint, end bigint, text binary, anchor bigint, place int, key bigint, more_uids array<bigint>, more_starts array<bigint>"


def _shards(rows: DataFrame, shard_bytes: int) -> list[int]:
    """The largest key of each shard, descending: fine ranges of ids, joined until they hold enough bytes."""
    sizes = rows.select("key", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    fine = 4 * (total // shard_bytes + 1)
    # A few rows for each shard.
    ranges = sizes.repartitionByRange(int(fine), "key").groupBy(F.spark_partition_id().alias("part"))
    found = sorted((r["high"], r["size"]) for r in ranges.agg(F.max("key").alias("high"), F.sum("size").alias("size")).collect())
    ends: list[int] = []
    held = 0
    for high, size in found:
        if ends and held + size <= shard_bytes:
            ends[-1] = high
            held += size
        else:
            ends.append(high)
            held = size
    return ends[::-1] or [0]


def _pieces(texts: list[memoryview], length: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, borders, document of each piece, its place there) of slices of bounded size."""
    held: list[memoryview] = []
    docs: list[int] = []
    places: list[int] = []
    size = 0

    def slice_():
        borders = np.concatenate(([0], np.cumsum([len(h) for h in held])))
        return b"".join(held), borders, np.array(docs), np.array(places)

    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), SLICE_BYTES):
            piece = text[at : at + SLICE_BYTES + length - 1]
            if size + len(piece) > SLICE_BYTES and held:
                yield slice_()
                held, docs, places, size = [], [], [], 0
            held.append(piece)
            docs.append(i)
            places.append(at)
            size += len(piece)
    if held:
        yield slice_()


def _all_groups(texts: list[memoryview], length: int) -> Groups:
    """The groups of all documents of a shard; starts count from the document's first byte."""
    parts = []
    for data, borders, docs, places in _pieces(texts, length):
        g = window_groups(np.frombuffer(data, np.uint8), borders, length)
        doc, start = (docs[g.doc], g.start - borders[g.doc] + places[g.doc]) if len(g.start) else (g.doc, g.start)
        parts.append((doc, start, g.windows, g.anchor, g.content, g.place, g.before, g.after))
    if not parts:
        return window_groups(np.empty(0, np.uint8), np.zeros(1, np.int64), length)
    return Groups(*(np.concatenate(c) for c in zip(*parts)))


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by spans."""
    if not len(begins):
        return begins, ends
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.concatenate(([True], begins[1:] > reach[:-1]))
    return begins[new], reach[np.concatenate((new[1:], [True]))]


def _in_order(docs: pa.Table) -> tuple[pa.Table, list[memoryview], np.ndarray]:
    """A shard's documents and their texts, and where each begins if they lie one after the other with gaps.

    A document's place is the same each time the shard is dealt: only rows with
    equal ids and equal texts, of which the same bytes go, may change places.
    """
    docs = docs.sort_by([("key", "ascending"), ("text", "ascending")]).combine_chunks()
    texts = [t for batch in docs.to_batches() for t in raw_bytes(batch, "text")]
    lengths = np.array([len(t) + 1 for t in texts])
    return docs, texts, np.cumsum(lengths) - lengths


def _cut(text: memoryview, begins: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    """(bytes removed, runs, digest of what stays)."""
    digest, at = hashlib.sha256(), 0
    for b, e in zip(begins.tolist(), ends.tolist()):
        digest.update(text[at:b])
        at = e
    digest.update(text[at:])
    return int((ends - begins).sum()), len(begins), digest.hexdigest()


def _hashes(data: list[bytes | None], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(d for d in data if d), kind)


def send_groups(length: int, buckets: int):
    """Step 1: of each shard the distinct groups, packed by bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("contents", pa.binary()), ("befores", pa.binary()), ("afters", pa.binary())])

    def run(docs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        texts = [t for batch in docs.to_batches() for t in raw_bytes(batch, "text")]
        g = _all_groups(texts, length)
        # Groups of one content have one anchor and equal sides.
        order = np.argsort(g.content)
        content = g.content[order]
        order = order[np.concatenate(([True], content[1:] != content[:-1]))] if len(order) else order
        bucket = g.anchor[order] % np.uint32(buckets)
        by = np.argsort(bucket, kind="stable")
        order, borders = order[by], np.searchsorted(bucket[by], np.arange(buckets + 1))
        sent = [x[order] for x in (g.content, g.before, g.after)]
        shard = docs.column("shard")[0].as_py()
        rows = [(b, shard, *(s[x:y].tobytes() for s in sent)) for b, (x, y) in enumerate(zip(borders, borders[1:])) if y > x]
        return pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return run


def _repeated(side: np.ndarray) -> np.ndarray:
    """Whether a group has a side, and another one has the same."""
    order = np.argsort(side)
    same = side[order]
    same = (same[1:] == same[:-1]) & (same[1:] != 0)
    out = np.zeros(len(side), bool)
    out[order[1:]] = same
    out[order[:-1]] |= same
    return out


def decide(rows: pa.Table) -> pa.Table:
    """Step 2: for each shard the groups of a bucket that an earlier shard has, and its first ones that stay undecided.

    A group of which no other one of different bytes has a side is done.  Equal
    hashes of different sides leave a group undecided in vain.
    """
    schema = pa.schema([("shard", pa.int32()), ("gone", pa.binary()), ("undecided", pa.binary())])
    rows = rows.sort_by("shard")
    contents, befores, afters = (_hashes(rows.column(c).to_pylist(), kind) for c, kind in (("contents", "<u8"), ("befores", "<u4"), ("afters", "<u4")))
    counts = pa.compute.binary_length(rows.column("contents")).to_numpy() // 8
    shards = np.repeat(rows.column("shard").to_numpy(), counts)
    # Stable: of equal groups the earliest shard's is first.
    order = np.argsort(contents, kind="stable")
    same = contents[order]
    first = np.concatenate(([True], same[1:] != same[:-1]))
    gone, firsts = order[~first], order[first]
    open_ = firsts[_repeated(befores[firsts]) | _repeated(afters[firsts])]
    # Groups lie in the order of shards.
    gone, open_ = np.sort(gone), np.sort(open_)
    named = np.unique(shards)
    borders = [np.searchsorted(shards[x], np.append(named, named[-1:] + 1)) for x in (gone, open_)]
    out = []
    for i, shard in enumerate(named.tolist()):
        g, o = (contents[x[at[i] : at[i + 1]]] for x, at in zip((gone, open_), borders))
        if len(g) or len(o):
            out.append((shard, g.tobytes(), o.tobytes()))
    return pa.Table.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(schema)], schema=schema)


def mark(length: int):
    """Step 3: the decided spans of a shard, and the bytes of its undecided groups."""
    schema = pa.schema(
        [("kind", pa.int32()), ("uid", pa.int64()), ("begin", pa.int64()), ("end", pa.int64()), ("text", pa.binary()), ("anchor", pa.int64()), ("place", pa.int32()), ("key", pa.int64()), ("more_uids", pa.list_(pa.int64())), ("more_starts", pa.list_(pa.int64()))]
    )

    def table(n: int, kind: int, **columns) -> pa.Table:
        columns["kind"] = np.full(n, kind, np.int32)
        arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema]
        return pa.Table.from_arrays(arrays, schema=schema)

    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return schema.empty_table()
        give_back()
        docs, texts, at_of = _in_order(docs)
        keys, shard = docs.column("key").to_numpy(), docs.column("shard")[0].as_py()
        g = _all_groups(texts, length)
        gone = np.sort(_hashes(replies.column("gone").to_pylist(), "<u8"))
        open_ = np.sort(_hashes(replies.column("undecided").to_pylist(), "<u8"))

        def listed(sorted_: np.ndarray) -> np.ndarray:
            if not len(sorted_):
                return np.zeros(len(g.content), bool)
            return sorted_[np.minimum(np.searchsorted(sorted_, g.content), len(sorted_) - 1)] == g.content

        covered = listed(gone)
        # Groups lie in the order of keys, which a stable sort keeps.
        order = np.argsort(g.content, kind="stable")
        content = g.content[order]
        first = np.concatenate(([True], content[1:] != content[:-1])) if len(order) else np.empty(0, bool)
        owner = keys[g.doc[order]][first][np.cumsum(first) - 1] if len(order) else np.empty(0, np.int64)
        covered[order] |= keys[g.doc[order]] > owner
        # The places of an undecided group under its owner's key, which come first of its places.
        waits = listed(open_) & ~covered
        held = order[waits[order]]
        place = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(order) else order
        heads = np.flatnonzero(place[waits[order]] % PLACES == 0)
        tails = np.append(heads[1:], len(held))
        at = at_of[g.doc[covered]] + g.start[covered]
        begins, ends = _merged(at, at + g.windows[covered] + length - 1)
        doc = np.searchsorted(at_of, begins, side="right") - 1
        tables = [table(len(doc), 0, uid=(shard << 32) + doc, begin=begins - at_of[doc], end=ends - at_of[doc])]
        inner = np.argsort(held[heads])
        for at in range(0, len(inner), COPIED):
            some = inner[at : at + COPIED]
            first_of = held[heads[some]]
            more = [held[x + 1 : y] for x, y in zip(heads[some].tolist(), tails[some].tolist())]
            starts, stops = g.start[first_of], g.start[first_of] + g.windows[first_of] + length - 1
            where = g.doc[first_of]
            tables.append(
                table(
                    len(some),
                    1,
                    uid=(shard << 32) + where,
                    text=[bytes(texts[i][x:y]) for i, x, y in zip(where.tolist(), starts.tolist(), stops.tolist())],
                    anchor=g.anchor[first_of],
                    place=g.place[first_of],
                    key=keys[where],
                    begin=starts,
                    end=stops,
                    more_uids=[((shard << 32) + g.doc[m]).tolist() if len(m) else None for m in more],
                    more_starts=[g.start[m].tolist() if len(m) else None for m in more],
                )
            )
        return pa.concat_tables(tables)

    return run


def _shares_a_side(data: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, anchor: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """Whether a group has the bytes beside its anchor, before or after it, in common with another group of the anchor.

    Windows of two groups can only be equal if it has: of the bytes of a window
    beside the anchor, at least half are on one side.  Equal hashes of
    different bytes let a group through in vain.
    """
    half = (length - GRAM + 1) // 2
    out = np.zeros(len(anchor), bool)
    for begin in (place - half, place + GRAM):
        some = np.flatnonzero((begin >= 0) & (begin + half <= lengths))
        at, key = (offsets + begin)[some], anchor[some].astype(np.uint64)
        for k in range(half):
            key *= np.uint64(POWER)
            key += data[at + k]
        _, which, counts = np.unique(mix(key), return_inverse=True, return_counts=True)
        out[some] |= counts[which] > 1
    return out


def _likely(data: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, anchor: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, window, group): the first and the last window of a group whose hash a group of lower rank has, and the first such group.

    Groups come in the order of anchors and ranks.
    """
    n = lengths - length + 1
    group = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    # Powers count from the begin of each group.
    most = int(lengths.max())
    times, back = powers(most, POWER), powers(most, pow(POWER, -1, 1 << 64))
    keys = []
    for x in range(0, len(n), COPIED):
        size, own = lengths[x : x + COPIED], n[x : x + COPIED]
        ends = np.cumsum(size)
        within = np.arange(ends[-1]) - np.repeat(ends - size, size)
        product = data[np.repeat(offsets[x : x + COPIED], size) + within] + np.uint64(1)
        product *= times[within]
        sums = np.zeros(len(product) + 1, np.uint64)
        np.cumsum(product, out=sums[1:])
        inside = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        start = np.repeat(ends - size, own) + inside
        keys.append(mix((sums[start + length] - sums[start]) * back[inside]))
    key = np.concatenate(keys)
    # Stable: of equal windows of an anchor the one of the lowest rank is first.
    order = np.argsort(key, kind="stable")
    key, of = key[order], anchor[group[order]]
    new = np.concatenate(([True], (key[1:] != key[:-1]) | (of[1:] != of[:-1])))
    owner = np.empty(len(key), np.int64)
    owner[order] = group[order[new]][np.cumsum(new) - 1]
    some = np.flatnonzero(rank[owner] < rank[group])
    ends = np.concatenate(([True], group[some][1:] != group[some][:-1]))
    some = np.concatenate([some[ends], some[np.append(ends[1:], True)]]) if len(some) else some
    return group[some], place[some], owner[some]


def match_groups(length: int):
    """Step 4: which windows of a bucket's undecided groups start in an earlier document, at each place of the group.

    A group is shorter than two windows, so its windows overlap or touch: from
    the first found to the last all bytes are covered.
    """
    schema = pa.schema([("uid", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])

    def run(rows: pa.Table) -> pa.Table:
        give_back()
        texts = rows.column("text").to_pylist()
        lengths = np.array([len(t) for t in texts])
        offsets = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(texts), np.uint8)
        del texts
        near = _shares_a_side(data, offsets, lengths, rows.column("anchor").to_numpy(), rows.column("place").to_numpy(), length)
        if not near.any():
            return schema.empty_table()
        rows, lengths, offsets = rows.filter(pa.array(near)), lengths[near], offsets[near]
        anchor, key = rows.column("anchor").to_numpy(), rows.column("key").to_numpy()
        uid, start = rows.column("uid").to_numpy(), rows.column("begin").to_numpy()
        n_more = pa.compute.list_value_length(rows.column("more_uids")).fill_null(0).to_numpy()
        more_uids, more_starts = (pa.compute.list_flatten(rows.column(c)).to_numpy() for c in ("more_uids", "more_starts"))
        order = np.lexsort((key, anchor))
        new = np.concatenate(([True], anchor[order][1:] != anchor[order][:-1]))
        # Groups of one document have one rank and never meet.
        document = np.cumsum(new | np.concatenate(([True], key[order][1:] != key[order][:-1])))
        rank = np.empty(len(order), np.int64)
        rank[order] = document - document[np.flatnonzero(new)][np.cumsum(new) - 1]
        low, high = np.full(len(order), MAX_ID), np.zeros(len(order), np.int64)

        # Symbols of different blocks differ, so a group matches only where it should.
        def joined(some: np.ndarray, block: np.ndarray) -> np.ndarray:
            """The groups one after the other, each with a stop."""
            room = lengths[some] + 1
            ends = np.cumsum(room)
            source = np.repeat(offsets[some] - ends + room, room)
            source += np.arange(len(source))
            source[ends - 1] = 0
            symbols = data[source].astype(np.int64)
            symbols += np.repeat(257 * block + 1, room)
            symbols[ends - 1] = 0
            return symbols

        def rows_of(some: np.ndarray, block: np.ndarray) -> np.ndarray:
            within = np.arange(lengths[some].max())[None, :]
            symbols = data[np.minimum(offsets[some][:, None] + within, len(data) - 1)] + (257 * block + 1)[:, None]
            return np.where(within < lengths[some][:, None], symbols, 0)

        def meet(asking: np.ndarray, held: np.ndarray, digit: int) -> None:
            """Streams groups with the digit 1 against an index of those of their blocks with 0."""
            asked, kept = rank[asking] >> (digit + 1), rank[held] >> (digit + 1)
            # Most anchors have one block only; apart from the others, symbols are bytes and sort faster.
            for first_block in (True, False):
                stream, own = asking[(asked == 0) == first_block], held[(kept == 0) == first_block]
                if not len(stream) or not len(own):
                    continue
                index = RunIndex(joined(own, rank[own] >> (digit + 1)))
                stream = stream[np.argsort(-lengths[stream], kind="stable")]
                for at in range(0, len(stream), STREAMED):
                    some = stream[at : at + STREAMED]
                    hits = index.matching_statistics(rows_of(some, rank[some] >> (digit + 1)), lengths[some]) >= length
                    any_ = hits.any(axis=1)
                    some, hits = some[any_], hits[any_]
                    low[some] = np.minimum(low[some], hits.argmax(axis=1))
                    high[some] = np.maximum(high[some], hits.shape[1] - 1 - hits[:, ::-1].argmax(axis=1) + length)

        firsts = np.flatnonzero(new)
        sizes = np.add.reduceat(lengths[order], firsts)
        slices = (np.cumsum(sizes) - sizes) // INDEXED
        borders = np.append(firsts[np.flatnonzero(np.concatenate(([True], slices[1:] != slices[:-1])))], len(order))
        for x, y in zip(borders.tolist(), borders[1:].tolist()):
            members = order[x:y]
            asking, at, held = _likely(data, offsets[members], lengths[members], anchor[members], rank[members], length)
            if not len(asking):
                continue
            asks, holds = members[asking], members[held]
            # Ranks are below 2 ** 53, so the exponent is the highest digit that differs.
            digits = np.frexp((rank[asks] ^ rank[holds]).astype(np.float64))[1] - 1
            for digit in np.unique(digits).tolist():
                some = digits == digit
                meet(np.unique(asks[some]), np.unique(holds[some]), digit)
            # Equal hashes of different windows: the group meets all groups before it.
            left = np.unique(asks[(low[asks] > at) | (high[asks] < at + length)])
            for digit in range(int(rank[left].max()).bit_length() if len(left) else 0):
                some = left[(rank[left] >> digit & 1) == 1]
                own = members[(rank[members] >> digit & 1) == 0]
                pair = anchor[own] << 31 | rank[own] >> (digit + 1)
                meet(some, own[np.isin(pair, anchor[some] << 31 | rank[some] >> (digit + 1))], digit)
        group = np.flatnonzero(high)
        begin, end = low[group], high[group]
        n = n_more[group]
        other = np.arange(n.sum()) + np.repeat((np.cumsum(n_more) - n_more)[group] - np.cumsum(n) + n, n)
        uids, starts = np.concatenate([uid[group], more_uids[other]]), np.concatenate([start[group], more_starts[other]])
        begin, end = (np.concatenate([x, np.repeat(x, n)]) for x in (begin, end))
        return pa.Table.from_arrays([pa.array(uids), pa.array(starts + begin), pa.array(starts + end)], schema=schema)

    return run


def common_windows(groups: DataFrame, length: int) -> DataFrame:
    """(uid, begin, end) of what the windows of groups that start in an earlier document cover, found by the windows' hashes.

    The earliest document of each window is aggregated before the shuffle and
    joined back, a window with very many places in parts.  What is found of a
    group (see match_groups) goes to all its places.
    """
    groups = groups.withColumnRenamed("begin", "start")
    windows = groups.select("uid", "key", "start", "text", F.explode(F.sequence(F.lit(0), F.octet_length("text") - length)).alias("place"))
    window = F.substring("text", F.col("place") + 1, F.lit(length))
    windows = windows.select("uid", "key", "start", "place", F.xxhash64(window).alias("h1"), F.xxhash64(F.lit(length), window).alias("h2"))
    by = ["h1", "h2"]
    first = windows.groupBy(*by).agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("places"))
    first = first.where("`first` < `last`").drop("last")
    found = join_groups(windows, first.drop("places"), by, F.struct("uid", "start", "place"), hot_groups(first, by, "places"))
    runs = found.where("key > `first`").groupBy("uid", "start").agg(F.min("place").alias("low"), F.max("place").alias("high"))
    more = groups.where("more_uids is not null").select("uid", "start", F.arrays_zip("more_uids", "more_starts").alias("more"))
    own = F.struct(F.col("uid").alias("more_uids"), F.col("start").alias("more_starts"))
    places = F.explode(F.concat(F.array(own), F.coalesce("more", F.array().cast("array<struct<more_uids:bigint,more_starts:bigint>>"))))
    at = runs.join(more, ["uid", "start"], "left").select(places.alias("at"), "low", "high")
    begin = F.col("at.more_starts") + F.col("low")
    return at.select(F.col("at.more_uids").alias("uid"), begin.alias("begin"), (begin - F.col("low") + F.col("high") + length).alias("end"))


def cut_spans(docs: pa.Table, spans: pa.Table) -> pa.Table:
    """Step 5: a shard's documents without their spans."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    if not docs.num_rows:
        return schema.empty_table()
    give_back()
    docs, texts, at_of = _in_order(docs)
    at = at_of[spans.column("uid").to_numpy() & 0xFFFFFFFF]
    begins, ends = _merged(at + spans.column("begin").to_numpy(), at + spans.column("end").to_numpy())
    borders = np.append(np.searchsorted(begins, at_of), len(begins)).tolist()
    out = [_cut(t, begins[x:y] - at, ends[x:y] - at) for t, at, x, y in zip(texts, at_of.tolist(), borders, borders[1:])]
    columns = [docs.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), *(pa.array([r[k] for r in out], schema.field(k + 2).type) for k in range(3))]
    return pa.Table.from_arrays(columns, schema=schema)


def remove_repeats(
    docs: DataFrame,
    length: int = 50,
    shard_bytes: int = SHARD_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, the digest being of the bytes that stay.

    Texts are UTF-8 bytes; a null text is empty; texts shorter than the length
    keep all.  Rows that repeat an id are documents of the same rank: neither
    removes from the other.  A null id ranks after all others.  An empty table
    gives no rows; other columns take no part.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(MAX_ID)).alias("key"),
    )
    shard_ends = _shards(rows, shard_bytes)
    shard: Column = F.lit(len(shard_ends) - 1) - block_of(F.col("key"), shard_ends)
    dealt = rows.withColumn("shard", shard.cast("int"))
    buckets = len(shard_ends)
    sent = dealt.select("shard", "text").groupBy("shard").applyInArrow(
        send_groups(length, buckets), "bucket int, shard int, contents binary, befores binary, afters binary"
    )
    replies = sent.groupBy("bucket").applyInArrow(decide, "shard int, gone binary, undecided binary")
    replies = stored(replies.select(F.col("shard").alias("to"), "gone", "undecided"), "repeat-replies", free=True)
    marked = dealt.groupBy("shard").cogroup(replies.groupBy("to")).applyInArrow(mark(length), MARKED)
    marked = stored(marked, "repeats", free=True)
    groups = marked.where("kind = 1").drop("kind", "end")
    of_anchor = groups.groupBy("anchor").agg(F.sum(F.octet_length("text")).alias("size"))
    common = stored(of_anchor.where(F.col("size") > index_bytes).select("anchor"), "common-grams", free=True)
    by_windows = not common.isEmpty()
    indexed = groups.join(common, "anchor", "left_anti") if by_windows else groups
    size = indexed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Several for each index, so that tasks are even.
    parts = 4 * (size // index_bytes + 1)
    found = indexed.withColumn("bucket", F.pmod("anchor", F.lit(parts))).groupBy("bucket")
    found = found.applyInArrow(match_groups(length), "uid bigint, begin bigint, end bigint")
    if by_windows:
        found = found.unionByName(common_windows(groups.join(common, "anchor", "left_semi"), length))
    found = stored(found, "repeat-spans", free=True)
    spans = marked.where("kind = 0").select("uid", "begin", "end").unionByName(found)
    spans = spans.withColumn("to", F.shiftright("uid", 32).cast("int"))
    names = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return dealt.groupBy("shard").cogroup(spans.groupBy("to")).applyInArrow(cut_spans, names)
