"""Near duplicates by banded MinHash and sequential Bayesian verification.

1. Every whole text becomes its set of five-word shingles, a signature and
   band keys.  Texts with equal sets are one node from here on, so thousands
   of copies are one row.
2. Nodes that share a band key are candidates.  In each bucket all members are
   paired with one leader only: the member with the most company over all its
   buckets, which is the text that the others were derived from if it is there.
3. Candidate signatures are compared in batches.  With m of n equal hashes and
   a uniform prior the similarity is Beta(m + 1, n - m + 1) distributed; a
   pair goes when its chance of reaching the threshold falls below the chosen
   miss probability.
4. Survivors are verified exactly on their full sets.
5. Linked nodes are joined to components.  Pairs of one bucket whose members
   are not in one component yet were not tested by (2): blocks of a bucket go
   through (3) and (4) with each other now, each pair in the first band that
   it shares, and the components are completed.

Rows that leave a step are members or links that join components, never the
pairs of a bucket; no bucket, candidate or partner is cut off.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amihan.llm.common import map_arrow, raw_bytes, ship_package, slices, stored
from amihan.llm.components import components
from amihan.llm.shingles import mix, shingle_set

BAND_ROWS = 4
#: Chance that a pair just at the threshold shares no band.
BAND_MISS = 1e-5
#: Chance of reaching the threshold below which a candidate is given up.
PRUNE_MISS = 1e-6
BATCH = 16
#: Members of one block of a bucket in step 5, and pairs of one verifying group.
BLOCK = 512
GROUP = 512
SHINGLES_AT_ONCE = 4096


def number_of_bands(threshold: float) -> int:
    return math.ceil(math.log(BAND_MISS) / math.log(1 - threshold**BAND_ROWS))


def least_matches(threshold: float, hashes: int) -> np.ndarray:
    """For each number n of compared hashes the fewest equal ones that keep a pair."""
    out = np.zeros(hashes + 1, np.int64)
    for n in range(1, hashes + 1):
        total, m = 0.0, -1
        while total < PRUNE_MISS and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def _multipliers(hashes: int) -> np.ndarray:
    return mix(np.arange(1, hashes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The smallest of each hash over a set, 32 bits each."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), SHINGLES_AT_ONCE):
        some = shingles[None, at : at + SHINGLES_AT_ONCE] * multipliers[:, None]
        np.minimum(least, some.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def signatures(docs: DataFrame, id_col: str, text_col: str, bands: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, signature, keys) of each row; the set id is a digest of the set."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_id", pa.binary()), ("signature", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )
    multipliers = _multipliers(bands * BAND_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for text in raw_bytes(batch, "text"):
                    found = shingle_set(bytes(text))
                    if not len(found):
                        rows.append((0, None, None, None))
                        continue
                    own = signature(found, multipliers)
                    of_band = own.astype(np.uint64).reshape(bands, BAND_ROWS)
                    key = np.arange(1, bands + 1, dtype=np.uint64)
                    for k in range(BAND_ROWS):
                        key = mix(key ^ of_band[:, k])
                    rows.append((len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest(), own.tobytes(), key.view(np.int64).tolist()))
                columns = [batch.column("doc_id"), *(pa.array([r[i] for r in rows], schema.field(i + 1).type) for i in range(4))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(asked, run, "doc_id bigint, n_shingles bigint, set_id binary, signature binary, keys array<bigint>")


def _survivors(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which pairs of signatures outlast all batches."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    for at in range(0, left.shape[1], BATCH):
        equal = equal + (left[alive, at : at + BATCH] == right[alive, at : at + BATCH]).sum(axis=1)
        keep = equal >= least[min(at + BATCH, left.shape[1])]
        alive, equal = alive[keep], equal[keep]
    return alive


def prune(pairs: DataFrame, nodes: DataFrame, threshold: float, hashes: int) -> DataFrame:
    """The pairs (a, b) of node ids whose signatures leave them a chance."""
    least = least_matches(threshold, hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(-1, hashes) for c in ("a_signature", "b_signature")]
            yield batch.select(["a", "b"]).take(pa.array(_survivors(*sides, least)))

    side = lambda c: nodes.select(F.col("set_id").alias(c), F.col("signature").alias(f"{c}_signature"))
    return map_arrow(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_signature", "b_signature"), run, "a binary, b binary")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(set_id, shingles) of the nodes wanted (set_id, doc_id), from the texts again."""
    schema = pa.schema([("set_id", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                rows = []
                for text, set_id in zip(raw_bytes(batch, "text"), batch.column("set_id").to_pylist()):
                    found = shingle_set(bytes(text)).tobytes()
                    # Other texts under the same document id are other sets.
                    if hashlib.blake2b(found, digest_size=16).digest() == set_id:
                        rows.append((set_id, found))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary()) for i in range(2)], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = map_arrow(texts.join(wanted, "doc_id").select("set_id", "text"), run, "set_id binary, shingles binary")
    return found.groupBy("set_id").agg(F.first("shingles").alias("shingles"))


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union of their full sets.

    The first node of a pair is sent once to each group of its pairs, groups
    having a bounded number of rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    ends = pairs.select(F.col("a").alias("set_id")).union(pairs.select(F.col("b").alias("set_id"))).distinct()
    sets = stored(full_sets(docs, nodes.select("set_id", "doc_id").join(ends, "set_id"), id_col, text_col), "shingle-sets")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("groups"))
    members = pairs.join(groups, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group"), F.col("b").alias("set_id"))
    members = members.join(sets, "set_id")
    leaders = groups.select(F.col("a"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))
    leaders = leaders.join(sets.withColumnRenamed("set_id", "a"), "a")
    leaders = leaders.select(F.col("a").alias("leader"), F.col("group").alias("leader_group"), F.col("shingles").alias("own"))
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(members: pa.Table, leaders: pa.Table) -> pa.Table:
        linked = []
        if leaders.num_rows:
            a = leaders.column("leader")[0].as_py()
            own = np.frombuffer(leaders.column("own")[0].as_py(), np.uint64)
            for b, data in zip(members.column("set_id"), members.column("shingles")):
                other = np.frombuffer(data.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                common = int((own[place] == other).sum())
                if 100 * common >= percent * (len(own) + len(other) - common):
                    linked.append((a, b.as_py()))
        return pa.Table.from_arrays([pa.array([x[i] for x in linked], pa.binary()) for i in range(2)], schema=schema)

    return members.groupBy("a", "group").cogroup(leaders.groupBy("leader", "leader_group")).applyInArrow(compare, "a binary, b binary")


def _apart(group: pa.Table, least: np.ndarray, hashes: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member of a block pair its later partners that signatures leave a chance.

    Partners are in another component, have not been tested with the leader,
    and share no earlier band, where the pair comes up already.
    """
    columns = {c: group.column(c).to_numpy() for c in ("label", "block")}
    own = np.frombuffer(b"".join(group.column("signature").to_pylist()), "<u4").reshape(-1, hashes)
    keys = np.array(group.column("keys").to_pylist(), np.int64)[:, : group.column("band")[0].as_py()]
    leads = np.array([a == b for a, b in zip(group.column("set_id").to_pylist(), group.column("leader").to_pylist())])
    crossing = group.column("low")[0].as_py() != group.column("high")[0].as_py()
    for i in np.flatnonzero(~leads):
        to = np.arange(i + 1, group.num_rows)
        to = to[(columns["label"][to] != columns["label"][i]) & ~leads[to]]
        if crossing:
            to = to[columns["block"][to] != columns["block"][i]]
        to = to[~(keys[to] == keys[i]).any(axis=1)]
        yield i, to[_survivors(np.broadcast_to(own[i], (len(to), hashes)), own[to], least)]


def _blocks(labelled: DataFrame) -> DataFrame:
    """(band, key, label, start, blocks, all_blocks, alone): the blocks of each component in the buckets that hold several.

    Components of a block's size or more have blocks of their own, the others
    share blocks.  So a bucket that one large component fills, with few
    others, has as many pairs of blocks as blocks.
    """
    by = ["band", "key"]
    sizes = labelled.groupBy(*by, "label").agg(F.count("*").alias("n"))
    sizes = sizes.withColumns({"alone": F.col("n") >= BLOCK, "blocks": F.ceil(F.col("n") / BLOCK).cast("int")})
    mixed = sizes.groupBy(*by).agg(
        F.sum("n").alias("size"),
        F.count("*").alias("labels"),
        F.ceil(F.coalesce(F.sum(F.when(~F.col("alone"), F.col("n"))), F.lit(0)) / BLOCK).cast("int").alias("shared"),
        F.coalesce(F.sum(F.when(F.col("alone"), F.col("blocks"))), F.lit(0)).cast("int").alias("own"),
    )
    mixed = mixed.where("size > 2 and labels > 1").select(*by, "shared", (F.col("shared") + F.col("own")).alias("all_blocks"))
    placed = sizes.join(mixed, by)
    before = F.sum("blocks").over(Window.partitionBy(*by).orderBy("label")) - F.col("blocks")
    large = placed.where("alone").withColumn("start", (F.col("shared") + before).cast("int"))
    small = placed.where("not alone").withColumns({"start": F.pmod(F.xxhash64("label"), F.col("shared")).cast("int"), "blocks": F.lit(1)})
    return large.unionByName(small).drop("n", "shared")


def link_apart(
    buckets: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, hashes: int, id_col: str, text_col: str
) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different components yet.

    ``buckets`` are (band, key, set_id, leader) of all members, ``labels`` the
    component of each node.  Buckets are worked on in pairs of blocks of
    bounded size.  A first pass finds by signatures which members have a
    partner at all; for those the full sets are fetched and compared.  A block
    pair gives out members or a forest of links, never all its pairs.
    """
    ship_package(buckets.sparkSession)
    least = least_matches(percent / 100, hashes)
    labelled = buckets.join(labels, "set_id")
    rows = labelled.join(_blocks(labelled), ["band", "key", "label"])
    rows = rows.withColumn("block", F.col("start") + F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    rows = rows.join(nodes.select("set_id", "signature", "keys"), "set_id")
    rows = stored(rows, "apart")

    def in_pairs(members: DataFrame) -> DataFrame:
        """Each member once for each block that its own is compared with; blocks of one component aren't with each other."""
        others = F.filter(
            F.sequence(F.lit(0), F.col("all_blocks") - 1),
            lambda b: ~F.col("alone") | (b < F.col("start")) | (b >= F.col("start") + F.col("blocks")),
        )
        paired = members.select("*", F.explode(others).alias("other"))
        paired = paired.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        return paired.drop("other", "start", "blocks", "all_blocks", "alone")

    def with_partner(group: pa.Table) -> pa.Table:
        found: set[int] = set()
        for i, to in _apart(group, least, hashes):
            if len(to):
                found |= {int(i), *to.tolist()}
        return group.select(["set_id"]).take(pa.array(sorted(found), pa.int64()))

    by = ["band", "key", "low", "high"]
    wanted = stored(in_pairs(rows).groupBy(*by).applyInArrow(with_partner, "set_id binary").distinct(), "apart")
    sets = full_sets(docs, nodes.select("set_id", "doc_id").join(wanted, "set_id"), id_col, text_col)
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def compare(group: pa.Table) -> pa.Table:
        ids, root = group.column("set_id").to_pylist(), list(range(group.num_rows))
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
        linked = []

        def top(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for i, to in _apart(group, least, hashes):
            for j in to.tolist():
                x, y = sets[i], sets[j]
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)) or top(i) == top(j):
                    continue
                place = np.minimum(np.searchsorted(x, y), len(x) - 1)
                common = int((x[place] == y).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    linked.append((ids[i], ids[j]))
                    root[top(i)] = top(j)
        return pa.Table.from_arrays([pa.array([r[c] for r in linked], pa.binary()) for c in range(2)], schema=schema)

    return in_pairs(rows.join(sets, "set_id")).groupBy(*by).applyInArrow(compare, "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row: linked where 100 * intersection >= percent * union.

    The component is the smallest id reachable through links, the row of that
    id is kept.  Null and empty texts, and texts without words, have no
    shingles and link with nothing.  Rows that repeat an id are one document:
    what any of them links to is one component.  Rows without an id link with
    nothing, have no component and are kept.  An empty table gives no rows;
    other columns take no part.
    """
    threshold = percent / 100
    bands = number_of_bands(threshold)
    hashes = bands * BAND_ROWS
    signed = stored(signatures(docs, id_col, text_col, bands), "signatures")
    usable = signed.where("set_id is not null and doc_id is not null")
    nodes = stored(
        usable.groupBy("set_id").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"), F.first("keys").alias("keys")), "sets"
    )
    banded = nodes.select("set_id", "doc_id", F.posexplode("keys").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(banded.join(shared, ["band", "key"]), "members")
    # The text that others were derived from shares more buckets with them than they share among themselves.
    company = members.groupBy(F.col("set_id").alias("of")).agg(F.sum("size").alias("company"))
    ranked = members.join(company, F.col("set_id") == F.col("of")).drop("of")
    leaders = ranked.groupBy("band", "key").agg(F.max_by("set_id", F.struct("company", -F.col("doc_id"))).alias("leader"))
    buckets = stored(members.select("band", "key", "set_id").join(leaders, ["band", "key"]), "buckets")
    stars = buckets.where("leader <> set_id").select(F.col("leader").alias("a"), F.col("set_id").alias("b")).distinct()
    first = stored(verified(stored(prune(stars, nodes, threshold, hashes), "candidates"), docs, nodes, percent, id_col, text_col), "links")
    # Ids that share a set, or sets that share an id, are linked through the set's smallest id.
    copies = usable.join(nodes.select("set_id", F.col("doc_id").alias("v")), "set_id").select(F.col("doc_id").alias("u"), "v").where("u <> v")

    def as_edges(links: DataFrame) -> DataFrame:
        side = lambda c, to: nodes.select(F.col("set_id").alias(c), F.col("doc_id").alias(to))
        return links.join(side("a", "u"), "a").join(side("b", "v"), "b").select("u", "v")

    found = components(as_edges(first).union(copies))
    named = nodes.join(found.withColumnsRenamed({"u": "doc_id", "v": "smallest"}), "doc_id", "left")
    labels = named.select("set_id", F.coalesce("smallest", "doc_id").alias("label"))
    second = stored(link_apart(buckets, labels, nodes, docs, percent, hashes, id_col, text_col), "links")
    if not second.isEmpty():
        found = components(as_edges(second).union(found))
    out = signed.select("doc_id", "n_shingles").join(found.withColumnsRenamed({"u": "doc_id", "v": "smallest"}), "doc_id", "left")
    component = F.coalesce("smallest", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
