"""Exact top-k by inner product without random access.

Each dimension is a list of the candidates sorted by that component.  A query
reads every list from the end that helps it (the top where its own component
is positive), a stretch per round.  What has been read gives a candidate a
lower and an upper bound: an unread component lies between where the list has
been read to and the list's far end.  A query stops when no candidate outside
its best k can reach their k-th lower bound any more; then the scores of all
that still can are resolved exactly.

Candidates and queries are dealt into blocks of fixed numbers of rows, each
pair of blocks is one task's work on bounded memory, and blocks hold the
bounds of all their pairs as matrices.  Within a pair the candidates go by in
parts, later parts starting from the k-th best score so far.  Work is that of
a stated query set against all rows; what leaves a pair is k rows a query.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from amihan.llm.common import ship_package

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16_384
PART = 2048
#: How much of each list has been read after each round; the last round reads all.
ROUNDS = (0.125, 0.25, 0.5, 0.75, 1.0)
#: Sums of up to 2 ** 53 are exact in double precision; beyond, bounds are widened by their rounding error.
ROUNDING = 2.0**-48


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, n_queries: int, k: int) -> None:
        self.k = k
        self.found: list[list[tuple[int, int]]] = [[] for _ in range(n_queries)]
        self.floor = np.full(n_queries, -np.inf)

    def offer(self, query: int, pairs: list[tuple[int, int]]) -> None:
        """Pairs are (minus score, id)."""
        kept = sorted(self.found[query] + pairs)[: self.k]
        self.found[query] = kept
        if len(kept) == self.k:
            self.floor[query] = -kept[-1][0]


def _scan(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> None:
    """One part of the candidates against all queries of a block."""
    n, dims = vectors.shape
    values = vectors.astype(np.float64)
    order = np.argsort(values, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n)[:, None], axis=0)
    ordered = np.take_along_axis(values, order, axis=0)
    own = {int(i): j for j, i in enumerate(ids)}
    active = np.arange(len(queries))
    gain = np.maximum(queries, 0).astype(np.float64)
    loss = np.minimum(queries, 0).astype(np.float64)
    known = np.zeros((n, len(queries)))
    read = 0
    slack = ROUNDING * (np.abs(values).max(axis=0, initial=0) @ np.abs(queries).T.astype(np.float64))
    for share in ROUNDS:
        depth = n if share == 1.0 else max(read, int(n * share))
        # Components newly read: from the top for positive query components, from the bottom for negative ones.
        top = (place >= n - depth) & (place < n - read)
        bottom = (place < depth) & (place >= read)
        known += (values * top) @ gain[active].T + (values * bottom) @ loss[active].T
        read = depth
        if read < n:
            unread_top, unread_bottom = (place < n - read).astype(np.float64), (place >= read).astype(np.float64)
            next_top, next_bottom = ordered[n - read - 1], ordered[read]
            upper = known + unread_top @ (gain[active] * next_top).T + unread_bottom @ (loss[active] * next_bottom).T
            lower = known + unread_top @ (gain[active] * ordered[0]).T + unread_bottom @ (loss[active] * ordered[-1]).T
        else:
            upper = lower = known
        upper = upper + slack[active]
        for column, query in enumerate(active):
            if (self_at := own.get(int(query_ids[query]))) is not None:
                upper[self_at, column] = -np.inf
        if read < n:
            others = lower - slack[active]
            for column, query in enumerate(active):
                if (self_at := own.get(int(query_ids[query]))) is not None:
                    others[self_at, column] = -np.inf
            floor = np.partition(others, n - best.k, axis=0)[n - best.k] if n > best.k else np.full(len(active), -np.inf)
            floor = np.maximum(floor, best.floor[active])
        else:
            # All is read: at most the k best and their ties are left to resolve.
            floor = np.partition(upper, n - best.k, axis=0)[n - best.k] - 2 * slack[active] if n > best.k else np.full(len(active), -np.inf)
            floor = np.maximum(floor, best.floor[active])
        able = (upper >= floor) & (upper > -np.inf)
        left = able.sum(axis=0)
        # Outsiders can no longer qualify when about as many are able as are wanted; ties are resolved with them.
        done = (left <= 4 * best.k) if read < n else np.ones(len(active), bool)
        for column in np.flatnonzero(done):
            query = int(active[column])
            rows = np.flatnonzero(able[:, column])
            scores = vectors[rows] @ queries[query]
            best.offer(query, [(-int(s), int(i)) for s, i in zip(scores, ids[rows])])
        if done.all():
            return
        active, known = active[~done], known[:, ~done]


def pair_of_blocks(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(rows: pa.Table) -> np.ndarray:
        flat = rows.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(rows.num_rows, -1)

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        ids, vectors = candidates.column("vec_id").to_numpy(), matrix(candidates)
        query_ids, wanted = queries.column("vec_id").to_numpy(), matrix(queries)
        best = Best(len(query_ids), k)
        for begin in range(0, len(ids), PART):
            _scan(ids[begin : begin + PART], vectors[begin : begin + PART], query_ids, wanted, best)
        rows = [(int(q), i, -s) for q, found in zip(query_ids, best.found) for s, i in found]
        return pa.Table.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], schema=schema)

    return run


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, vector): components as floor(scale * x); a row for each id, the smallest vector if ids repeat."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vector"))
    return rows.where(F.size("vector") > 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest integer inner products, ties to the smaller id.

    ``is_query`` is a condition on ``vec_id``.  Vectors that are null, empty
    or hold null or non-finite components take no part, nor do null ids; ids
    that repeat count once, with their smallest vector; vectors of another
    length than the query's are no candidates.  Scores must fit 64 bits.
    Fewer than k candidates are all returned; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = whole_vectors(vectors, id_col, vector_col, scale).withColumn("dims", F.size("vector"))
    # Two counts fix the numbers of blocks.
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    n_blocks = max(1, -(-sizes["n"] // CANDIDATE_BLOCK))
    q_blocks = max(1, -(-sizes["q"] // QUERY_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.where(is_query).withColumn("q_block", block(q_blocks)).select("*", each(n_blocks).alias("c_block"))
    candidates = rows.withColumn("c_block", block(n_blocks)).select("*", each(q_blocks).alias("q_block"))
    keys = ["q_block", "c_block", "dims"]
    near = (
        queries.groupBy(*keys)
        .cogroup(candidates.groupBy(*keys))
        .applyInArrow(pair_of_blocks(k), "query_id bigint, vec_id bigint, score bigint")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
