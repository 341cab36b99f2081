"""What five quality filters remove in every order, and each one's Shapley share.

One pass gives each document the set of filters it fails, a number of five
bits.  Documents are counted by part and set, so that all 32 coalitions'
removals are sums over at most 32 rows a part, whatever the corpus.  A step
of an order is the difference of two coalitions.

The Shapley shares are the solution of a least-squares problem: additive
shares that come closest to the removals of all coalitions, weighed by the
Shapley kernel, and sum to the removals of all filters together.  Its normal
equations depend on the number of filters only.  They are solved once in
rationals, and their solution, whole numbers after scaling by the number of
orders, is applied to the counts: no rounding anywhere.
"""

from __future__ import annotations

import itertools
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amihan.llm.common import stored

FILTERS = "ABCDE"
#: Fixed values of the failure conditions.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 2
WORD_BREAK, MARKS = r"[\x20\x09-\x0D]+", "[#$%&*|]"


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solution of a regular system for several right-hand sides, by elimination in rationals."""
    n = len(matrix)
    rows = [list(m) + list(r) for m, r in zip(matrix, right)]
    for i in range(n):
        pivot = next(j for j in range(i, n) if rows[j][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for j in range(n):
            if j != i and rows[j][i]:
                factor = rows[j][i]
                rows[j] = [x - factor * y for x, y in zip(rows[j], rows[i])]
    return [r[n:] for r in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """For each player, the whole-number weight of each coalition's value in n! times its Shapley value.

    Minimises the sum over all proper coalitions S of
    (n - 1) / (C(n, |S|) |S| (n - |S|)) * (v(S) - sum of the shares in S) ** 2
    with the shares summing to v(all); v(nothing) is 0.  The last unknown is
    the multiplier of that constraint, and column S of the right-hand sides
    stands for v(S) = 1, so the solution is linear in the values.
    """
    whole = 2**n - 1
    if n == 1:
        return [[0, 1]]
    kernel = {s: Fraction(n - 1, math.comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in range(1, whole)}
    has = lambda s, i: s >> i & 1
    normal = [[sum((w for s, w in kernel.items() if has(s, i) and has(s, j)), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
    normal.append([Fraction(1)] * n + [Fraction(0)])
    right = [[kernel[s] * has(s, i) if s in kernel else Fraction(0) for s in range(whole + 1)] for i in range(n)]
    right.append([Fraction(int(s == whole)) for s in range(whole + 1)])
    shares = solve(normal, right)[:n]
    scaled = [[x * math.factorial(n) for x in row] for row in shares]
    assert all(x.denominator == 1 for row in scaled for x in row)
    return [[int(x) for x in row] for row in scaled]


def text_failures(text: Column) -> Column:
    """The bits of filters A to D that a text fails: few words, few different ones, capitals, marks."""
    words = F.array_remove(F.split(text, WORD_BREAK), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    found = F.transform(
        F.array(words),
        lambda w: F.when(F.size(w) < LEAST_WORDS, 1).otherwise(0)
        + F.when(F.size(F.array_distinct(w)) * F.lit(100).cast("long") < F.size(w) * F.lit(LEAST_DISTINCT).cast("long"), 2).otherwise(0),
    )
    return (
        F.get(found, 0)
        + F.when(capitals.cast("long") * 100 > F.length(text).cast("long") * MOST_CAPITALS, 4).otherwise(0)
        + F.when(text.rlike(MARKS), 8).otherwise(0)
    )


def failure_counts(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, failed, documents, good, toxic): documents by part and by the set of filters they fail.

    Texts shrink to a digest before the first shuffle, rows of one id, text and
    part are combined, and so are all documents of one text and part, but for
    the one with the smallest id: copies in a third of all rows are no hot key.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        F.col(id_col).alias("id"),
        F.sha2(text.cast("binary"), 256).alias("digest"),
        text_failures(text).alias("failed"),
    )
    rows = rows.groupBy("digest", "part", "id").agg(F.first("failed").alias("failed"), F.count("*").alias("n"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    marks = marks.agg(F.max(F.expr("int(quality = 1)")).alias("good"), F.max(F.expr("int(toxic = 1)")).alias("toxic"))
    # Rows without an id meet no label; spread, they are no hot key of the join.
    known, unknown = rows.where("id is not null"), rows.where("id is null")
    marked = known.join(marks, "id", "left").select("digest", "part", "id", "failed", "n", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    marked = marked.unionByName(unknown.select("digest", "part", "id", "failed", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic")))
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n", "good", "toxic")))
    grouped = marked.groupBy("digest", "part").agg(
        F.first("failed").alias("failed"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        first.alias("first"),
    )
    # One row for each part that holds the text.
    grouped = grouped.withColumn("least", F.min("first.id").over(Window.partitionBy("digest")))
    own = lambda value: F.when(F.col("first.id") == F.col("least"), value).otherwise(0)
    kept = F.struct(
        F.col("failed"),
        (F.col("unnamed") + own(F.col("first.n"))).alias("n"),
        own(F.col("first.n") * F.col("first.good")).alias("good"),
        own(F.col("first.n") * F.col("first.toxic")).alias("toxic"),
    )
    copies = F.struct(
        (F.col("failed") + 16).alias("failed"),
        (F.col("n") - kept["n"]).alias("n"),
        (F.col("good") - kept["good"]).alias("good"),
        (F.col("toxic") - kept["toxic"]).alias("toxic"),
    )
    both = grouped.select("part", F.explode(F.array(kept, copies)).alias("one"))
    return both.groupBy("part", "one.failed").agg(F.sum("one.n").alias("documents"), F.sum("one.good").alias("good"), F.sum("one.toxic").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each part, order of the five filters and step, zeros included.

    Nulls: a null text is empty, a null part the empty string; a row without an
    id fails no filter for copies and makes no other row fail it, and has no
    labels.  Rows that repeat an id are documents of their own, none smaller
    than the other; an id that labels repeat is good or toxic if any of its
    rows says so.  An empty table gives no rows.  Other columns are ignored.
    """
    counts = stored(failure_counts(docs, labels, part_col, id_col, text_col), "audit-failures")
    sets = range(2 ** len(FILTERS))
    sums = lambda value: F.array(*[F.sum(F.when(F.col("failed") == m, F.col(value)).otherwise(0)) for m in sets])
    parts = counts.groupBy("part").agg(sums("documents").alias("n"), sums("good").alias("g"), sums("toxic").alias("t"))

    def removals(values: Column) -> Column:
        """By coalition, the documents that fail any of its filters."""
        by_set = lambda s: F.aggregate(
            F.sequence(F.lit(0), F.lit(len(sets) - 1)),
            F.lit(0).cast("long"),
            lambda acc, m: acc + F.when(m.bitwiseAND(s) != 0, F.get(values, m)).otherwise(0),
        )
        return F.transform(F.sequence(F.lit(0), F.lit(len(sets) - 1)), by_set)

    tables = parts.select(
        "part",
        F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("all"),
        *[removals(F.col(c)).alias(c) for c in "ngt"],
    )
    # An array per player, as literals: the solved system, the same for every part.
    weights = shapley_weights(len(FILTERS))
    shares = [
        F.aggregate(
            F.zip_with("n", F.array(*[F.lit(w) for w in row]), lambda v, w: v * w), F.lit(0).cast("long"), lambda a, x: a + x
        )
        for row in weights
    ]
    tables = tables.withColumn("shares", F.array(*shares))
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append(("".join(FILTERS[i] for i in order), step, f, before))
            before |= 1 << f
    listed = F.from_json(
        F.lit("[" + ",".join('{"o":"%s","step":%d,"f":%d,"b":%d}' % s for s in steps) + "]"), "array<struct<o:string,step:int,f:int,b:int>>"
    )
    each = tables.withColumn("at", F.explode(listed))
    f, before = F.col("at.f"), F.col("at.b")
    bit = F.expr("shiftleft(1, at.f)")
    after = before.bitwiseOR(bit)
    gain = lambda c: F.get(F.col(c), after) - F.get(F.col(c), before)
    whole = len(sets) - 1
    return each.select(
        "part",
        F.col("at.o").alias("filter_order"),
        F.col("at.step").alias("step"),
        (F.col("all") - F.get("n", after)).alias("kept"),
        gain("n").alias("removed"),
        (F.get("n", bit) - gain("n")).alias("redundant"),
        (F.get("n", F.lit(whole)) - F.get("n", F.lit(whole) - bit)).alias("unique_fails"),
        gain("g").alias("good_lost"),
        gain("t").alias("toxic_lost"),
        F.get("shares", f).alias("shapley"),
    )
