"""Array expressions whose work grows with the array or text, not with its square.

A lambda evaluates whatever it mentions anew for each element.  What it needs
of a whole array is therefore bound to a variable first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

GROUP = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Totals up to and with each element: groups first, then what comes before each group."""
    at = lambda i: i - F.pmod(i, F.lit(GROUP))

    def of_groups(own: Column) -> Column:
        last = F.floor(F.greatest(F.size(own) - 1, F.lit(0)) / GROUP).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda g: F.aggregate(F.slice(own, g * GROUP + 1, F.lit(GROUP)), zero, add)
        )

    def before_groups(groups: Column) -> Column:
        return F.transform(groups, lambda _, g: F.aggregate(F.slice(groups, F.lit(1), g), zero, add))

    def ends(own: Column, before: Column) -> Column:
        return F.transform(
            own,
            lambda _, i: add(
                F.get(before, F.floor(i / GROUP).cast("int")),
                F.aggregate(F.slice(own, at(i) + 1, F.pmod(i, F.lit(GROUP)) + 1), zero, add),
            ),
        )

    return let(values, lambda own: let(of_groups(own), lambda groups: let(before_groups(groups), lambda before: ends(own, before))))


def running_ends(lengths: Column) -> Column:
    """Sums up to and with each element."""
    return _running(lengths, F.lit(0).cast("long"), lambda a, x: a + x)


def running_most(values: Column) -> Column:
    """The largest of the elements, none of them negative, up to and with each."""
    return _running(values, F.lit(0).cast("long"), lambda a, x: F.greatest(a, x))


def with_cutter(text: Column, body: Callable[[Callable[[Column, Column], Column]], Column]) -> Column:
    """``body`` of a function (begin, length) that cuts code points out of a text.

    A substring counts from the start of its text each time; here the text is
    split once, and a cut takes only the pieces it touches.
    """
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{GROUP}}}"), F.lit(0))

    def cut(held: Column, begin: Column, length: Column) -> Column:
        into = F.pmod(begin, F.lit(GROUP))
        first = F.floor(begin / GROUP).cast("int")
        count = F.floor((into + F.greatest(length, F.lit(1)) - 1) / GROUP).cast("int") + 1
        near = F.array_join(F.slice(held, first + 1, count), "")
        return F.when(length > 0, F.substring(near, (into + 1).cast("int"), length.cast("int"))).otherwise("")

    return let(pieces, lambda held: body(lambda begin, length: cut(held, begin, length)))


def last_not_above(sorted_values: Column, value: Column) -> Column:
    """The place of the last element of a bound, sorted array that is not above a value, -1 if there is none."""
    zero = F.struct(F.lit(-1).alias("low"), F.size(sorted_values).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        open_ = acc["high"] - acc["low"] > 1
        right = open_ & (F.get(sorted_values, middle) <= value)
        return F.struct(
            F.when(right, middle).otherwise(acc["low"]).alias("low"),
            F.when(right | ~open_, acc["high"]).otherwise(middle).alias("high"),
        )

    # An array has fewer than 2 ** 31 elements.
    return F.aggregate(F.sequence(F.lit(1), F.lit(31)), zero, halve, lambda acc: acc["low"])
