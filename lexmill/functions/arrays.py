"""Token-array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(tokens, n: int) -> Column:
    return F.slice(_column(tokens), 1, n)


def pad_right(tokens, length: int, pad: int = 0) -> Column:
    """First ``length`` tokens, filled with ``pad`` on the right."""
    filler = F.array_repeat(F.lit(pad), length)
    return F.slice(F.concat(_column(tokens), filler), 1, length)


def roll_left(tokens, last: int = 0) -> Column:
    """Every token one place to the left, ``last`` in the freed place."""
    column = _column(tokens)
    rest = F.slice(column, F.lit(2), F.greatest(F.size(column) - 1, F.lit(0)))
    rolled = F.concat(rest, F.array(F.lit(last)))
    return F.when(F.size(column) > 0, rolled).otherwise(column)


def joined(tokens, separator: str = " ") -> Column:
    return F.array_join(_column(tokens).cast("array<string>"), separator)


def let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def places(values) -> Column:
    """Distinct values of an array, sorted, each with the places (from 0) where it stands:
    an array of (``value``, ``at``). Values are sorted with their places once, and every run of
    equal ones is cut out; nulls are equal to each other. A null array gives null."""

    def cut(found: Column) -> Column:
        size = F.size(found)

        def begins(i: Column) -> Column:
            return (i == 0) | ~F.get(found, i)["value"].eqNullSafe(F.get(found, i - 1)["value"])

        def run(start: Column, i: Column, starts: Column) -> Column:
            length = F.coalesce(F.get(starts, i + 1), size) - start
            at = F.transform(F.slice(found, start + 1, length), lambda e: e["at"])
            return F.struct(F.get(found, start)["value"].alias("value"), at.alias("at"))

        starts = F.filter(F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))), lambda i: (i < size) & begins(i))
        runs = let(starts, lambda s: F.transform(s, lambda start, i: run(start, i, s)))
        return F.when(found.isNotNull(), runs)

    placed = F.transform(_column(values), lambda v, i: F.struct(v.alias("value"), i.alias("at")))
    return let(F.sort_array(placed), cut)


def put_back(found, value: str) -> Column:
    """The array that ``places`` took apart, with other values: ``found`` is an array of
    (``at``, ``value``)."""
    each = F.transform(
        _column(found), lambda f: F.transform(f["at"], lambda i: F.struct(i.alias("at"), f[value].alias("v")))
    )
    return F.transform(F.sort_array(F.flatten(each)), lambda e: e["v"])
