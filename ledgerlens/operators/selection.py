"""Exact boundaries in a sort order, found by counting (WIN3, WIN8, GR1, GR2).

NTILE and running shares need a few rows of the order only: the first row of
each tile, or the one at which a running sum passes a limit.  Instead of giving
every row a position, rounds of counts narrow down where those rows are: the
values between the least and the greatest are cut into ranges, one aggregate
counts the rows (and sums the weights) of each, and the range that holds a
limit is cut again.  Ranges of few rows are read whole at the end.  Where one
value holds many rows the search goes on in the next sort column, there alone,
so a value of any share of the rows is no harder than others.  A row's tile
is then a comparison with literals: no row is moved, numbered or written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = 4096  #: that a round cuts the values into, for each boundary
SMALL = 4096  #: rows of a range that are read whole
BYTES = 6  #: of a string that one number stands for

Key = tuple[str, bool]  # column, descending


def _numbers(df: DataFrame, name: str) -> list[Column]:
    """Whole numbers whose order, taken together, is that of the column."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.DateType):
        return [F.unix_date(c).cast("long")]
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
        return [c.cast("long")]
    if isinstance(kind, T.LongType):
        return [F.shiftright(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF))]
    if isinstance(kind, T.DecimalType):
        unit = 10 ** (15 - min(kind.scale, 15))
        high = F.expr(f"`{name}` div {unit}BD")
        low = (c - high.cast("decimal(38,0)") * unit) * 10 ** kind.scale
        return [high, low.cast("long")]
    if isinstance(kind, T.StringType):
        longest = df.agg(F.max(F.octet_length(name))).first()[0] or 0
        part = lambda i: F.hex(F.substring(c.cast("binary"), i + 1, BYTES))
        return [*[F.conv(F.rpad(part(i), 2 * BYTES, "0"), 16, 10).cast("long") for i in range(0, longest, BYTES)],
                F.octet_length(c).cast("long")]
    raise TypeError(f"no exact selection by {name}: {kind.simpleString()}")


def places(df: DataFrame, keys: Sequence[Key]) -> list[Column]:
    """Numbers that are in the order of ``keys`` when compared one after the
    other; NULLs as Spark sorts them (first ascending, last descending)."""
    out: list[Column] = []
    for name, descending in keys:
        null = F.col(name).isNull()
        out.append(F.when(null, F.lit(0)).otherwise(F.lit(-1 if descending else 1)).cast("long"))
        for number in _numbers(df, name):
            number = F.coalesce(number, F.lit(0).cast("long"))
            out.append(-number if descending else number)
    return out


def beyond(order: Sequence[Column], first: tuple[int, ...] | None) -> Column:
    """Whether a row is ``first`` or comes after it (none does, if it is None)."""
    if first is None:
        return F.lit(False)
    return F.struct(*order) >= F.struct(*[F.lit(v).cast("long") for v in first])


@dataclass(frozen=True)
class _Range:
    order: str
    fixed: tuple[int, ...]  # the values of the first numbers
    low: int  # and bounds of the next one
    high: int
    before: int  # weight of all rows before it
    rows: int

    def holds(self, numbers: Sequence[Column]) -> Column:
        k = len(self.fixed)
        tests = [n == F.lit(v).cast("long") for n, v in zip(numbers, self.fixed)]
        if k < len(numbers):
            tests.append(numbers[k].between(F.lit(self.low).cast("long"), F.lit(self.high).cast("long")))
        return reduce(lambda a, b: a & b, tests)

    @property
    def step(self) -> int:
        return -(-(self.high - self.low + 1) // RANGES)


def _found(rows, ranges: list[_Range], orders: Mapping[str, list[Column]], value) -> Column:
    """The structs of ``value(i, range)`` of the ranges that hold a row: at
    most one of each order, as its ranges do not overlap."""
    per_order = []
    for name in orders:
        case = None
        for i, r in enumerate(ranges):
            if r.order == name:
                case = (F.when if case is None else case.when)(r.holds(orders[name]), value(i, r))
        if case is not None:
            per_order.append(case)
    return F.filter(F.array(*per_order), lambda x: x.isNotNull())


def crossings(rows: DataFrame, orders: Mapping[str, Sequence[Key]], limits: Mapping[str, Sequence[int]],
              weight: Column | None = None) -> tuple[dict[str, list[Column]], dict[str, list[tuple[int, ...] | None]]]:
    """For each order and limit, the first row at which the running weight
    exceeds the limit, as its place; None where it never does.

    ``weight`` is a whole number (1 if not given).  Weights may be negative
    where positive ones come first in the order.  ``rows`` is read a few times,
    so it should be a written or checkpointed table.  Rows with equal places
    stay together.
    """
    numbers = {name: places(rows, keys) for name, keys in orders.items()}
    weight = F.lit(1) if weight is None else weight
    weight = weight.cast("decimal(38,0)")
    sums = [F.count(F.lit(1)).alias("n"), F.sum("w").alias("w"), F.sum(F.greatest("w", F.lit(0))).alias("positive")]
    table = rows.select(*[n.alias(f"{name}_{i}") for name, ns in numbers.items() for i, n in enumerate(ns)], weight.alias("w"))
    own = {name: [F.col(f"{name}_{i}") for i in range(len(ns))] for name, ns in numbers.items()}
    flat = [c for cs in own.values() for c in cs]
    n_rows, most, *ends = table.agg(F.count(F.lit(1)), sums[2], *[f(c) for c in flat for f in (F.min, F.max)]).first()
    out: dict[str, list[tuple[int, ...] | None]] = {name: [None] * len(limits[name]) for name in orders}
    if not n_rows:
        return numbers, out
    bounds, at = {}, 0
    for name, cs in own.items():
        bounds[name] = [(ends[at + 2 * i], ends[at + 2 * i + 1]) for i in range(len(cs))]
        at += 2 * len(cs)

    def settled(r: _Range) -> _Range:
        """The range with every number fixed that can have one value only."""
        fixed, low, high = r.fixed, r.low, r.high
        while len(fixed) < len(bounds[r.order]) and low == high:
            fixed = (*fixed, low)
            low, high = bounds[r.order][len(fixed)] if len(fixed) < len(bounds[r.order]) else (0, 0)
        return _Range(r.order, fixed, low, high, r.before, r.rows)

    open_ = {(name, i): settled(_Range(name, (), *bounds[name][0], 0, n_rows)) for name in orders
             for i, limit in enumerate(limits[name]) if most > limit}  # others are never exceeded
    while True:
        ranges = sorted({r for r in open_.values() if r.rows > SMALL and len(r.fixed) < len(bounds[r.order])},
                        key=lambda r: (r.order, r.fixed, r.low))
        if not ranges:
            break

        def cut(i: int, r: _Range) -> Column:
            number = own[r.order][len(r.fixed)] - F.lit(r.low).cast("long")
            return F.struct(F.lit(i).alias("i"), F.floor(number / F.lit(r.step)).cast("long").alias("part"))

        counted = (table.select(F.explode(_found(table, ranges, own, cut)).alias("f"), "w")
                   .groupBy("f.i", "f.part").agg(*sums).orderBy("i", "part").collect())  # RANGES rows a range
        parts: dict[int, list] = {}
        for row in counted:
            parts.setdefault(row["i"], []).append(row)
        for key, r in list(open_.items()):
            if r not in ranges:
                continue
            total, limit = r.before, limits[key[0]][key[1]]
            for row in parts.get(ranges.index(r), ()):
                if total + int(row["positive"]) > limit:
                    low = r.low + row["part"] * r.step
                    open_[key] = settled(_Range(r.order, r.fixed, low, min(r.high, low + r.step - 1), total, row["n"]))
                    break
                total += int(row["w"])
    ranges = sorted(set(open_.values()), key=lambda r: (r.order, r.fixed, r.low))
    few = [r for r in ranges if len(r.fixed) < len(bounds[r.order])]
    held: dict[_Range, list] = {r: [] for r in ranges}
    if few:
        width = max(map(len, own.values()))

        def whole(i: int, r: _Range) -> Column:
            return F.struct(F.lit(i).alias("i"), F.array(*own[r.order], *[F.lit(0).cast("long")] * (width - len(own[r.order]))).alias("at"))

        read = table.select(F.explode(_found(table, few, own, whole)).alias("f"), "w").select("f.i", "f.at", "w")
        for row in read.collect():  # SMALL rows a range
            held[few[row["i"]]].append((tuple(row["at"][:len(bounds[few[row["i"]].order])]), int(row["w"])))
    for (name, i), r in open_.items():
        if len(r.fixed) == len(bounds[name]):
            out[name][i] = r.fixed
            continue
        total = r.before
        for at, w in sorted(held[r]):
            total += w
            if total > limits[name][i]:
                out[name][i] = at
                break
    return numbers, out


def ntiles(rows: DataFrame, tiles: Mapping[str, tuple[int, Sequence[Key]]]) -> DataFrame:
    """``NTILE(n) OVER (ORDER BY keys)`` under each name; ``rows`` should be a
    written or checkpointed table with unique keys."""
    n_rows = rows.count()
    limits = {}
    for name, (n, _) in tiles.items():
        size, more = divmod(n_rows, n)
        limits[name] = [i * size + min(i, more) for i in range(1, n)]
    order, first = crossings(rows, {name: keys for name, (_, keys) in tiles.items()}, limits)
    tile = {name: reduce(lambda a, b: a + b, [beyond(order[name], at).cast("int") for at in first[name]], F.lit(1))
            for name in tiles}
    return rows.withColumns(tile)
