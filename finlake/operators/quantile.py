"""Global ``ntile`` by counting (W2-W4): no sort and no shuffle of the rows.

A bucket's last row is the row of a known rank, so ``ntile(k)`` needs the
k - 1 rows at those ranks and nothing else. They are found by nested
histograms: one pass counts the rows in equal bins between the smallest and
the largest value, the bin with the wanted rank becomes the next range, and
so on until a bin holds one value. Rows tied at that value are ordered by
the tie column: histograms over its next characters find the row. All ranks
of all columns are refined in the same passes; a pass returns at most
``BINS`` rows per rank. A last projection compares each row with the k - 1
rows found.

Order: by the value, ascending with NULL first or descending with NULL last,
NaN above all numbers, then by the tie column ascending, NULL first. The tie
column is a string and unique; rows that agree in both get one bucket. The
passes needed follow the spread of the values, not their number: each one
narrows the range at least ``BINS`` - 1 times.
"""
from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DoubleType, FloatType, IntegerType, LongType, ShortType

BINS = 256
CHARS = 2  # characters of the tie column a pass
_NULL, _LOW, _FIRST, _HIGH, _NAN = 0, 1, 2, BINS + 2, BINS + 3
ALL = object()  # every row with the value lies within the bucket


@dataclass
class _Rank:
    """One searched row: the ``rank``-th of those in the present range."""

    column: str
    descending: bool
    rank: int
    low: Any = None
    high: Any = None
    value: Any = None  # known once the range is one value
    tied: bool = False  # the tie column is being searched, from ``prefix`` on
    prefix: str = ""
    tie: Any = ALL
    done: bool = False

    def range(self) -> tuple:
        """What a pass counts for it; ranks in one range share the count."""
        return self.column, self.tied, self.low, self.high, self.value, self.prefix


def _number(df: DataFrame, name: str) -> Column:
    """Whole numbers as exact decimals, others as doubles."""
    kind = df.schema[name].dataType
    if isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        return F.col(name).cast("decimal(20,0)")
    if isinstance(kind, (FloatType, DoubleType)):
        return F.col(name).cast("double")
    raise TypeError(f"{name} is not a number")


def _literal(df: DataFrame, name: str, value: Any) -> Column:
    kind = "double" if isinstance(df.schema[name].dataType, (FloatType, DoubleType)) else "decimal(20,0)"
    return F.lit(value).cast(kind)


def _bin(df: DataFrame, r: _Rank) -> Column:
    """The bin of a row's value, NULL outside the present range."""
    x = _number(df, r.column)
    if r.low is None:  # the first pass tells numbers from the rest
        out = F.when(x.isNull(), _NULL)
        if isinstance(df.schema[r.column].dataType, (FloatType, DoubleType)):
            out = out.when(F.isnan(x), _NAN).when(x == float("inf"), _HIGH).when(x == float("-inf"), _LOW)
        return out.otherwise(_FIRST)
    low, high = _literal(df, r.column, r.low), _literal(df, r.column, r.high)
    if isinstance(r.low, float):
        share = F.try_divide(x / 2 - low / 2, high / 2 - low / 2)
    else:
        share = (x - low).cast("double") / (high - low).cast("double")
    inner = F.least(F.lit(BINS - 1), F.floor(share * BINS)).cast("int")
    place = F.when(x == low, 0).when(x == high, BINS - 1).otherwise(F.coalesce(inner, F.lit(0)))
    return F.when((x >= low) & (x <= high), place + _FIRST)


def _same(df: DataFrame, r: _Rank) -> Column:
    """Rows with the value that was found."""
    if r.value is None:
        return F.col(r.column).isNull()
    return _number(df, r.column) == _literal(df, r.column, r.value)


def _pass(df: DataFrame, ranks: list[_Rank], tie: str) -> list[list]:
    """For each rank its range's bins: (bin or characters, rows, smallest,
    largest), in one scan."""
    ranges: dict[tuple, int] = {}
    of = [ranges.setdefault(r.range(), len(ranges)) for r in ranks]
    first = [ranks[of.index(k)] for k in range(len(ranges))]
    rows = []
    for k, r in enumerate(first):
        if r.tied:
            t = F.col(tie)
            inside = _same(df, r) & (t.startswith(F.lit(r.prefix)) if r.prefix else F.lit(True))
            chars = F.when(t.isNotNull(), F.substring(t, len(r.prefix) + 1, CHARS))
            row = F.struct(F.lit(k).alias("k"), F.lit(None).cast("int").alias("bin"), chars.alias("chars"),
                           F.lit(None).cast("double").alias("x"), F.lit(None).cast("decimal(20,0)").alias("n"), t.alias("t"))
        else:
            x, at = _number(df, r.column), _bin(df, r)
            inside = at.isNotNull()
            is_double = isinstance(df.schema[r.column].dataType, (FloatType, DoubleType))
            none_x, none_n = F.lit(None).cast("double"), F.lit(None).cast("decimal(20,0)")
            row = F.struct(F.lit(k).alias("k"), at.cast("int").alias("bin"), F.lit(None).cast("string").alias("chars"),
                           (x if is_double else none_x).alias("x"), (none_n if is_double else x).alias("n"), F.lit(None).cast("string").alias("t"))
        rows.append(F.when(inside, row))
    found = df.select(F.explode(F.filter(F.array(*rows), lambda s: s.isNotNull())).alias("s")).select("s.*")
    counts = found.groupBy("k", "bin", "chars").agg(
        F.count(F.lit(1)).alias("rows"), F.min("x"), F.max("x"), F.min("n"), F.max("n"), F.min("t"), F.max("t"))
    out: list[list] = [[] for _ in first]
    for k, at, chars, n, *ends in counts.collect():
        tied = first[k].tied
        low, high = ends[4:] if tied else ends[:2] if ends[0] is not None else ends[2:4]
        out[k].append((chars if tied else at, n, low, high))
    return [out[k] for k in of]


def _narrow(r: _Rank, bins: list) -> None:
    """Go on with the bin that holds the rank."""
    if r.tied:
        bins = sorted(bins, key=lambda b: (b[0] is not None, b[0] or ""))
    else:
        bins = sorted(bins, key=lambda b: b[0], reverse=r.descending)
    for at, n, low, high in bins:
        if r.rank <= n:
            break
        r.rank -= n
    last = r.rank == n
    if r.tied:
        if at is None or last or r.rank == 1 or len(at) < CHARS:
            r.tie, r.done = (None if at is None else high if last else low), True
        else:
            r.prefix += at
        return
    if r.low is None and at != _FIRST:
        r.value = {_NULL: None, _NAN: math.nan, _HIGH: math.inf, _LOW: -math.inf}[at]
        r.tied, r.done = True, last
    elif low == high or last:
        # the rank of a bin's last row: the bin's outermost value, all its rows
        r.value = low if r.descending else high
        r.tied, r.done = True, last
    else:
        r.low, r.high = low, high


def _after(df: DataFrame, r: _Rank, tie: str) -> Column:
    """Rows that come after the row found."""
    x, t = _number(df, r.column), F.col(tie)
    if r.tie is ALL:
        later = F.lit(False)
    else:
        later = t.isNotNull() if r.tie is None else F.coalesce(t > F.lit(r.tie), F.lit(False))
    if r.value is None:
        beyond = F.lit(False) if r.descending else x.isNotNull()
        return beyond | (x.isNull() & later)
    v = _literal(df, r.column, r.value)
    beyond = (x.isNull() | (x < v)) if r.descending else F.coalesce(x > v, F.lit(False))
    return F.coalesce(beyond, F.lit(False)) | (F.coalesce(x == v, F.lit(False)) & later)


def ntiles(df: DataFrame, k: int, orders: Mapping[str, tuple[str, bool]], tie: str) -> DataFrame:
    """``df`` with an int column per entry of ``orders``: name -> (column,
    descending). ``df`` is read once a pass: give it stored or cached, and
    the same rows each time."""
    if k < 1:
        raise ValueError("ntile needs k >= 1")
    names = list(orders)
    whole = _pass(df, [_Rank(*orders[name], rank=0) for name in names], tie) if names else []
    total = sum(n for _, n, _, _ in whole[0]) if names else 0
    share, more = divmod(total, k)
    searched: dict[tuple[str, int], _Rank] = {}
    for name, bins in zip(names, whole):
        for rank in {b * share + min(b, more) for b in range(1, k)} - {0}:
            searched[name, rank] = _Rank(*orders[name], rank=rank)
            _narrow(searched[name, rank], bins)
    while todo := [r for r in searched.values() if not r.done]:
        for r, bins in zip(todo, _pass(df, todo, tie)):
            _narrow(r, bins)
    buckets = {}
    for name in orders:
        out = F.lit(1)
        for b in range(1, k):
            rank = b * share + min(b, more)
            if (name, rank) in searched:
                out = out + F.when(_after(df, searched[name, rank], tie), 1).otherwise(0)
        buckets[name] = out.cast("int")
    return df.withColumns(buckets)
