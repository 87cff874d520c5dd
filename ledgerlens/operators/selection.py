"""The value at a given place of an order, without putting all values in order.

A sketch of the column brackets the place. One pass then counts the values below the bracket and the
distinct ones in it, which are few, so what is sorted has a fixed size however long the column is.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The sketch's relative error is 1 / ACCURACY; the bracket takes MARGIN times that on either side.
ACCURACY, MARGIN = 10_000, 2
# Distinct values of a bracket that the driver sorts; with more of them the bracket is cut again.
FEW = 50_000


class Found(NamedTuple):
    """A value, the number of values below it and the number of values equal to it."""

    value: float
    below: int
    equal: int


def _bracket(column: str, low: float, high: float, margin: int) -> Column:
    """Aggregate: two values with the given parts of all values below them, and some more on either side."""
    ends = [min(1.0, max(0.0, end)) for end in (low - margin / ACCURACY, high + margin / ACCURACY)]
    return F.percentile_approx(column, F.array(*[F.lit(e) for e in ends]), ACCURACY)


def values_at(df: DataFrame, column: str, fraction: float, places: Callable[[int], list[int]]) -> tuple[int, list[Found]]:
    """The number of non-null values of a double column, and the values at some places of their order.

    ``places`` gives ascending places, counted from 0, for that number; they lie near ``fraction`` of
    it, next to one another. Of no values there are none.
    """
    given = df.select(column).where(F.col(column).isNotNull())
    n, ends = given.agg(F.count(column), _bracket(column, fraction, fraction, MARGIN)).first()
    if not n:
        return 0, []
    wanted = places(n)
    low, high = ends
    few, margin = FEW, MARGIN
    while True:
        inside = F.when(F.col(column) >= low, F.col(column)) if low is not None else F.col(column)
        upto = given.where(F.col(column) <= high) if high is not None else given
        groups = upto.groupBy(inside.alias("value")).agg(F.count(F.lit(1)).alias("n")).limit(few + 2).collect()
        if len(groups) > few + 1:
            before = [low, high]
            low, high = _narrower(given, column, wanted, low, high, margin)
            if [low, high] == before:
                few *= 4  # the sketch tells these values no further apart
            continue
        below = next((r["n"] for r in groups if r["value"] is None), 0)
        values = sorted((r["value"], r["n"]) for r in groups if r["value"] is not None)
        missed_low, missed_high = wanted[0] < below, wanted[-1] >= below + sum(c for _, c in values)
        if not (missed_low or missed_high):
            return n, [_at(values, below, place) for place in wanted]
        # The sketch was further off than it promises.
        low, high, margin = None if missed_low else low, None if missed_high else high, max(4 * margin, 1)


def _at(values: list[tuple[float, int]], below: int, place: int) -> Found:
    for value, count in values:
        if place < below + count:
            return Found(value, below, count)
        below += count
    raise ValueError(f"No value at place {place}.")


def _narrower(
    given: DataFrame, column: str, wanted: list[int], low: float | None, high: float | None, margin: int
) -> list[float]:
    """A bracket inside the bracket."""
    c = F.col(column)
    within = (c >= low if low is not None else F.lit(True)) & (c <= high if high is not None else F.lit(True))
    below = given.where(c < low).count() if low is not None else 0
    inner = given.where(within)
    size = inner.count()
    return inner.agg(_bracket(column, (wanted[0] - below) / size, (wanted[-1] + 1 - below) / size, margin)).first()[0]


def percentile(df: DataFrame, column: str, percent: int) -> tuple[float | None, int]:
    """The exact, linearly interpolated percentile of the non-null values, and their number."""

    def ends(n: int) -> list[int]:
        place = (n - 1) * percent
        return [place // 100, -(-place // 100)]

    n, found = values_at(df, column, percent / 100, ends)
    if not n:
        return None, 0
    low, high = (f.value for f in found)
    return low + (high - low) * ((n - 1) * percent % 100 / 100), n


def text_at(df: DataFrame, column: str, place: int) -> str:
    """The text at a place, counted from 0, of the order of a column's texts, none of them null.

    Texts are counted by their first letters, one letter more in each pass, until those that begin like the
    wanted one are few.
    """
    rows = df.select(column)
    while True:
        texts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n")).limit(FEW + 1).collect()
        if len(texts) <= FEW:
            break
        least, most = rows.agg(F.min(column), F.max(column)).first()
        shared = next(i for i, (a, b) in enumerate(zip(least + "\0", most + "\0", strict=False)) if a != b)
        start = F.left(F.col(column), F.lit(shared + 1))
        starts = rows.groupBy(start.alias("start")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(starts, key=lambda r: r["start"].encode()):
            if place < r["n"]:
                rows = rows.where(start == r["start"])
                break
            place -= r["n"]
    for r in sorted(texts, key=lambda r: r[column].encode()):
        if place < r["n"]:
            return r[column]
        place -= r["n"]
    raise ValueError("No text at this place.")


def row_at(df: DataFrame, column: str, key: str, fraction: float, place: Callable[[int], int]) -> tuple[float, str] | None:
    """(value, key) of the row at a place of the order by value and key; neither may be null, keys are texts.

    None if the place lies behind the last row."""

    def places(n: int) -> list[int]:
        return [min(place(n), n - 1)]

    n, found = values_at(df, column, fraction, places)
    if not n or place(n) >= n:
        return None
    at = found[0]
    equal = df.where(F.col(column) == at.value)
    return at.value, text_at(equal, key, place(n) - at.below)


def not_before(column: str, key: str, row: tuple[float, str] | None) -> Column:
    """Whether a row is at or behind the given one in the order by value and key."""
    if row is None:
        return F.lit(False)
    value, text = row
    return (F.col(column) > value) | ((F.col(column) == value) & (F.col(key) >= text))


def tile_start(n: int, tiles: int, tile: int) -> int:
    """Place of the first row of a 1-based tile when n rows are dealt out as ``ranking.tile`` does."""
    size, larger = divmod(n, tiles)
    return (tile - 1) * size + min(tile - 1, larger)
