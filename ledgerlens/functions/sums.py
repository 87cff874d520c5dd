"""Sums of doubles that are the same for every order of the rows.

A value goes into one of five bins by its size and digits; all but the last are whole numbers or decimals,
whose sums have no order:

* up to four decimals below ``EXACT_BELOW``, as most amounts: the number of ten-thousandths, in two longs;
* other values below it: a decimal of sixteen places, and what that leaves out as a long;
* greater ones, as no business has: a decimal of five places below ``LARGE_BELOW``, and a whole decimal
  below ``ABSURD_BELOW``;
* what is greater still: a double. These alone are summed in the order of rows.

So no finite value stops a query, and the digits that a value prints as are those that are summed. A
decimal overflows, and the sum is null, only beyond a million of the greatest values of its bin.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimals that hold any double below EXACT_BELOW to sixteen places, and the sum of 10^11 of them.
EXACT, EXACT_BELOW = "decimal(38,16)", 1e11
LARGE, LARGE_BELOW = "decimal(38,5)", 1e27
ABSURD, ABSURD_BELOW = "decimal(38,0)", 1e32
PARTS_OF_ONE = 10_000
LOW_BITS = 25
REST_OF_ONE = 1e24


def _bins(column: Column) -> dict[str, Column]:
    """The value in the bins that it needs; the others are null."""
    size = F.abs(column)
    parts = F.rint(column * float(PARTS_OF_ONE))
    short = (size < EXACT_BELOW) & (parts / float(PARTS_OF_ONE) == column)
    n = F.when(short, parts.cast("long"))
    exact = F.when((size < EXACT_BELOW) & ~short, column).try_cast(EXACT)
    return {
        "high": F.shiftright(n, LOW_BITS),
        "low": n.bitwiseAND(F.lit((1 << LOW_BITS) - 1)),
        "exact": exact,
        "rest": F.rint((column - exact.cast("double")) * REST_OF_ONE).cast("long"),
        "large": F.when((size >= EXACT_BELOW) & (size < LARGE_BELOW), column).try_cast(LARGE),
        "absurd": F.when((size >= LARGE_BELOW) & (size < ABSURD_BELOW), column).try_cast(ABSURD),
        "huge": F.when(size >= ABSURD_BELOW, column),
    }


BINS = ("high", "low", "exact", "rest", "large", "absurd", "huge")
DECIMALS = {"exact": EXACT, "large": LARGE, "absurd": ABSURD}


def _added(name: str, bin_: Column) -> Column:
    """Aggregate: the sum of a bin. Sums of decimals keep their type, so that sums of sums do not widen."""
    return F.try_sum(bin_).try_cast(DECIMALS[name]) if name in DECIMALS else F.sum(bin_)


def _decimal(bins: dict[str, Column]) -> Column:
    """What the short and the exact values sum to, as a decimal."""
    parts = F.coalesce(bins["high"], F.lit(0)).cast("decimal(20,0)") * F.lit(Decimal(1 << LOW_BITS))
    parts = parts + F.coalesce(bins["low"], F.lit(0)).cast("decimal(20,0)")
    short = (parts.cast("decimal(26,0)") * F.lit(1 / Decimal(PARTS_OF_ONE))).cast(EXACT)
    return F.try_add(short, F.coalesce(bins["exact"], F.lit(0).cast(EXACT))).try_cast(EXACT)


def _beside(bins: dict[str, Column]) -> Column:
    """What the other bins sum to, as a double."""
    large, absurd, huge = (F.coalesce(bins[b].cast("double"), F.lit(0.0)) for b in ("large", "absurd", "huge"))
    return huge + absurd + large + F.coalesce(bins["rest"], F.lit(0)) / REST_OF_ONE


def _double(bins: dict[str, Column]) -> Column:
    """The sum of all bins, 0 if all are null."""
    return _decimal(bins).cast("double") + _beside(bins)


def _sums(column: Column) -> dict[str, Column]:
    return {name: _added(name, part) for name, part in _bins(column).items()}


def exact_sum(column: Column) -> Column:
    """Aggregate: the sum of a double column as a double, null over no values."""
    return F.when(F.count(column) > 0, _double(_sums(column)))


def partial_sums(column: Column, name: str) -> list[Column]:
    """Aggregates: the bins of a sum, to be summed further, and the number of values."""
    return [*[total.alias(f"{name}_{kind}") for kind, total in _sums(column).items()], F.count(column).alias(f"{name}_n")]


def merged_sums(name: str) -> list[Column]:
    """Aggregates: several ``partial_sums`` made one."""
    return [_added(kind, F.col(f"{name}_{kind}")).alias(f"{name}_{kind}") for kind in (*BINS, "n")]


def summed(name: str) -> Column:
    """The sum that a row's ``partial_sums`` hold, as a double, null over no values."""
    return F.when(F.col(f"{name}_n") > 0, _double({kind: F.col(f"{name}_{kind}") for kind in BINS}))


def merged_sum(name: str) -> Column:
    """Aggregate: the sum of several ``partial_sums`` as a double, null over no values."""
    return F.when(F.sum(f"{name}_n") > 0, _double({kind: _added(kind, F.col(f"{name}_{kind}")) for kind in BINS}))


def exact_mean(column: Column) -> Column:
    """Aggregate: the mean of a double column, from its exact sum; null over no values."""
    return F.try_divide(exact_sum(column), F.count(column))


def mean_of(name: str) -> Column:
    """The mean that a row's ``partial_sums`` hold."""
    return F.try_divide(summed(name), F.col(f"{name}_n"))


def rankable_mean(column: Column) -> Column:
    """Aggregate: a mean that is the very same double for equal means of different counts, as ranks

    with ties need: the sum is divided as a decimal. Null over no values."""
    bins = _sums(column)
    quotient = F.try_divide(_decimal(bins), F.count(column).cast("decimal(20,0)")).cast("double")
    # The other bins add exactly 0 to it unless they hold something; the quotient of the decimal is rounded once.
    return quotient + F.try_divide(_beside(bins), F.count(column))
