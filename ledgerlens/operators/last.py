"""The last row of each group, without aggregating rows.

The greatest of a number of fixed width is kept in a hash table, where the greatest of a struct would
sort all rows. So the place of a row, its moment and the first column of the load order, is packed into
one decimal, and the rows at the greatest place are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, measure, measure_size

DAY = 86_400_000_000
EPOCH = date(1970, 1, 1)
# Beyond the microseconds of any timestamp.
FAR = 1 << 60


def microseconds(moment: Column) -> Column:
    """A timestamp without zone as a long; later ones are greater."""
    minutes = (F.hour(moment) * 60 + F.minute(moment)).cast("long")
    within = (F.extract(F.lit("SECOND"), moment) * 1_000_000).cast("long")
    return F.datediff(moment, F.lit(EPOCH)).cast("long") * F.lit(DAY) + minutes * F.lit(60_000_000) + within


def packed_place(df: DataFrame, moment: Column, order: Sequence[str]) -> Column:
    """One decimal for the moment, a long within ``FAR`` of zero on either side, and, if it is a whole number, the first of ``order``."""
    if not isinstance(df.schema[order[0]].dataType, IntegralType):
        return moment.cast("decimal(38,0)")
    position = F.coalesce(F.col(order[0]).cast("decimal(20,0)"), F.lit(Decimal(-(1 << 63))))
    return (moment.cast("decimal(19,0)") * F.lit(Decimal(1 << 64)) + position).cast("decimal(38,0)")


def last_rows(rows: DataFrame, groups: Measured, key: str, place: str, last: str, order: Sequence[str]) -> DataFrame:
    """The rows with the columns of their group, one row a group: that with ``place`` equal to the group's ``last``.

    Rows that share it are told apart by ``order``, of which each column in turn leaves the rows with its
    greatest value; a null is less than any value. ``groups`` has one row per ``key`` that is not null, its
    ``measures`` the number of them as ``rows``.
    """
    found = sized_join(rows, groups, [key], order, "inner").where(F.col(place).eqNullSafe(F.col(last))).drop(place, last)
    found = measure(found, "last_rows", rows=F.count(F.lit(1)))
    for column in order:
        if found.measures["rows"] <= groups.measures["rows"]:
            break
        greatest = measure_size(found.table.groupBy(key).agg(F.max(column).alias("_greatest")), "greatest")
        left = sized_join(found.table, greatest, [key], order, "inner")
        left = left.where(F.col(column).eqNullSafe(F.col("_greatest"))).drop("_greatest")
        found = measure(left, "last_rows", rows=F.count(F.lit(1)))
    return found.table.drop(*order)
