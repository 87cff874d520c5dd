"""Row marks that depend on other rows: repeated ids and references to nothing.

Both find the few offending keys first, on the key column alone and pre-aggregated before the
shuffle, and then mark the rows by looking their key up. As long as offenders are rare the wide
rows are never shuffled. Where repeated ids are too many for that, the rows are shuffled once, by id.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.operators.joins import _crowded_keys, sized_join, task_count
from ledgerlens.operators.shared import Measured, measure, measure_size, text_bytes

# What a column of a place takes in a broadcast table, about.
PLACE_BYTES = 20
# One key of so many is counted first.
PROBED = 64


class Repeated(NamedTuple):
    """Keys with the place of their first row: all that several rows share, or else (``ranked``) only those

    of more rows than a task should put in order."""

    firsts: Measured
    ranked: bool


def repeated_keys(df: DataFrame, key: str, order: Sequence[str]) -> Repeated:
    """The non-null values of ``key`` that several rows share.

    Counting needs the key column alone; only rows of the keys found are then asked for their place, if a
    table of all these keys and places can be broadcast. Where one key in ``PROBED`` shows that it surely cannot,
    not all are counted: almost as many keys as rows would fill each task's memory before the shuffle.
    """
    given = df.where(F.col(key).isNotNull())
    probe = _shared_keys(given.where(F.pmod(F.xxhash64(key), F.lit(PROBED)) == 0), key, f"probed_{key}")
    ranked = PROBED * _places_bytes(probe, order) > 2 * joins.BROADCAST_BYTES
    if not ranked:
        keys = _shared_keys(given, key, f"shared_{key}")
        ranked = _places_bytes(keys, order) > joins.BROADCAST_BYTES
    if ranked:
        keys = measure_size(_crowded_keys(given, [key]).keys.select(key), f"crowded_{key}")
        if not keys.measures["bytes"]:
            return Repeated(Measured(keys.table.withColumn("_first", F.lit(None)), keys.measures), ranked)
    places = sized_join(given.select(key, *order), keys, [key], order, "left_semi")
    firsts = places.groupBy(key).agg(F.min(_place(order)).alias("_first"))
    return Repeated(measure_size(firsts, f"repeated_{key}"), ranked)


def _shared_keys(given: DataFrame, key: str, name: str) -> Measured:
    shared = given.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    return measure(shared, name, keys=F.count(F.lit(1)), bytes=text_bytes(shared))


def _places_bytes(shared: Measured, order: Sequence[str]) -> int:
    """The size of a table of these keys with their places, about."""
    return shared.measures["bytes"] + shared.measures["keys"] * PLACE_BYTES * len(order)


def unknown_keys(df: DataFrame, key: str, known: DataFrame) -> Measured:
    """The non-null values of ``key`` that are not in the one-column frame ``known``."""
    used = df.select(key).where(F.col(key).isNotNull()).distinct()
    unknown = used.join(known.distinct(), key, "left_anti").withColumn("_unknown", F.lit(True))
    return measure_size(unknown, f"unknown_{key}")


def mark_repeats(
    df: DataFrame, repeated: Repeated, key: str, order: Sequence[str], into: str, among: Column | None = None
) -> DataFrame:
    """Flag every row but the first, in ``order``, of those that share a key.

    ``among`` says which rows ``repeated`` was made of (all by default); flags of others mean nothing.
    """
    among = F.lit(True) if among is None else among
    found = F.col("_first").isNotNull()
    behind = found & ~F.col("_first").eqNullSafe(_place(order))
    if not repeated.ranked:
        return sized_join(df, repeated.firsts, [key], order).withColumn(into, behind).drop("_first")
    # Few keys are left to look up. Their rows, and those without a key, are dealt out to all tasks.
    marked = sized_join(df, repeated.firsts, [key], order) if repeated.firsts.measures["bytes"] else df.withColumn("_first", F.lit(None))
    behind = behind if repeated.firsts.measures["bytes"] else F.lit(False)
    apart = found | F.col(key).isNull() | ~among
    salt = F.when(apart, F.pmod(F.xxhash64(*order), F.lit(task_count(df))) + 1).otherwise(F.lit(0))
    # A single column's least value is no null, that of a struct is one.
    places = [F.asc_nulls_last(order[0])] if len(order) == 1 else [F.asc_nulls_first(c) for c in order]
    marked = marked.withColumns({"_apart": apart, "_salt": salt.cast("int")})
    place = F.rank().over(Window.partitionBy(key, "_salt").orderBy(*places))
    later = F.when(F.col("_apart"), behind).otherwise(place > 1)
    return marked.withColumn(into, later).drop("_first", "_apart", "_salt")


def mark_unknown(
    df: DataFrame, unknown: Measured, key: str, spread_by: Sequence[str], into: str, counted: DataFrame | None = None
) -> DataFrame:
    """Flag the rows that refer to an unknown key; for ``spread_by`` and ``counted`` see ``spread_join``."""
    marked = sized_join(df, unknown, [key], spread_by, counted=counted)
    return marked.withColumn(into, F.coalesce("_unknown", F.lit(False))).drop("_unknown")


def _place(order: Sequence[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])
