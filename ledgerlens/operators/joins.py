"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerlens.operators.shared import Measured, materialize, together

BROADCAST_BYTES = 32 * 1024 * 1024
# Keys of fewer rows are no burden for a task, however small the table is.
LEAST_HOT_ROWS = 1000
# Rows are counted by a hash of their key in so many counters before any key is.
COUNTERS = 1 << 14


def sized_join(
    left: DataFrame,
    right: Measured,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str = "left",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join (left, inner, left semi or left anti) with a table whose size was measured when it was written.

    Within ``BROADCAST_BYTES`` it is broadcast and ``left`` is not shuffled; beyond, see
    ``spread_join``.
    """
    if right.measures["bytes"] <= BROADCAST_BYTES:
        return left.join(F.broadcast(right.table), list(on), how)
    return spread_join(left, right.table, on, spread_by, how, counted)


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    how: str,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Shuffled join (inner, left, left semi or left anti) in which no key of either side lands in one task.

    A key is hot if it holds more rows of a side than a task's fair share. The rows of the side that
    has more of it are dealt out by a hash of all their columns (left: of ``spread_by``, which should
    tell rows of one key apart) over as many salts as that side needs tasks for the key, and the rows of
    the other side are repeated for each of these salts. Rows with a null key match nothing and are
    dealt out alike. ``counted`` has the keys of ``left`` too and is counted in its place, where ``left``
    is the result of shuffles that would run once more for it.

    Without hot keys the join is on the keys alone and left rows with a null key are added unshuffled, so
    that grouping by the keys, of rows that have them, needs no further shuffle.
    """
    on = list(on)
    if how in ("left_semi", "left_anti"):
        right = right.select(*on).distinct()
    hot = _hot_keys(left if counted is None else counted, right, on)
    by_left = hot.where("_deal_left").drop("_deal_left")
    by_right = hot.where("not _deal_left").drop("_deal_left")
    parts = []
    if by_right.isEmpty():
        if by_left.isEmpty():
            return _join_without_hot_keys(left, right, on, how)
    else:
        # Keys of which the right side has more all have partners there, so an inner join of them will do.
        few = left.join(F.broadcast(by_right), on, "inner").withColumn("_salt", _all_salts(F.col("_salts"))).drop("_salts")
        many = right.join(F.broadcast(by_right), on, "inner")
        many = many.withColumn("_salt", _dealt(right.columns, F.col("_salts"))).drop("_salts")
        parts.append(few.join(many, [*on, "_salt"], "inner").drop("_salt"))
        left = left.join(F.broadcast(by_right.select(*on)), on, "left_anti")
        right = right.join(F.broadcast(by_right.select(*on)), on, "left_anti")
    tasks = task_count(left)
    salts = F.when(_any_null(on), F.lit(tasks)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted_left = left.join(F.broadcast(by_left), on, "left").withColumn("_salt", _dealt(spread_by, salts)).drop("_salts")
    salted_right = (
        right.join(F.broadcast(by_left), on, "left")
        .withColumn("_salt", _all_salts(F.coalesce("_salts", F.lit(1))))
        .drop("_salts")
    )
    joined = salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")
    return reduce(DataFrame.unionByName, parts, joined)


def _any_null(on: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])


def _join_without_hot_keys(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    if how in ("inner", "left_semi"):
        return left.join(right, on, how)
    joined = left.where(~_any_null(on)).join(right, on, how)
    alone = left.where(_any_null(on))
    # As a literal, the null of a single key lets Spark leave these rows out where the key must be given.
    nulls = on if len(on) == 1 else []
    nulls = {f.name: f.dataType for f in joined.schema if f.name in nulls or f.name not in left.columns}
    alone = alone.withColumns({c: F.lit(None).cast(kind) for c, kind in nulls.items()})
    return joined.unionByName(alone)


def task_count(df: DataFrame) -> int:
    """Tasks of a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt(columns: Sequence[str], salts: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), salts).cast("int")


def _all_salts(salts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (salts - 1).cast("int")))


class _Side(NamedTuple):
    keys: DataFrame  # with the number of rows, _n
    share: float  # a task's fair share of the rows


def _crowded_keys(df: DataFrame, on: list[str]) -> _Side:
    """Keys with more rows than a task's fair share.

    Rows are counted by a hash of their key first, in few counters and without shuffling keys; only keys under
    counters that hold as much as a hot key are counted themselves."""
    observed = Observation()
    keys = df.select(*on).na.drop().withColumn("_counter", F.pmod(F.xxhash64(*on), F.lit(COUNTERS)).cast("int"))
    n = F.count(F.lit(1)).alias("_n")
    counters = keys.groupBy("_counter").agg(n).observe(observed, F.sum("_n").alias("rows"))
    counters = materialize(counters.where(F.col("_n") >= LEAST_HOT_ROWS), "key_counters")
    share = (observed.get.get("rows") or 0) / task_count(df)
    crowded = (F.col("_n") >= LEAST_HOT_ROWS) & (F.col("_n") > F.lit(share))
    full = counters.where(crowded).select("_counter")
    if full.isEmpty():
        return _Side(df.select(*on).withColumn("_n", F.lit(0).cast("bigint")).limit(0), share)
    counts = keys.join(F.broadcast(full), "_counter", "left_semi").groupBy(*on).agg(n)
    return _Side(materialize(counts.where(crowded), "crowded_keys"), share)


def _hot_keys(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """At most two keys for each task: how many salts (``_salts``) and whether left rows are dealt out (``_deal_left``)."""
    sides = together(*[lambda df=df: _crowded_keys(df, on) for df in (left, right)])
    counted = [
        side.keys.withColumn("_need", F.ceil(F.col("_n") / F.lit(max(side.share, 1.0))).cast("int")) for side in sides
    ]
    a, b = (c.toDF(*on, f"_n{i}", f"_need{i}") for i, c in enumerate(counted))
    both = a.join(b, on, "full_outer")
    n0, n1 = F.coalesce("_n0", F.lit(0)), F.coalesce("_n1", F.lit(0))
    deal_left = n0 >= n1
    # Where both sides have many rows, their pairs need tasks too.
    pairs = F.ceil(n0.cast("double") * n1 / F.lit(max(side.share for side in sides)))
    need = F.greatest(F.when(deal_left, F.col("_need0")).otherwise(F.col("_need1")), F.least(pairs, F.lit(task_count(left))))
    return both.select(*on, need.cast("int").alias("_salts"), deal_left.alias("_deal_left"))
