"""Ranks, positions and quantiles over a whole table, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators import joins
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, measure, text_bytes

# Rows that one task may put in order.
WINDOW_ROWS = 1 << 20


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, below: str, total: str
) -> Measured:
    """Add the sum of ``value`` over the rows before (``below``) and over all rows (``total``).

    Rows are taken per ``by`` in ascending ``order``, which must tell the rows of a group apart. They are
    written first; up to ``WINDOW_ROWS`` of them are then put in order by one window, more in ranges.
    """
    by, order = list(by), list(order)
    written = measure(df, "counted", rows=F.count(F.lit(1)), bytes=text_bytes(df))
    if written.measures["rows"] > WINDOW_ROWS:
        return _total_by_ranges(written.table, by, order, value, below, total)
    return Measured(_total_by_window(written.table, by, order, value, below, total), written.measures)


def _total_by_window(df: DataFrame, by: list[str], order: list[str], value: str, below: str, total: str) -> DataFrame:
    group = Window.partitionBy(*by)
    earlier = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {below: F.coalesce(F.sum(value).over(earlier), F.lit(0)), total: F.sum(value).over(group)}
    )


def _total_by_ranges(df: DataFrame, by: list[str], order: list[str], value: str, below: str, total: str) -> Measured:
    """The rows are cut into ranges by Spark's own range partitioning, which balances them whatever the

    values are, and written with the number of their range, so that the sums per range and the sums
    within a range see the same cut even if tasks run again.
    """
    cut = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id())
    written = measure(cut, "ranges", bytes=text_bytes(cut))
    # One row per range (and group): as many as there are shuffle partitions, not rows.
    sums = written.table.groupBy(*by, "_range").agg(F.sum(value).alias("_sum"))
    whole = Window.partitionBy(*by)
    earlier_ranges = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "_range",
        F.coalesce(F.sum("_sum").over(earlier_ranges), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(whole).alias(total),
    )
    earlier_rows = Window.partitionBy(*by, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        written.table.withColumn(below, F.coalesce(F.sum(value).over(earlier_rows), F.lit(0)))
        .join(F.broadcast(offsets), [*by, "_range"])
        .withColumn(below, F.col(below) + F.col("_offset"))
        .drop("_range", "_offset")
    )
    return Measured(placed, written.measures)


def _rank() -> Column:
    """The mean rank of equal values, as a part of all values."""
    return (F.col("_below") + (F.col("_n") + 1) / 2) / F.col("_total")


def percent_ranks(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Per ``key`` the rank of each column among its non-null values, divided by their number.

    Equal values share the average of their ranks; a null value has a null rank, and a row of nulls is
    left out. ``key`` must be unique.
    """
    given = df.select(key, *columns).dropna("all", subset=list(columns))
    into = [f"_rank_{i}" for i in range(len(columns))]
    return add_percent_ranks(given, key, columns, into).select(key, *[F.col(i).alias(c) for i, c in zip(into, columns)])


def add_percent_ranks(df: DataFrame, key: str, columns: Sequence[str], into: Sequence[str]) -> DataFrame:
    """``df`` with the ranks of some columns, as of ``percent_ranks``, as further columns.

    Ranks are made of the distinct values and their counts, so that a value shared by a third of all rows
    is one row to sort. If the measured counts allow, every row looks its ranks up where it is; otherwise
    values and ranks are joined by value, and the ranks by ``key``.
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("_column"), F.col(c).alias("_value")) for i, c in enumerate(columns)])
    values = (
        df.select(key, F.explode(pairs).alias("_pair"))
        .select(key, "_pair.*")
        .where(F.col("_value").isNotNull())
    )
    counts = values.groupBy("_column", "_value").agg(F.count(F.lit(1)).alias("_n"))
    written = measure(counts, "value_counts", rows=F.count(F.lit(1)), bytes=text_bytes(counts))
    if written.measures["rows"] <= WINDOW_ROWS and written.measures["bytes"] <= joins.BROADCAST_BYTES:
        return _ranks_in_place(df, columns, into, written.table)
    placed = running_total(written.table, ["_column"], ["_value"], "_n", "_below", "_total")
    ranks = Measured(placed.table.select("_column", "_value", _rank().alias("_rank")), placed.measures)
    found = sized_join(values, ranks, ["_column", "_value"], [key])
    found = found.groupBy(key).agg(
        *[F.max(F.when(F.col("_column") == i, F.col("_rank"))).alias(name) for i, name in enumerate(into)]
    )
    return df.join(found, key, "left")


def _ranks_in_place(df: DataFrame, columns: Sequence[str], into: Sequence[str], counts: DataFrame) -> DataFrame:
    found = df
    for i, (c, name) in enumerate(zip(columns, into)):
        own = counts.where(F.col("_column") == i).drop("_column")
        placed = _total_by_window(own, [], ["_value"], "_n", "_below", "_total")
        ranks = placed.select(F.col("_value").alias(c), _rank().alias(name))
        found = found.join(F.broadcast(ranks), c, "left")
    return found.select(*df.columns, *into)


def positions(df: DataFrame, by: Sequence[str], order: Sequence[str], position: str, total: str) -> DataFrame:
    """Number the rows of each group from 0 in ``order``, and add the group's number of rows."""
    placed = running_total(df.withColumn("_one", F.lit(1)), by, order, "_one", position, total)
    return placed.table.drop("_one")


def tile(position: Column, total: Column, tiles: int) -> Column:
    """The 1-based tile of a 0-based position when ``total`` rows are dealt into ``tiles`` tiles,

    the first of which take one row more each if the rows do not divide evenly."""
    size = F.floor(total / tiles)
    larger = total % tiles
    in_larger = larger * (size + 1)
    return (
        F.when(position < in_larger, F.floor(position / (size + 1)) + 1)
        .otherwise(F.floor((position - in_larger) / F.greatest(size, F.lit(1))) + larger + 1)
        .cast("int")
    )
