"""Reproducible shuffle and sharding: a Feistel permutation of the global row numbers.

A row's shard and slot follow from its row number alone, and its row number from its slot and
shard, so any row can be found without a lookup table. DataFrame functions only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.shared import measure

PRIME = 2147483647
SECOND_PRIME = 2147483629
ROUNDS = 6


def _round_keys(seed: int) -> list[tuple[int, int, int]]:
    """Three multipliers below 2^30 for each round, from a linear congruential sequence."""
    state, keys = seed % PRIME, []
    for _ in range(ROUNDS):
        three = []
        for _ in range(3):
            state = (state * 48271 + 12345) % PRIME
            three.append(state // 2 + 1)
        keys.append(tuple(three))
    return keys


def _mixed(x: Column, key: tuple[int, int, int]) -> Column:
    """A hash of x (below 2^31) in 28 bits; no step exceeds 2^63, and x is named only once, so that

    the expression of all rounds stays small. Two moduli, as one alone would leave it linear.
    """
    a, b, c = (F.lit(k).cast("bigint") for k in key)
    return F.shiftright((x * a + b) % F.lit(PRIME) * c % F.lit(SECOND_PRIME), 3)


def _sides(n: int) -> tuple[int, int]:
    """The grid of the permutation: high x low >= n, by less than high."""
    high = math.isqrt(n - 1) + 1
    return high, -(-n // high)


def _step(x: Column, n: int, seed: int, inverse: bool = False) -> Column:
    """One pass of the Feistel rounds over the grid, or of their inverse."""
    sides = _sides(n)
    halves = [F.call_function("div", x, F.lit(sides[1])), x % F.lit(sides[1])]
    rounds = list(enumerate(_round_keys(seed)))
    for i, key in reversed(rounds) if inverse else rounds:
        side = i % 2
        change = _mixed(halves[1 - side], key) % F.lit(sides[side])
        change = F.lit(sides[side]) - change if inverse else change
        halves[side] = (halves[side] + change) % F.lit(sides[side])
    return halves[0] * F.lit(sides[1]) + halves[1]


def permuted(df: DataFrame, number: str, n: int, to: str, seed: int, inverse: bool = False) -> DataFrame:
    """Add ``to``: the place of row ``number`` (0 to n - 1) in the shuffle, or with ``inverse`` the

    row number at a place. The step is repeated until its result is below n. Fewer than ``high``
    numbers of the grid are not, so a walk of ``high`` steps always ends; about one row in ``high``
    walks at all.
    """
    def again(y: Column) -> Column:
        return F.when(y < n, y).otherwise(_step(y, n, seed, inverse))

    walk = F.aggregate(F.sequence(F.lit(1), F.lit(_sides(n)[0])), F.col("_once"), lambda y, _: again(y))
    walked = F.when(F.col("_once") < n, F.col("_once")).otherwise(walk)
    return df.withColumn("_once", _step(F.col(number), n, seed, inverse)).withColumn(to, walked).drop("_once")


def numbered(df: DataFrame, order: Sequence[str], to: str) -> tuple[DataFrame, int]:
    """Add gapless row numbers from 0 in the given order, and return the number of rows.

    The rows are cut into ranges by Spark's range partitioner and written with the number of their
    range, so a task that runs again sees the same cut; equal rows are told apart by their place in
    the input, so even one value in a third of all rows is cut evenly. Rows are counted by range.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    cut = tied.repartitionByRange(*order, "_tie").withColumn("_range", F.spark_partition_id())
    written = measure(cut, "numbered", rows=F.count(F.lit(1)))
    # One row for each range: as many as there are shuffle partitions.
    sizes = written.table.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(*order, "_tie")
    placed = (
        written.table.withColumn("_place", F.row_number().over(within))
        .join(F.broadcast(offsets), "_range")
        .withColumn(to, F.col("_place") + F.col("_offset") - 1)
        .drop("_range", "_place", "_offset", "_tie")
    )
    return placed, written.measures["rows"]


def shard(df: DataFrame, order: Sequence[str], shards: int = 8, seed: int = 20) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 within the shard).

    Rows are numbered in ``order``, permuted, and dealt out in turn, so the shards' row counts are
    at most one apart (law ``rows``). The same rows, shard count and seed give the same result,
    whatever the files or partitions. Nulls sort first; rows equal in ``order`` take their numbers
    among themselves in input order; an empty table gives an empty result. Columns of ``df`` named
    ``shard`` or ``slot`` are replaced, those with a leading underscore are for internal use.
    """
    placed, n = numbered(df.drop("shard", "slot"), order, "_row")
    if n == 0:
        return placed.drop("_row").withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("bigint")})
    return permuted(placed, "_row", n, "_to", seed).withColumns(
        {"shard": (F.col("_to") % shards).cast("int"), "slot": F.call_function("div", F.col("_to"), F.lit(shards))}
    ).drop("_row", "_to")


def document_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 1) and text_crc32 (unsigned) of each row.

    A null text has no bytes: size 1, checksum 0.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
