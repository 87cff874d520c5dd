"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.names import with_own_names
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import measure_size

# A Poisson variable of a large mean is drawn as the sum of draws with at most this mean each.
PART_MEAN = 16.0
# P(Poisson(16) > 96) is below 2^-52, the resolution of the uniform numbers.
PART_TERMS = 96


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) with 52 bits from a hash of the given values."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, total: float | None) -> DataFrame:
    """Per source the mean number of copies of each of its rows (``_rate``) and the table of the

    cumulative Poisson probabilities of one of its ``_parts`` equal parts (``_cdf``).

    A source's share of the output is its weight among those of all sources that have rows. Without
    weights all sources weigh the same; sources missing in them weigh nothing. ``total`` is the
    expected number of output rows, without it that of the input.
    """
    counts = docs.groupBy(F.col("source").alias("_source")).agg(F.count(F.lit(1)).alias("_rows"))
    if weights is None:
        weight = F.lit(1.0)
    elif weights:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(F.try_element_at(given, F.col("_source")).cast("double"), F.lit(0.0))
    else:
        weight = F.lit(0.0)
    counts = counts.withColumn("_weight", weight)
    totals = counts.agg(F.sum("_weight").alias("_all_weights"), F.sum("_rows").alias("_all_rows"))
    wanted = F.lit(float(total)) if total is not None else F.col("_all_rows").cast("double")
    share = F.when(F.col("_all_weights") > 0, F.col("_weight") / F.col("_all_weights")).otherwise(F.lit(0.0))
    rates = (
        counts.join(F.broadcast(totals))
        .withColumn("_rate", share * wanted / F.col("_rows"))
        .withColumn("_parts", F.greatest(F.lit(1), F.ceil(F.col("_rate") / PART_MEAN)).cast("int"))
        .withColumn("_mean", F.col("_rate") / F.col("_parts"))
    )
    start = F.struct(F.exp(-F.col("_mean")).alias("p"), F.array(F.exp(-F.col("_mean"))).alias("cdf"))
    table = F.aggregate(
        F.sequence(F.lit(1), F.lit(PART_TERMS)),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * F.col("_mean") / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * F.col("_mean") / k)).alias("cdf"),
        ),
        lambda acc: acc["cdf"],
    )
    return rates.select("_source", "_rate", "_parts", table.alias("_cdf"))


def mix(
    docs: DataFrame, weights: Mapping[str, float] | None = None, total: float | None = None, seed: int = 2
) -> DataFrame:
    """Repeat each row a Poisson number of times so that sources meet their target weights.

    The number is the inverse of the Poisson distribution, whose mean is the rate of the row's
    source, at a uniform number hashed from the seed, ``doc_id`` and, for rows that repeat a doc_id,
    the text. So it depends on the row alone and not on files, partitions or retries; equal rows get
    equal numbers. The copies are shuffled globally: dealt to partitions, and sorted there, by a
    hash of row and copy, so neighbours in the input land anywhere. Adds ``rate``, ``copies``,
    ``copy`` (0 to copies - 1) and ``shuffle_key`` (hex text, ascending within a partition). A null source is a source of its own (weight 0 if weights are given),
    null ids and texts hash as such, an empty table stays empty. Columns of these four names are
    replaced, any others stay as they are. The per-source table joins by its measured size; a hot source is not shuffled.
    """
    return with_own_names(docs, lambda own: _mixed(own, weights, total, seed))


def _mixed(docs: DataFrame, weights: Mapping[str, float] | None, total: float | None, seed: int) -> DataFrame:
    docs = docs.drop("rate", "copies", "copy", "shuffle_key")
    rates = measure_size(source_rates(docs, weights, total), "source_rates")
    # Never null, so that a plain equality joins rows without a source too.
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    table = rates._replace(
        table=rates.table.withColumn(
            "_key", F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit(""))
        ).drop("_source")
    )
    rated = sized_join(docs.withColumn("_key", key), table, ["_key"], ["doc_id"], "inner")
    row = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("~")), F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("~"))))
    numbers = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda j: uniform(F.lit(seed), F.col("_row"), j))
    draws = F.transform(numbers, lambda u: F.size(F.filter(F.col("_cdf"), lambda c: c <= u)))
    copies = F.aggregate(draws, F.lit(0), lambda acc, x: acc + x)
    counted = rated.withColumn("_row", row).withColumn("copies", copies).where("copies > 0")
    exploded = counted.select(
        *docs.columns,
        F.col("_rate").alias("rate"),
        "copies",
        F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
        "_row",
    )
    keyed = exploded.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit(f"shuffle {seed}"), F.col("_row"), F.col("copy"))))
    return keyed.drop("_row").repartition("shuffle_key").sortWithinPartitions("shuffle_key")
