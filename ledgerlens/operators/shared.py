"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a folder in the session's warehouse, which all executors reach too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_ledgerlens"


def application_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/{spark.conf.get('spark.app.id')}"


def remove_intermediates(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application; results that still read them fail from then on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Measured(NamedTuple):
    """A written table and what was measured while writing it."""

    table: DataFrame
    measures: dict[str, int]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage: readers share one result, losing an executor loses nothing of it, and the
    planner knows its real size.
    """
    spark = df.sparkSession
    path = f"{application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measure(df: DataFrame, name: str, **measures: Column) -> Measured:
    """``materialize`` that also collects the given whole-number aggregates, in the same job."""
    observed = Observation()
    columns = [F.coalesce(c, F.lit(0)).cast("bigint").alias(n) for n, c in measures.items()]
    table = materialize(df.observe(observed, *columns), name)
    found = observed.get
    # Spark drops the observation together with a result it finds to be empty.
    return Measured(table, {n: found.get(n) or 0 for n in measures})


def text_bytes(df: DataFrame) -> Column:
    """Aggregate: size of the rows written as text, with a word per value on top."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 8 for c in df.columns]
    return F.sum(reduce(lambda a, b: a + b, sizes))


def measure_size(df: DataFrame, name: str) -> Measured:
    return measure(df, name, bytes=text_bytes(df))


def together(*builds: Callable[[], Any]) -> list[Any]:
    """Call the functions at the same time, so that their Spark jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=len(builds)) as pool:
        return [f.result() for f in [pool.submit(b) for b in builds]]
