"""Reading the four input tables, and writing what the audit makes of them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlens.functions.columns import given_text
from ledgerlens.operators.shared import materialize
from ledgerlens.sources.schemas import TABLES

# Load order of rows that bring no sequence of their own: file by file, row by row.
POSITION = ("source_file", "source_row")


def load_tables(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """Read the four required tables from ``folder``, one file or subfolder per table.

    A missing table is a ``ValueError`` that names it. CSV files need a header line and are read
    as text; the audit parses the values itself, so that bad ones become null.
    """
    return {name: _load(spark, folder, name, fmt) for name in TABLES}


def _load(spark: SparkSession, folder: str, name: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
    for path in (f"{folder}/{name}", f"{folder}/{name}.{fmt}"):
        try:
            return with_position(reader.load(path), fmt)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    raise ValueError(f"Required table '{name}' not found in {folder}.")


def with_position(df: DataFrame, fmt: str = "parquet") -> DataFrame:
    """Add the load position of each row unless the table brings its order along."""
    if "source_seq" in df.columns or POSITION[1] in df.columns:
        return df
    if fmt == "parquet":
        return df.select(
            "*",
            F.col("_metadata.file_path").alias(POSITION[0]),
            F.col("_metadata.row_index").alias(POSITION[1]),
        )
    # Other formats know no row number. Ids that grow within a file block, written out once so that
    # every later read sees the same ones, give the same order.
    numbered = df.select(
        "*",
        F.col("_metadata.file_path").alias(POSITION[0]),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias(POSITION[1]),
    )
    return materialize(numbered, "loaded")


def without_missing_texts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Text that says a value is missing, such as ``N/A``, becomes null, as table readers take it."""
    texts = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: given_text(F.col(c)) for c in texts}) if texts else df


def load_order(df: DataFrame, order: tuple[str, ...]) -> list[str]:
    """The columns of ``order`` the table has, followed by the load position if it is known."""
    found = [c for c in (*order, POSITION[0], "source_block", POSITION[1]) if c in df.columns]
    if not found:
        raise ValueError(f"No load order: the table has none of {order} and no file position.")
    return found


def register_views(raw: dict[str, DataFrame], clean: dict[str, DataFrame], summary: DataFrame) -> None:
    """Make the audit's tables available to ``spark.sql``; a missing table stops with its name."""
    for name in TABLES:
        if name not in clean:
            raise ValueError(f"Missing clean_{name}: run the validation first.")
    raw["subscriptions"].createOrReplaceTempView("raw_subscriptions")
    for name in TABLES:
        clean[name].createOrReplaceTempView(f"clean_{name}")
    summary.createOrReplaceTempView("customer_summary")


def write_tables(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Write each table to ``folder/<name>``, replacing what was there.

    A table is written beside its place first, and takes it by renaming once it is whole. A run that fails
    on the way leaves the table that was there before.
    """
    for name, df in tables.items():
        beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        try:
            writer.save(beside)
            _swap(df.sparkSession, beside, f"{folder}/{name}")
        except BaseException:
            _remove(df.sparkSession, beside)
            raise


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as it knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def _remove(spark: SparkSession, path: str) -> None:
    files, found = _files(spark, path)
    files.delete(found, True)


def _swap(spark: SparkSession, new: str, place: str) -> None:
    """Let the folder ``new`` take the place of the folder ``place``, which comes back if that fails."""
    files, target = _files(spark, place)
    fresh, old = _files(spark, new)[1], _files(spark, f"{new}-old")[1]
    replaced = files.exists(target)
    if replaced and not files.rename(target, old):
        raise OSError(f"{place} can't be renamed.")
    if not files.rename(fresh, target):
        if replaced:
            files.rename(old, target)
        raise OSError(f"{new} can't be renamed to {place}.")
    if replaced:
        files.delete(old, True)


def save_table(df: DataFrame, name: str) -> None:
    """Create the managed table ``name`` from ``df``; an older one of that name is dropped once the new one is whole."""
    spark = df.sparkSession
    *schema, last = name.split(".")
    beside, old = (".".join([*schema, f"{last}_{kind}_{uuid.uuid4().hex}"]) for kind in ("new", "old"))
    try:
        df.write.saveAsTable(beside)
        replaced = spark.catalog.tableExists(name)
        if replaced:
            spark.sql(f"alter table {name} rename to {old}")
        try:
            spark.sql(f"alter table {beside} rename to {name}")
        except Exception:
            if replaced:
                spark.sql(f"alter table {old} rename to {name}")
            raise
    except BaseException:
        spark.sql(f"drop table if exists {beside}")
        raise
    if replaced:
        spark.sql(f"drop table {old}")
