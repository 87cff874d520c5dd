"""The date format of text columns, by a vote of their values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlens.functions.columns import YEARS, parse_timestamp, strip

ISO = "ISO"
# In the order in which they are preferred when votes are equal: the month comes first where a day could too.
CANDIDATES = tuple(
    f"{day}[ H:m[:s]]"
    for day in (
        "M/d/yyyy", "d/M/yyyy", "yyyy/M/d", "M-d-yyyy", "d-M-yyyy", "d.M.yyyy", "yyyy.M.d",
        "yyyyMMdd", "d MMM yyyy", "MMM d yyyy", "MMM d, yyyy", "d-MMM-yyyy", "d MMMM yyyy", "MMMM d, yyyy",
    )
)


class Inferred(NamedTuple):
    """The format that most values of a column are written in, and how sure that is."""

    format: str  # a date pattern, or ISO
    votes: int  # values that the format reads
    values: int  # values that are not null
    rivals: tuple[str, ...]  # formats that read as many, some of them as another date


def text_dates(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of the columns that hold dates as text."""
    return [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, StringType)]


def _reads(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every column as each of the formats reads it, ISO first, and whether it has a value."""
    texts = df.select(*[strip(F.col(c)).alias(c) for c in columns])
    texts = texts.select("*", *[parse_timestamp(texts, c).alias(f"{c} 0") for c in columns])
    read = []
    for c in columns:
        for i, pattern in enumerate(CANDIDATES, 1):
            # What is ISO text is read as that, whatever the pattern; a vote is for what the pattern adds.
            found = F.try_to_timestamp(F.when(F.col(f"{c} 0").isNull(), F.col(c)), F.lit(pattern))
            read.append(found.cast("timestamp_ntz").alias(f"{c} {i}"))
    sound = texts.select("*", *read)
    return sound.withColumns(
        {f"{c} {i}": F.when(F.year(f"{c} {i}").between(*YEARS), F.col(f"{c} {i}")) for c in columns for i in range(1, len(CANDIDATES) + 1)}
    )


def inferred_formats(df: DataFrame, columns: Sequence[str]) -> dict[str, Inferred]:
    """The format of each text column among ``columns``, in one pass over the table.

    Every value votes for all formats that read it, and the format with most votes wins; ISO wins a draw, then
    the format that ``CANDIDATES`` names first. Formats that draw with the winner and read some value
    as another date are its ``rivals``: the column does not say which of them is meant. Of a column that
    no format reads the format is ISO, with no votes.
    """
    columns = text_dates(df, columns)
    if not columns:
        return {}
    names, asked = [ISO, *CANDIDATES], []
    for c in columns:
        reads = [F.col(f"{c} {i}") for i in range(len(names))]
        asked.append(F.count(c).alias(f"{c} values"))
        asked += [F.count(read).alias(f"{c} votes {i}") for i, read in enumerate(reads)]
        # A rival is a format by which some date is another one than by the first format that reads it.
        first = F.coalesce(*reads[1:])
        asked += [F.count_if(read != first).alias(f"{c} differs {i}") for i, read in enumerate(reads) if i]
    row = _reads(df, columns).agg(*asked).first()
    found = {}
    for c in columns:
        votes = [row[f"{c} votes {i}"] for i in range(len(names))]
        best = votes.index(max(votes))
        rivals = [
            names[i] for i in range(1, len(names)) if best and i != best and votes[i] == votes[best] and row[f"{c} differs {i}"]
        ]
        found[c] = Inferred(names[best], votes[best], row[f"{c} values"], tuple(rivals))
    return found


def patterns(inferred: Mapping[str, Inferred]) -> dict[str, tuple[str, ...]]:
    """The patterns by which each column is to be read beside ISO."""
    return {c: () if i.format == ISO else (i.format,) for c, i in inferred.items()}


def format_report(spark, inferred: Mapping[str, Mapping[str, Inferred]]) -> DataFrame:
    """A row for each text date column of the tables: its format and how sure that is."""
    rows = [
        (table, column, i.format, i.votes, i.values, bool(i.rivals))
        for table, columns in inferred.items()
        for column, i in columns.items()
    ]
    schema = "table_name string, column_name string, date_format string, votes long, date_values long, ambiguous boolean"
    return spark.createDataFrame(rows, schema)
