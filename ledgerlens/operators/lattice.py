"""Subtotals made of cells instead of rows.

A rollup of rows repeats every row for every level. Here rows are summed into the finest cells once, and the
rollup repeats the cells, which are few.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def subtotals(rows: DataFrame, keys: Sequence[str], sums: Sequence[Column], merged: Sequence[Column]) -> DataFrame:
    """The cells by ``keys`` and all their subtotals down to the total, with the ``level`` of ``grouping_id``.

    ``sums`` are the aggregates that make a cell of rows; ``merged`` make one of several cells, under the
    cells' own names. No rows give no cells and no total.
    """
    cells = rows.groupBy(*keys).agg(*sums)
    return cells.rollup(*keys).agg(F.grouping_id().cast("int").alias("level"), *merged)
