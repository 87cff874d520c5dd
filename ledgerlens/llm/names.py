"""Columns of the input whose names begin with an underscore, as the operators' own do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


def with_own_names(docs: DataFrame, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` on ``docs`` with such columns renamed for the time being."""
    taken, renamed = {c.lower() for c in docs.columns}, {}
    for c in docs.columns:
        if c.startswith("_"):
            other = f"own{c}"
            while other.lower() in taken:
                other = f"own_{other}"
            taken.add(other.lower())
            renamed[c] = other
    if not renamed:
        return run(docs)
    return run(docs.withColumnsRenamed(renamed)).withColumnsRenamed({new: old for old, new in renamed.items()})
