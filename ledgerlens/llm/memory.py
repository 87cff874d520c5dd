"""Memory of Python workers, which Spark keeps for later tasks."""

from __future__ import annotations

import ctypes
from contextlib import suppress

import pyarrow as pa


def give_back() -> None:
    """Return what a task has freed to the system, so that the worker's next task does not come on top of it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def after_group(f):
    """A function of a key and a table, as of ``applyInArrow``, that gives memory back at its end."""

    def run(key, table):
        try:
            return f(key, table)
        finally:
            give_back()

    return run


def after_batches(f):
    """A function of batches, as of ``mapInArrow``, that gives memory back at its end."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def after_cogroup(f):
    """A function of a key and two tables, as of a cogroup's ``applyInArrow``, that gives memory back at its end."""

    def run(key, table, other):
        try:
            return f(key, table, other)
        finally:
            give_back()

    return run
