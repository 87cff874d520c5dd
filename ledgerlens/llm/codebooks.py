"""Vector codes by product quantisation with integer codebooks, trained by Lloyd's rounds over resident members.

Vectors become integers and are cut into parts. A part lives with the owner of its codebook entry, one
of the (position, entry, salt) by which Spark deals the parts out. A round is one narrow pass over the
owners' parts, which finds each part's nearest entry and the sums by which the owners' entries are
replaced. Parts that keep their entry are written where they are; only those that change it are shuffled
to their new owners, when the next round reads them. Sums are whole numbers, so neither the order of
rows nor a task that runs again changes a codebook. The driver holds the codebooks alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.shipping import ship
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import materialize, measure, measure_size

# A component x becomes floor(SCALE * x); how many parts, entries and rounds.
SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6

PARTS_PER_TASK = 1 << 20
# Whole numbers below this leave room for the squared distances of a vector in 64 bits.
SMALL = float(1 << 26)
LARGEST = (1 << 63) - 1

Codebooks = list[list[list[int]]]  # by part position and entry, the components

STATE = "row long, position int, entry int, part array<double>"


def usable(column: str) -> Column:
    """Whether a vector is there and all its components, scaled, are finite numbers."""
    finite = F.forall(column, lambda x: F.coalesce(F.abs(x.cast("double") * SCALE) < float("inf"), F.lit(False)))
    return F.coalesce(finite & (F.size(column) > 0), F.lit(False))


def cuts(length: int) -> list[int]:
    """Where the parts of a vector begin and end; parts differ by one component if the length does not divide evenly."""
    return [0, *np.cumsum([length // PARTS + (i < length % PARTS) for i in range(PARTS)]).tolist()]


# In a task


def _nearest(parts: np.ndarray, entries: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, the lower one of equals, and the squared distance."""
    largest = max((abs(c) for e in entries for c in e), default=0)
    if largest < SMALL and (not parts.size or np.abs(parts).max() < SMALL):
        x, book = parts.astype(np.int64), np.array(entries, np.int64).reshape(len(entries), -1)
    else:  # numbers without bound
        x = np.array([[int(v) for v in p] for p in parts.tolist()], object).reshape(parts.shape)
        book = np.array(entries, object).reshape(len(entries), -1)
    best, entry = None, np.zeros(len(x), np.int64)
    for e, centre in enumerate(book):
        distance = ((x - centre) ** 2).sum(axis=1)
        if best is None:
            best = distance
        else:
            closer = (distance < best).astype(bool)
            best, entry = np.where(closer, distance, best), np.where(closer, e, entry)
    return entry, best


def _by_position(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, rows, parts as a matrix) of a batch."""
    positions = batch.column("position").to_numpy()
    for position in np.unique(positions).tolist():
        rows = np.flatnonzero(positions == position)
        lists = batch.column("part").take(pa.array(rows))
        yield position, rows, pc.list_flatten(lists).to_numpy().reshape(len(rows), -1)


def _assigned(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry = np.zeros(batch.num_rows, np.int32)
            for position, rows, parts in _by_position(batch):
                entry[rows] = _nearest(parts, books[position])[0]
            old = batch.column("entry")
            moved = pc.not_equal(old, pa.array(entry))
            columns = [batch.column("row"), batch.column("position"), pa.array(entry), batch.column("part"), moved]
            yield pa.RecordBatch.from_arrays(columns, ["row", "position", "entry", "part", "moved"])

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (position, entry) of a task: number of parts and the sums of their components, as text."""
    totals: dict[tuple[int, int], list] = {}
    for batch in batches:
        entries = batch.column("entry").to_numpy()
        for position, rows, parts in _by_position(batch):
            small = not parts.size or np.abs(parts).max() < SMALL
            for entry in np.unique(entries[rows]).tolist():
                of = parts[entries[rows] == entry]
                sums = of.astype(np.int64).sum(axis=0).tolist() if small else [sum(map(int, c)) for c in of.T.tolist()]
                count, before = totals.get((position, entry), [0, [0] * len(sums)])
                totals[position, entry] = [count + len(of), [a + b for a, b in zip(before, sums, strict=True)]]
    yield _sum_rows([(p, e, n, ",".join(map(str, s))) for (p, e), (n, s) in totals.items()])


SUMS = "position int, entry int, n long, sums string"


def _sum_rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int64(), pa.string()]
    columns = zip(*rows, strict=True) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["position", "entry", "n", "sums"])


def _total(table: pa.Table) -> pa.Table:
    """The sums of one (position, entry) over all tasks, of which each gives one row."""
    n = sum(table.column("n").to_pylist())
    sums = [sum(c) for c in zip(*(map(int, s.split(",")) for s in table.column("sums").to_pylist()), strict=True)]
    p, e = table.column("position")[0].as_py(), table.column("entry")[0].as_py()
    return pa.Table.from_batches([_sum_rows([(p, e, n, ",".join(map(str, sums)))])])


def _coded(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for position, rows, parts in _by_position(batch):
                entry[rows], distances = _nearest(parts, books[position])
                error[rows] = np.where((distances <= LARGEST).astype(bool), distances, -1).astype(np.int64)
            errors = pa.array(error, mask=error < 0)
            columns = [batch.column("row"), batch.column("position"), pa.array(entry), errors]
            yield pa.RecordBatch.from_arrays(columns, ["row", "position", "entry", "error"])

    return run


# In Spark


def _dealt(parts: DataFrame, rows: int) -> DataFrame:
    """Parts at their owners. An entry has as many salts as its parts would need tasks if it had them all."""
    salts = -(-rows // PARTS_PER_TASK) or 1
    tasks = max(parts.sparkSession.sparkContext.defaultParallelism, -(-rows * PARTS // PARTS_PER_TASK))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))
    return parts.repartition(tasks, "position", "entry", salt)


def _first_entries(vectors: DataFrame, lengths: list[int]) -> Codebooks:
    """The parts of the first kept vectors in order of id, a missing id last, equal ids in order of vector."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(ENTRIES).collect()
    return [[[int(x) for x in r["ints"][a:b]] for r in first] for a, b in zip(lengths, lengths[1:], strict=False)]


def _updated(books: Codebooks, assigned: DataFrame) -> Codebooks:
    """Each used entry becomes the mean of its parts, rounded down."""
    partial = assigned.select("position", "entry", "part").mapInArrow(_summed, SUMS)
    sums = partial.groupBy("position", "entry").applyInArrow(_total, SUMS).collect()  # at most 128 rows
    books = [list(book) for book in books]
    for r in sums:
        books[r["position"]][r["entry"]] = [int(s) // r["n"] for s in r["sums"].split(",")]
    return books


def encode(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the rows of ``vectors`` (vec_id, ``vector``, label).

    Rows whose vector is null, empty, or holds a null or a component that is not finite (also once
    scaled) are left out, and so are those whose vector has another length than the first one by vec_id;
    if the length is not a multiple of 8, the first parts have one component more. ``error`` is the sum
    of the final squared distances and ``label_error`` its sum over the kept rows of equal label, nulls
    together; sums beyond 64 bits are null. Repeated rows and equal ids each count and give a row, a null
    vec_id comes after all others in the choice of the first entries, fewer than 16 rows give fewer
    entries, and an empty table gives an empty result. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    ints = F.transform(vector, _floor)
    kept = vectors.where(usable(vector)).select("vec_id", "label", ints.alias("ints"))
    # Written once: the row numbers that put the parts together again must not change.
    numbered = materialize(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")
    first = numbered.orderBy(F.asc_nulls_last("vec_id"), "ints").limit(1).collect()
    length = len(first[0]["ints"]) if first else PARTS
    known = measure(numbered.where(F.size("ints") == length), "sound_vectors", rows=F.count(F.lit(1)))
    lengths, rows = cuts(length), known.measures["rows"]
    books = _first_entries(known.table, lengths)
    pieces = F.array(*[F.slice("ints", a + 1, b - a) for a, b in zip(lengths, lengths[1:], strict=False)])
    state = known.table.select("row", F.posexplode(pieces).alias("position", "part"))
    state = state.select("row", "position", F.lit(-1).alias("entry"), "part")
    for _ in range(ROUNDS):
        assigned = materialize(state.mapInArrow(_assigned(books), f"{STATE}, moved boolean"), "assigned_parts")
        books = _updated(books, assigned)
        stay = assigned.where("not moved").drop("moved")
        state = stay.unionAll(_dealt(assigned.where("moved").drop("moved"), rows))
    final = state.mapInArrow(_coded(books), "row long, position int, entry int, error long")
    by_row = final.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("position", F.lower(F.lpad(F.hex("entry"), 2, "0")).alias("digits")))).alias("codes"),
        _sum_of_all("error").alias("error"),
    )
    codes = by_row.select(
        "row",
        F.array_join(F.transform("codes", lambda c: c["digits"]), "").alias("code"),
        "error",
    )
    label = F.coalesce(F.col("label").cast("string"), F.lit(""))
    ids = known.table.select("row", "vec_id", label.alias("_label"), F.col("label").isNull().alias("_none"))
    coded = materialize(ids.join(codes, "row"), "vector_codes")
    errors = coded.groupBy("_label", "_none").agg(_sum_of_all("error").alias("label_error"))
    errors = measure_size(errors, "label_errors")
    joined = sized_join(coded, errors, ["_label", "_none"], ["row"])
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sum_of_all(column: str) -> Column:
    """Aggregate: the sum, null if a value is or the sum needs more than 64 bits."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.try_sum(column))


def _floor(x: Column) -> Column:
    """floor(SCALE * x) as a double, which holds it exactly, as a scaling by a power of two changes no digit."""
    scaled = x.cast("double") * SCALE
    # Beyond 2^53 a double has no fraction, and a long, which floor() gives, may be too small for it.
    return F.when(F.abs(scaled) < float(1 << 53), F.floor(scaled).cast("double")).otherwise(scaled)


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
