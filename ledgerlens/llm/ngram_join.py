"""Exact Jaccard join of documents on word n-grams, through count vectors and R-trees.

1. A document's distinct shingles are hashed. Documents with the same set form a class, so copies
   are never compared.
2. Two sets linked at 9/10 share nine tenths of the larger one at least, so in any order that is the same
   for all sets they have one of their first hashes in common, a tenth of each and one more. In how many
   documents each shingle occurs is counted over all of them, and the order is from rare to frequent: each
   of a set's first hashes is a cell in which it meets others, and a passage that many sets contain is a
   cell of those only that hold little else.
3. A set's count vector has the number of its hashes in each of 64 groups or, for large sets, more. Two
   sets share at most the sum of the coordinate minima. Of finer groups only the parities are kept: each that
   differs is an element that one set alone has. A pair that either bound rules out goes before any text is
   fetched.
4. In each cell every member is first compared with the cell's least member only. Once these links
   are verified, cells whose members are all connected are done, however many they are.
5. In the remaining cells, members in different components meet through an R-tree over the count vectors:
   the bound against a node's upper corner holds for all that is below it. Surviving pairs are verified by
   their shingles.

So every link joins its two documents' components, though not every link inside a component is computed
on the way. Where the links themselves are asked for, R-trees over the classes of each component name the
pairs to verify: a large component is dealt into parts, and each two parts meet in a task of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.components import components
from ledgerlens.llm.memory import after_batches, after_group
from ledgerlens.llm.names import with_own_names
from ledgerlens.llm.shipping import ship
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, materialize, measure, measure_size

# Groups of a count vector, four times as many until a group has at most GROUP_HASHES hashes on average.
GROUPS, GROUP_HASHES = 64, 24
PARITIES = 1024
LEAF = 16
# Members of one cell in an R-tree; larger cells are cut into parts, and each two parts meet in a task.
TREE_ROWS = 4096
# Shingles of at least so many documents are frequent; of more than FREQUENT such, those of most documents.
OFTEN, FREQUENT = 16, 1 << 19
# Shingles counted at a time before they are dealt out, and bits that tell most others from the frequent ones.
COUNTED, MAYBE_BITS = 1 << 21, 22
# Members of many cells list so many of them, which spares naming a pair once for each cell it shares.
LISTED = 256
BUCKET_BYTES = 64 << 20
# Classes and their shingles in one part of a component, on average, and the shingles counted at a time.
PART_ROWS, PART_SHINGLES, PART_COLUMNS = 512, 1 << 19, 4096
# Pairs of count vectors of any size, and of those of a tree, held against the bound at a time.
BOUNDED_ROWS, BOUNDED_PAIRS = 256, 1 << 13
# Members of small cells in one task's group, and such cells whose pairs are made at a time.
SMALL_ROWS, SMALL_CELLS = 1 << 14, 1 << 11


class Link(NamedTuple):
    """Sets are linked when ``per * shared >= share * union``; shingles have ``k`` words."""

    k: int
    share: int
    per: int

    def holds(self, shared, a, b):
        return (self.per + self.share) * shared >= self.share * (a + b)

    def meeting(self, sizes: np.ndarray) -> np.ndarray:
        """How many of the first elements of a set, in any order common to all, include one of each other linked set."""
        least = -(-self.share * sizes // self.per)
        # A set too small to be linked with more than its equals needs none: equal sets are one class already.
        return np.where(self.per * sizes >= self.share * (sizes + 1), sizes - least + 1, 0)


def _sets(batch: pa.RecordBatch, link: Link) -> tuple[W.Rows, np.ndarray, np.ndarray]:
    """The distinct shingles of each row and two 64-bit digests of the set."""
    sets = W.distinct(W.shingles(W.words(batch.column("text")), link.k))
    first = W.mix(W.sums(sets, W.mix(sets.values)) + sets.counts.astype(np.uint64))
    second = W.mix(W.sums(sets, W.mix(sets.values ^ np.uint64(0x5851F42D4C957F2D))))
    return sets, first, second


def _node(first: np.ndarray, second: np.ndarray) -> pa.Array:
    both = np.stack([first, second], axis=1).tobytes()
    return pa.array([both[i : i + 16] for i in range(0, len(both), 16)], pa.binary())


def _digests(link: Link):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets, first, second = _sets(part, link)
                columns = [part.column(c) for c in ("doc_id", "text_hash")]
                columns += [pa.array(sets.counts), pa.array(first.view(np.int64)), _node(first, second)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_shingles", "digest", "node"])

    return after_batches(run)


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash by its high half; it rises with the hash."""
    return ((values >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def _occurrences(link: Link, buckets: int):
    """Distinct shingles of the documents by bucket, as packed low halves: those met once, others with their number."""

    def counted(held: list[np.ndarray]) -> pa.RecordBatch:
        values, times = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(_bucket(values, buckets), np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            low, n = values[edges[b] : edges[b + 1]].astype(np.uint32), times[edges[b] : edges[b + 1]]
            rows.append({"bucket": b, "once": low[n == 1].tobytes(), "more": low[n > 1].tobytes(), "times": n[n > 1].astype(np.uint32).tobytes()})
        return pa.RecordBatch.from_pylist(rows, _OCCURRENCES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in W.chunks(batch, "text"):
                held.append(W.distinct(W.shingles(W.words(part.column("text")), link.k)).values)
                n += len(held[-1])
                if n >= COUNTED:
                    yield counted(held)
                    held, n = [], 0
        if n:
            yield counted(held)

    return after_batches(run)


_OCCURRENCES = pa.schema([("bucket", pa.int64())] + [(n, pa.binary()) for n in ("once", "more", "times")])


def _often(key: tuple, table: pa.Table) -> pa.Table:
    """The shingles of one bucket that many documents have, as bucket and low half in one number."""
    once, more, times = (np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table.column(c)]) for c in _OCCURRENCES.names[1:])
    low = np.sort(np.concatenate([once, more]))
    first = np.flatnonzero(np.append(True, low[1:] != low[:-1]))
    n, low = np.diff(np.append(first, len(low))), low[first]
    n = n + np.bincount(np.searchsorted(low, more), weights=times.astype(np.int64) - 1, minlength=len(low)).astype(np.int64)
    code = (key[0].as_py() << 32) + low[n >= OFTEN].astype(np.int64)
    return pa.table({"code": pa.array(code), "n": pa.array(n[n >= OFTEN])})


class Frequent(NamedTuple):
    """Frequent shingles by bucket and low half, in order, and a level of each that rises with its documents.

    Two shingles of one bucket and low half pass for one here; the order of sets' elements stays the same for all sets.
    """

    buckets: int
    codes: np.ndarray
    levels: np.ndarray

    def maybe(self) -> np.ndarray:
        """By the last bits of a hash, whether a frequent one has them."""
        flags = np.zeros(1 << MAYBE_BITS, bool)
        flags[self.codes & ((1 << MAYBE_BITS) - 1)] = True
        return flags

    def of(self, values: np.ndarray, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the frequent ones among some hashes are, and their levels."""
        at = np.flatnonzero(maybe[(values & np.uint64((1 << MAYBE_BITS) - 1)).astype(np.int64)])
        code = (_bucket(values[at], self.buckets) << np.uint64(32) | values[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place = np.searchsorted(self.codes, code)
        hit = place < len(self.codes)
        hit[hit] = self.codes[place[hit]] == code[hit]
        return at[hit], self.levels[place[hit]]


def _frequent(docs: DataFrame, link: Link, buckets: int) -> Frequent:
    """Counted over all documents; a level has the shingles of about as many documents, up to a fifth more."""
    schema = "bucket long, once binary, more binary, times binary"
    counted = docs.select("text").mapInArrow(_occurrences(link, buckets), schema).groupBy("bucket")
    often = counted.applyInArrow(after_group(_often), "code long, n long")
    often = materialize(often.select("code", F.floor(F.log2("n") * 4).cast("int").alias("level")), "frequent_shingles")
    level, total = 0, 0
    for row in sorted(often.groupBy("level").count().collect(), reverse=True):
        level, total = row["level"], total + row["count"]
        if total > FREQUENT:
            level += 1
            break
    found = often.where(F.col("level") >= level).toArrow()
    codes, levels = found.column("code").to_numpy(), found.column("level").to_numpy()
    order = np.argsort(codes)
    return Frequent(buckets, codes[order], levels[order])


def _cells_of(sets: W.Rows, ids: np.ndarray, link: Link, frequent: Frequent, maybe: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, id) of each set, for its first elements by level and hash.

    Cells are numbers of 48 bits."""
    row = np.repeat(np.arange(len(sets.counts)), sets.counts)
    at, levels = frequent.of(sets.values, maybe)
    rare = np.ones(len(row), bool)
    rare[at] = False
    # A set is sorted by hash: its rare elements come first, then the others by level.
    before = np.concatenate([[0], np.cumsum(rare)])
    place = before[:-1] - before[sets.offsets[row]]
    at = at[np.lexsort((levels, row[at]))]
    place[at] = before[sets.offsets[row[at] + 1]] - sets.offsets[row[at]] + np.arange(len(at))
    made = place < link.meeting(sets.counts)[row]
    return (W.mix(sets.values[made]) >> np.uint64(16)).astype(np.int64), ids[row[made]]


def _buckets_of(rows: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """The rows of each bucket, given the bucket of each row."""
    order = np.argsort(rows, kind="stable")
    edges = np.searchsorted(rows[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        yield b, order[edges[b] : edges[b + 1]]


def _cells(link: Link, buckets: int, frequent: Broadcast):
    """Cells by bucket, as packed arrays: the members' digests, and for each cell its 48 bits and the member.

    Of the many members that a large group has in one cell, each batch hands on the least only. The
    others are given with it as ``stars`` (cell, member, least), dealt out evenly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = frequent.value.maybe()
        for whole in batches:
            for start in range(0, whole.num_rows, 60_000):  # so that 16 bits tell the members apart
                batch = whole.slice(start, 60_000)
                digests = [_sets(p, link)[:2] for p in W.chunks(batch, "text")]
                names, which = np.unique(np.concatenate([d.view(np.int64) for _, d in digests]), return_inverse=True)
                found, at = [], 0
                for sets, _ in digests:
                    found.append(_cells_of(sets, which[at : at + len(sets.counts)], link, frequent.value, maybe))
                    at += len(sets.counts)
                cell, member = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((member, cell))
                cell, member = cell[order], member[order]
                first = np.ones(len(cell), bool)
                first[1:] = cell[1:] != cell[:-1]
                other = ~first
                other[1:] &= member[1:] != member[:-1]
                least = np.repeat(member[first], np.diff(np.append(np.flatnonzero(first), len(cell))))
                stars = np.stack([cell[other], names[member[other]], names[least[other]]], axis=1)
                far = W.mix(stars[:, 0].view(np.uint64) ^ W.mix(stars[:, 1].view(np.uint64))) % np.uint64(buckets)
                rows = {b: {"stars": stars[at].tobytes()} for b, at in _buckets_of(far.astype(np.int64), buckets)}
                cell, member = cell[first], member[first]
                for b, at in _buckets_of(cell % buckets, buckets):
                    used, place = np.unique(member[at], return_inverse=True)
                    rows.setdefault(b, {}).update(
                        digests=names[used].tobytes(),
                        members=place.astype(np.uint16).tobytes(),
                        high=(cell[at] >> 16).astype(np.uint32).tobytes(),
                        low=(cell[at] & 0xFFFF).astype(np.uint16).tobytes(),
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist([{"bucket": b, **row} for b, row in rows.items()], _CELLS)

    return after_batches(run)


_CELLS = pa.schema([("bucket", pa.int64())] + [(n, pa.binary()) for n in ("digests", "members", "high", "low", "stars")])


def _meet(_: tuple, table: pa.Table) -> pa.Table:
    """All members of the cells of one bucket but the least, each with the least."""

    def arrays(name: str, kind: type) -> list[np.ndarray]:
        return [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in table.column(name)]

    member = np.concatenate([d[m] for d, m in zip(arrays("digests", np.int64), arrays("members", np.uint16), strict=True)])
    cell = (np.concatenate(arrays("high", np.uint32)).astype(np.int64) << 16) + np.concatenate(arrays("low", np.uint16))
    order = np.lexsort((member, cell))
    cell, member = cell[order], member[order]
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    least = np.repeat(member[first], np.diff(np.append(np.flatnonzero(first), len(cell))))
    other = member != least
    known = np.concatenate(arrays("stars", np.int64)).reshape(-1, 3)
    rows = np.concatenate([np.stack([cell[other], member[other], least[other]], axis=1), known])
    return pa.table({n: pa.array(rows[:, i]) for i, n in enumerate(("cell", "member", "pivot"))})


def groups_of(sizes: np.ndarray) -> np.ndarray:
    """The number of groups of a set by its size."""
    over = np.maximum(np.asarray(sizes), 1) / (GROUPS * GROUP_HASHES)
    return GROUPS << 2 * np.clip(np.ceil(np.log2(over) / 2), 0, 12).astype(np.int64)


def count_vectors(sets: W.Rows, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each set the number of its elements in each of its ``groups``, one set after the other, and where each begins."""
    offsets = np.concatenate([[0], np.cumsum(groups)])
    of = np.repeat(np.arange(len(groups)), sets.counts)
    group = (sets.values & (groups[of] - 1).astype(np.uint64)).astype(np.int64)
    return np.bincount(offsets[of] + group, minlength=offsets[-1]), offsets


def parities(sets: W.Rows) -> np.ndarray:
    """Of each set whether the number of its elements in each of ``PARITIES`` groups is odd, as packed bits."""
    row = np.repeat(np.arange(len(sets.counts)), sets.counts)
    group, words = W.mix(sets.values) & np.uint64(PARITIES - 1), np.zeros((len(sets.counts), PARITIES // 64), np.uint64)
    np.bitwise_xor.at(words, (row, group >> np.uint64(6)), np.uint64(1) << (group & np.uint64(63)))
    return words


def _bits(packed: pa.Array) -> np.ndarray:
    """Rows of packed bits as whole words."""
    return np.frombuffer(b"".join(packed.to_pylist()), np.uint64).reshape(len(packed), PARITIES // 64)


def _few_differ(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, others: np.ndarray, link: Link) -> np.ndarray:
    """Which pairs of sets the parities of their groups allow to be linked."""
    differ = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
    return link.holds((sizes + others - differ) // 2, sizes, others)


def folded(vectors: np.ndarray, groups: int) -> np.ndarray:
    """Rows of counts in fewer groups: both numbers are powers of two, and a group goes by the last bits of a hash."""
    return vectors.reshape(len(vectors), -1, groups).sum(axis=1)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Count vectors as rows, all with the groups of the coarsest of them."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    groups = int(lengths.min())
    rows = np.zeros((len(lengths), groups), np.int64)
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        flat = pc.list_flatten(lists.take(pa.array(at))).to_numpy(zero_copy_only=False)
        rows[at] = folded(flat.reshape(len(at), length).astype(np.int64), groups)
    return rows


def _vectors(link: Link):
    """Count vectors of the documents that stand for their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets, first, second = _sets(part, link)
                counts, offsets = count_vectors(sets, groups_of(sets.counts))
                vectors = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(counts.astype(np.int32)))
                odd = pa.array([row.tobytes() for row in parities(sets)], pa.binary())
                yield pa.RecordBatch.from_arrays([_node(first, second), pa.array(sets.counts), vectors, odd], ["node", "n", "vector", "odd"])

    return after_batches(run)


def _texts(link: Link):
    """Texts of the documents that stand for their class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                sets, first, second = _sets(part, link)
                columns = [_node(first, second), pa.array(sets.counts), part.column("text")]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n", "text"])

    return after_batches(run)


def _bounded(link: Link):
    """Of rows (a, b, and of both n, vector, odd) the (a, b) that the summed minima of their counts and the parities allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("n_a", "n_b")]
            groups = np.minimum(*[pc.list_value_length(batch.column(c)).to_numpy() for c in ("vector_a", "vector_b")])
            keep = np.zeros(batch.num_rows, bool)
            for g in np.unique(groups).tolist():
                rows = np.flatnonzero(groups == g)
                for start in range(0, len(rows), BOUNDED_ROWS):
                    at = rows[start : start + BOUNDED_ROWS]
                    a, b = (_matrix(batch.column(c).take(pa.array(at))) for c in ("vector_a", "vector_b"))
                    shared = np.minimum(folded(a, g), folded(b, g)).sum(axis=1)
                    keep[at] = link.holds(np.minimum(shared, np.minimum(sizes[0][at], sizes[1][at])), sizes[0][at], sizes[1][at])
                    odd = (_bits(batch.column(c).take(pa.array(at))) for c in ("odd_a", "odd_b"))
                    keep[at] &= _few_differ(*odd, sizes[0][at], sizes[1][at], link)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return after_batches(run)


def _verify(link: Link):
    """Of rows (a, b, text_a, text_b) the (a, b) that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for part in W.chunks(batch, "text_b"):
                left, right = (W.distinct(W.shingles(W.words(part.column(c)), link.k)) for c in ("text_a", "text_b"))
                for i in range(part.num_rows):
                    x, y = left.row(i), right.row(i)
                    shared = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                    kept.append(bool(link.holds(shared, len(x), len(y))))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return after_batches(run)


class RTree:
    """Points of group counts, packed by recursive halving along the widest coordinate."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.points, self.sizes = points, sizes
        self.order = self._packed(np.arange(len(points)))
        upper, least = points[self.order], sizes[self.order]
        self.levels = []
        while True:
            edges = np.arange(0, len(upper), LEAF)
            upper, least = np.maximum.reduceat(upper, edges), np.minimum.reduceat(least, edges)
            self.levels.append((upper, least))
            if len(upper) == 1:
                break

    def _packed(self, rows: np.ndarray) -> np.ndarray:
        if len(rows) <= LEAF:
            return rows
        points = self.points[rows]
        axis = int(np.argmax(points.max(axis=0) - points.min(axis=0)))
        half = LEAF * (len(rows) // LEAF // 2 or 1)
        rows = rows[np.argsort(points[:, axis], kind="stable")]
        return np.concatenate([self._packed(rows[:half]), self._packed(rows[half:])])

    def search(self, probes: np.ndarray, sizes: np.ndarray, link: Link) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(probe, point) pairs whose summed minima allow a link, for some probes at a time."""
        for start in range(0, len(probes), 256):
            probe = np.arange(start, min(start + 256, len(probes)))
            at = np.zeros(len(probe), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                upper, least = self.levels[depth]
                probe, at = self._bounded(probe, at, upper, least, probes, sizes, link)
                below = self.levels[depth - 1][1] if depth else self.order
                probe, at = np.repeat(probe, LEAF), (at[:, None] * LEAF + np.arange(LEAF)).ravel()
                probe, at = probe[at < len(below)], at[at < len(below)]
            probe, at = self._bounded(probe, self.order[at], self.points, self.sizes, probes, sizes, link)
            yield probe, at

    @staticmethod
    def _bounded(probe, at, upper, least, probes, sizes, link):
        keep = np.zeros(len(probe), bool)
        for i in range(0, len(probe), BOUNDED_PAIRS):
            p, t = probe[i : i + BOUNDED_PAIRS], at[i : i + BOUNDED_PAIRS]
            shared = np.minimum(probes[p], upper[t]).sum(axis=1)
            keep[i : i + BOUNDED_PAIRS] = link.holds(np.minimum(shared, sizes[p]), sizes[p], least[t])
        return probe[keep], at[keep]


def _small_pairs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within each of many short runs of rows."""
    n = sizes * sizes
    run = np.repeat(np.arange(len(sizes)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = place // sizes[run], place % sizes[run]
    return (starts[run] + i)[i < j], (starts[run] + j)[i < j]


def _first_met(a: np.ndarray, b: np.ndarray, here: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Which pairs of lists, each in order, have no number in common that is less than ``here``."""
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
    values, rank = np.unique(pc.list_flatten(lists).to_numpy(zero_copy_only=False), return_inverse=True)
    # The lists one after the other, and in each the numbers, are in order as they are.
    keys = np.repeat(np.arange(len(lists)), np.diff(ends)) * len(values) + rank
    limit = np.searchsorted(values, here)
    keep, left, step = np.ones(len(a), bool), np.arange(len(a)), 0
    while True:
        at = ends[a[left]] + step
        more = at < ends[a[left] + 1]
        more[more] = rank[at[more]] < limit[left[more]]
        left, at = left[more], at[more]
        if not len(left):
            return keep
        wanted = b[left] * len(values) + rank[at]
        met = keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted
        keep[left[met]] = False
        left, step = left[~met], step + 1


def _tree_join(link: Link):
    """Of many cells, or of two parts of a large one, the pairs of different components that the bound allows.

    Up to ``LEAF`` members are no more than a leaf of a tree: their pairs are held against the bound at once.
    """

    def run(_: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("cell")
        sizes, node = table.column("n").to_numpy(), np.array(table.column("node").to_pylist(), object)
        component = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)[1]
        low, high, home = (table.column(c).to_numpy() for c in ("low", "high", "home"))
        vector, listed = (table.column(c).combine_chunks() for c in ("vector", "cells"))
        cell = table.column("cell").to_numpy()
        starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        counts = np.diff(np.append(starts, len(cell)))
        groups = np.minimum.reduceat(pc.list_value_length(vector).to_numpy(zero_copy_only=False), starts)
        odd, found = _bits(table.column("odd")), []

        def keep(a: np.ndarray, b: np.ndarray) -> None:
            for i in range(0, len(a), BOUNDED_PAIRS):
                p, t = a[i : i + BOUNDED_PAIRS], b[i : i + BOUNDED_PAIRS]
                near = _few_differ(odd[p], odd[t], sizes[p], sizes[t], link)
                found.append((p[near], t[near]))

        def search(some: np.ndarray) -> None:
            """Cells of which the coarsest vectors have the same number of groups."""
            rows = np.concatenate([np.arange(starts[k], starts[k] + counts[k]) for k in some.tolist()])
            vectors, own, part = _matrix(vector.take(pa.array(rows))), sizes[rows], component[rows]
            first = np.cumsum(counts[some]) - counts[some]
            few = (counts[some] <= LEAF) & (low[starts[some]] == high[starts[some]])
            if few.any():
                p, t = _small_pairs(first[few], counts[some][few])
                p, t = p[part[p] != part[t]], t[part[p] != part[t]]
                p, t = RTree._bounded(p, t, vectors, own, vectors, own, link)
                keep(rows[p], rows[t])
            for k in np.flatnonzero(~few).tolist():
                here = np.arange(first[k], first[k] + counts[some[k]])
                at = rows[here]
                probes, inside = here[home[at] == low[at]], here[home[at] == high[at]]
                if not (len(probes) and len(inside)):
                    continue
                for p, t in RTree(vectors[inside], own[inside]).search(vectors[probes], own[probes], link):
                    p, t = probes[p], inside[t]
                    keep(rows[p[part[p] != part[t]]], rows[t[part[p] != part[t]]])

        for g in np.unique(groups).tolist():
            alike = np.flatnonzero(groups == g)
            for start in range(0, len(alike), SMALL_CELLS):
                search(alike[start : start + SMALL_CELLS])
        sides = ([], [])
        if found:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            # Named in the first cell that both list; if they list none in common, wherever they meet.
            own, place, which = np.unique(node, return_index=True, return_inverse=True)
            named = _first_met(which[a], which[b], cell[a], listed.take(pa.array(place)))
            ends = np.unique(np.sort(np.stack([which[a[named]], which[b[named]]]), axis=0), axis=1)
            sides = [own[side].tolist() for side in ends]
        return pa.table([pa.array(list(e), pa.binary()) for e in sides], ["a", "b"])

    return after_group(run)


def _linked(pairs: DataFrame, texts: DataFrame, link: Link) -> DataFrame:
    def side(c: str) -> DataFrame:
        return texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify(link), "a binary, b binary")


def links(docs: DataFrame, sets: DataFrame, link: Link) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """Verified links (a, b) between classes, enough to connect whatever is connected, and what gives the texts of all linked classes."""
    spark = docs.sparkSession
    words, rows = sets.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count(F.lit(1))).first()
    # A bucket's share of the shingles, and later of the cells, stays within memory.
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = spark.sparkContext.broadcast(_frequent(docs, link, max(least, words * 32 // BUCKET_BYTES)))
    buckets = max(least, (words * (link.per - link.share) // link.per + rows) * 32 // BUCKET_BYTES)
    schema = "bucket long, " + ", ".join(f"{n} binary" for n in _CELLS.names[1:])
    cells = docs.select("text").mapInArrow(_cells(link, buckets, frequent), schema)
    stars = materialize(cells.groupBy("bucket").applyInArrow(after_group(_meet), "cell long, member long, pivot long"), "cell_members")
    classes = sets.where("n_shingles > 0").groupBy("digest", "node").agg(F.min("doc_id").alias("doc_id"))
    ends = stars.select(F.explode(F.array("member", "pivot")).alias("digest")).distinct()
    chosen = measure_size(classes.join(ends, "digest", "left_semi"), "candidates")

    def bodies(of: Measured) -> DataFrame:
        """The texts of documents that stand for some classes."""
        wanted = of._replace(table=of.table.select("doc_id").distinct())
        return sized_join(docs.select("doc_id", "text"), wanted, ["doc_id"], ["doc_id", "text"], "left_semi").select("text")

    held = bodies(chosen).mapInArrow(_vectors(link), "node binary, n long, vector array<int>, odd binary")
    vectors = materialize(held.dropDuplicates(["node"]), "candidate_vectors")

    names = chosen.table.select("digest", "node")
    edges = (
        stars.select("member", "pivot").distinct()
        .join(names.toDF("member", "a"), "member").join(names.toDF("pivot", "b"), "pivot").select("a", "b")
    )
    # Different sets of one digest share its cells without a star between them.
    twins = names.toDF("digest", "a").join(names.toDF("digest", "b"), "digest").where("a < b").select("a", "b")
    edges = materialize(edges.unionAll(twins), "candidate_edges")
    schema = "a binary, b binary"
    sides = [vectors.select(F.col("node").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("n", "vector", "odd")]) for c in "ab"]

    def allowed(some: DataFrame, name: str) -> DataFrame:
        """Of some pairs those that the count vectors allow."""
        both = some.join(sides[0], "a").join(sides[1], "b")
        return materialize(both.mapInArrow(_bounded(link), schema), name)

    def texts_of(ends: DataFrame, name: str) -> DataFrame:
        """Texts of the classes at either end of the pairs (a, b)."""
        nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        stand = measure_size(chosen.table.join(nodes, "node", "left_semi"), "ends")
        found = bodies(stand).mapInArrow(_texts(link), "node binary, n long, text string")
        return materialize(found.dropDuplicates(["node"]), name)

    # A member's least pivot connects most of what is connected; the others follow where it did not.
    first = allowed(edges.groupBy("a").agg(F.min("b").alias("b")), "first_edges")
    one = materialize(_linked(first, texts_of(first, "first_texts"), link), "links")
    parts = components(one)
    known = names.select("node").join(parts, "node", "left").select("node", F.coalesce("component", "node").alias("c"))
    known = materialize(known, "first_components")
    apart = edges.join(known.toDF("a", "ca"), "a").join(known.toDF("b", "cb"), "b").where("ca <> cb").select("a", "b")
    apart = allowed(apart, "apart_edges")
    more = materialize(_linked(apart, texts_of(apart, "apart_texts"), link), "more_links")
    found = spark.createDataFrame([], schema).unionAll(one).unionAll(more)
    parts = components(found)

    def texts() -> DataFrame:
        return texts_of(found, "linked_texts")

    # Cells in which a member is still apart from the cell's least member.
    label = names.join(parts, "node", "left").select("digest", "node", F.coalesce("component", "node").alias("component"))
    label = materialize(label, "candidate_components")
    member = label.toDF("member", "_m", "_mc")
    least = label.toDF("pivot", "_p", "_pc")
    open_cells = stars.join(member, "member").join(least, "pivot").where("_mc <> _pc").select("cell").distinct()
    rest = stars.join(open_cells, "cell", "left_semi")
    members = rest.select("cell", F.explode(F.array("member", "pivot")).alias("digest")).distinct()
    left = measure(members.join(label, "digest").select("cell", "node", "component"), "open_cells", rows=F.count(F.lit(1)))
    if left.measures["rows"] == 0:
        return found, texts
    # Of two members the lesser is the cell's least, with which the other was compared.
    sizes = left.table.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).where("m > 2")
    parts = sizes.select("cell", F.ceil(F.col("m") / TREE_ROWS).cast("int").alias("parts"))
    crowded = measure(left.table.join(parts, "cell"), "crowded_cells", rows=F.count(F.lit(1)))
    if crowded.measures["rows"] == 0:
        return found, texts
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), crowded.measures["rows"] // SMALL_ROWS)
    own_group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("cell"), F.lit(buckets))).otherwise(F.xxhash64("cell"))
    listed = crowded.table.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("cell")), 1, LISTED).alias("cells"))
    points = (
        crowded.table.join(listed, "node")
        .join(vectors, "node")
        .withColumn("home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"low": F.least("home", "other"), "high": F.greatest("home", "other"), "group": own_group})
    )
    pairs = points.drop("parts", "other").groupBy("group", "low", "high").applyInArrow(_tree_join(link), schema).distinct()
    pairs = materialize(pairs, "tree_pairs")
    second = materialize(_linked(pairs, texts_of(pairs, "tree_texts"), link), "tree_links")
    return found.unionAll(second), lambda: texts_of(found.unionAll(second), "linked_texts")


def _shared(sets: W.Rows, rows: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each of ``left`` shares with each of ``right``; both are places in ``rows``."""
    counts = sets.counts[rows]
    member = np.repeat(np.arange(len(rows)), counts)
    _, column, often = np.unique(np.concatenate([sets.row(r) for r in rows.tolist()]), return_inverse=True, return_counts=True)
    # What only one set has is shared by none.
    renamed = np.cumsum(often > 1) - 1
    member, column = member[often[column] > 1], renamed[column[often[column] > 1]]
    order = np.argsort(column, kind="stable")
    member, column = member[order], column[order]
    shared = np.zeros((len(left), len(right)), np.int64)
    for start in range(0, int(renamed[-1]) + 1, PART_COLUMNS):
        some = slice(*np.searchsorted(column, [start, start + PART_COLUMNS]))
        has = np.zeros((len(rows), min(PART_COLUMNS, int(renamed[-1]) + 1 - start)), np.float32)
        has[member[some], column[some] - start] = 1
        shared += (has[left] @ has[right].T).astype(np.int64)
    return shared


def _allowed(sets: W.Rows, rows: np.ndarray, left: np.ndarray, right: np.ndarray, link: Link) -> np.ndarray:
    """Which of ``left`` and ``right`` an R-tree over the count vectors leaves as pairs."""
    counts = sets.counts[rows]
    own = W.Rows(np.concatenate([sets.row(r) for r in rows.tolist()]), np.concatenate([[0], np.cumsum(counts)]))
    groups = int(groups_of(counts.min()))
    vectors = count_vectors(own, np.full(len(rows), groups))[0].reshape(len(rows), groups)
    maybe = np.zeros((len(left), len(right)), bool)
    for p, t in RTree(vectors[right], counts[right]).search(vectors[left], counts[left], link):
        maybe[p, t] = True
    return maybe


_PAIRS = "a binary, b binary, n_shared long, n_a long, n_b long"
_COUNTS = "node binary, n long"


def _part_links(link: Link, as_pairs: bool):
    """All links between the classes of two parts of a component, or how many documents they give each class."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        parts = [W.distinct(W.shingles(W.words(p.column("text")), link.k)) for b in table.to_batches() for p in W.chunks(b, "text")]
        counts = np.concatenate([p.counts for p in parts])
        sets = W.Rows(np.concatenate([p.values for p in parts]), np.concatenate([[0], np.cumsum(counts)]))
        node, component = (np.array(table.column(c).to_pylist(), object) for c in ("node", "component"))
        low, high, home, rows_of = (table.column(c).to_numpy() for c in ("low", "high", "home", "rows"))
        _, which = np.unique(component, return_inverse=True)
        pairs, sums = [], []
        for _, rows in _buckets_of(which, int(which.max()) + 1):
            left, right = np.flatnonzero(home[rows] == low[rows]), np.flatnonzero(home[rows] == high[rows])
            if not (len(left) and len(right)):
                continue
            maybe = _allowed(sets, rows, left, right, link)
            left, right = left[maybe.any(axis=1)], right[maybe.any(axis=0)]
            maybe = maybe[maybe.any(axis=1)][:, maybe.any(axis=0)]
            if not len(left):
                continue
            a, b = rows[left], rows[right]
            shared = _shared(sets, rows[np.union1d(left, right)], *(np.searchsorted(np.union1d(left, right), x) for x in (left, right)))
            linked = maybe & link.holds(shared, counts[a][:, None], counts[b][None])
            if low[rows[0]] == high[rows[0]]:
                linked &= left[:, None] < right[None]
            if as_pairs:
                i, j = np.nonzero(linked)
                pairs.append((node[a[i]], node[b[j]], shared[i, j], counts[a[i]], counts[b[j]]))
            else:
                sums.append((node[a], linked @ rows_of[b]))
                sums.append((node[b], rows_of[a] @ linked))
        if as_pairs:
            found = [np.concatenate(c) for c in zip(*pairs, strict=True)] if pairs else [np.zeros(0, np.int64)] * 5
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            return pa.table([pa.array(c.tolist(), t) for c, t in zip(found, kinds, strict=True)], ["a", "b", "n_shared", "n_a", "n_b"])
        found = [np.concatenate(c) for c in zip(*sums, strict=True)] if sums else [np.zeros(0, np.int64)] * 2
        return pa.table([pa.array(c.tolist(), t) for c, t in zip(found, (pa.binary(), pa.int64()), strict=True)], ["node", "n"])

    return after_group(run)


def _every_link(classes: DataFrame, texts: DataFrame, link: Link, as_pairs: bool) -> DataFrame:
    """All links between classes as ``_PAIRS``, or as ``_COUNTS``; a link never leaves its component."""
    spark = classes.sparkSession
    members = classes.join(texts, "node").select("component", "node", "rows", "n", "text")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("shingles")).where("m > 1")
    parts = F.greatest(F.ceil(F.col("m") / PART_ROWS), F.ceil(F.col("shingles") / PART_SHINGLES)).cast("int")
    dealt = measure_size(sizes.select("component", parts.alias("parts"), "shingles"), "component_parts")
    small = dealt.table.where("parts = 1").agg(F.sum("shingles")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-small // PART_SHINGLES))
    # Components of one part share groups, those of several have a group for each two parts.
    group = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("component"), F.lit(buckets))).otherwise(F.xxhash64("component"))
    placed = (
        sized_join(members, dealt._replace(table=dealt.table.drop("shingles")), ["component"], ["node"], "inner")
        .withColumn("home", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("group", group)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumns({"low": F.least("home", "other"), "high": F.greatest("home", "other")})
    )
    placed = placed.select("group", "low", "high", "home", "component", "node", "rows", "text")
    schema = _PAIRS if as_pairs else _COUNTS
    return placed.groupBy("group", "low", "high").applyInArrow(_part_links(link, as_pairs), schema)


def _classes(docs: DataFrame, link: Link) -> tuple[DataFrame, DataFrame, Callable[[], DataFrame]]:
    """Rows doc_id, text_hash, n_shingles, node (the class); of each class with ids node, component, least id
    and number of rows; and what gives the texts of all linked classes."""
    schema = "doc_id long, text_hash long, n_shingles long, digest long, node binary"
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    sets = materialize(hashed.mapInArrow(_digests(link), schema), "shingle_sets")
    found, texts = links(docs.where("doc_id is not null"), sets.where("doc_id is not null"), link)
    parts = components(found)
    classes = sets.where("n_shingles > 0 and doc_id is not null").groupBy("node")
    classes = classes.agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    grouped = classes.join(parts, "node", "left").select("node", "least", "rows", F.coalesce("component", "node").alias("component"))
    return sets, materialize(grouped, "classes"), texts


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def join(docs: DataFrame, k: int = 3, share: int = 90, per: int = 100, n_links: bool = False) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, and on demand n_links.

    ``component_id`` is the smallest doc_id that links of at least ``share / per`` reach. A text
    without words, or null, has no shingles, links with nothing and is its own component, and so is
    a row with a null doc_id (its component is null). Rows may repeat a doc_id; each row has the
    component of its own text. Only the columns doc_id and text are read. Empty tables give no rows.
    ``n_links`` is the number of other rows with an id that the row is linked to itself, copies included.
    """
    ship(docs.sparkSession)
    link = Link(k, share, per)
    sets, classes, texts = _classes(_narrow(docs), link)
    smallest = classes.groupBy("component").agg(F.min("least").alias("_smallest"))
    named = classes.join(smallest, "component")
    if n_links:
        others = _every_link(classes, texts(), link, as_pairs=False).groupBy("node").agg(F.sum("n").alias("_others"))
        named = named.join(others, "node", "left")
        named = named.withColumn("_links", F.col("rows") - 1 + F.coalesce("_others", F.lit(0)))
    extra = ["_links"] if n_links else []
    by_class = measure_size(named.select("node", "_smallest", *extra), "class_components")
    joined = sized_join(sets, by_class, ["node"], ["doc_id"], "left")
    own = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(own, F.col("doc_id")).otherwise(F.col("_smallest")).alias("component_id"),
        *[F.when(own, F.lit(0)).otherwise(F.col(c)).cast("bigint").alias("n_links") for c in extra],
    )


def pairs(docs: DataFrame, k: int = 3, share: int = 90, per: int = 100) -> DataFrame:
    """Every link between documents: a, b (a < b, each pair of ids once), similarity.

    Copies are linked too, with similarity 1. The rows grow with the square of a group of near copies, as the
    links do; ``join`` counts them without naming them. Rows without words or with a null id have no links.
    """
    ship(docs.sparkSession)
    link = Link(k, share, per)
    sets, classes, texts = _classes(_narrow(docs), link)
    between = _every_link(classes, texts(), link, as_pairs=True)
    similarity = F.col("n_shared") / (F.col("n_a") + F.col("n_b") - F.col("n_shared"))
    between = between.select(F.col("a").alias("_a"), F.col("b").alias("_b"), similarity.alias("similarity"))
    copies = classes.where("rows > 1").select(F.col("node").alias("_a"), F.col("node").alias("_b"), F.lit(1.0).alias("similarity"))
    ids = materialize(sets.where("n_shingles > 0 and doc_id is not null").select("node", "doc_id").distinct(), "class_members")
    named = between.unionAll(copies).join(ids.toDF("_a", "_x"), "_a").join(ids.toDF("_b", "_y"), "_b").where("_x <> _y")
    ends = F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b")
    return named.select(*ends, "similarity").groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def keep_one(docs: DataFrame, k: int = 5, share: int = 80, per: int = 100) -> DataFrame:
    """The rows of ``docs``, all columns as they are, without those linked to a kept one.

    Of each component the row with the smallest doc_id stays (of several texts under this id, the one
    whose hash is least; of rows that repeat id and text, any one). Texts without words and rows with a null
    id have no links and stay. The ids to leave out are joined by their measured size.
    """
    return with_own_names(docs, lambda own: _one_of_each(own, k, share, per))


def _one_of_each(docs: DataFrame, k: int, share: int, per: int) -> DataFrame:
    ship(docs.sparkSession)
    sets, classes, _ = _classes(_narrow(docs), Link(k, share, per))
    linked = sets.where("n_shingles > 0 and doc_id is not null").select("doc_id", "text_hash", "node")
    rows = sized_join(linked, measure_size(classes.select("node", "component"), "components_by_class"), ["node"], ["doc_id"], "inner")
    rows = materialize(rows.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")), "members")
    first = rows.groupBy("component").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    judged = rows.join(first, "component").withColumn("stays", F.struct("doc_id", "text_hash") == F.col("first"))
    judged = materialize(judged, "judged_members")
    named = docs.withColumns({"_id": F.col("doc_id").cast("bigint"), "_hash": F.xxhash64(F.col("text").cast("string"))})
    keys = F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")
    gone = measure_size(judged.where("not stays").select(*keys), "left_out")
    kept = sized_join(named, gone, ["_id", "_hash"], ["_id", "_hash"], "left_anti")
    repeated = measure_size(judged.where("stays and n > 1").select(*keys), "repeated_rows")
    if repeated.measures["bytes"]:
        once = sized_join(kept, repeated, ["_id", "_hash"], ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
        kept = sized_join(kept, repeated, ["_id", "_hash"], ["_id", "_hash"], "left_anti").unionByName(once)
    return kept.drop("_id", "_hash")
