"""Benchmark decontamination by SimHash over windows as long as the benchmark items.

A window of a document and an item are compared by the weighted Jaccard similarity of their 5-word
shingles: the sum of the lesser counts over the sum of the larger ones. A window that holds none of an
item's shingles has similarity 0, so only windows around shared shingles are fingerprinted. The
fingerprint has 128 bits. Two of them within RADIUS agree up to one bit in one of their 16 blocks of
8 bits, so a table per block, which lists the items within one bit of each value, gives all items
within the radius. The exact similarity decides about these.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.shipping import ship

K = 5
BITS, BLOCKS, RADIUS = 128, 16, 31
# The benchmark is broadcast in parts of about this many bytes, each held against all documents.
PART_BYTES = 4 << 20
_PREFILTER_BITS = 20


def _bits(hashes: np.ndarray) -> np.ndarray:
    """128 bits of each shingle hash as -1 and 1."""
    both = np.stack([W.mix(hashes), W.mix(hashes ^ np.uint64(0xA5A5A5A5DEADBEEF))], axis=1)
    return np.unpackbits(both.view(np.uint8).reshape(len(hashes), BITS // 8), axis=1).astype(np.int32) * 2 - 1


def _packed(totals: np.ndarray) -> np.ndarray:
    return np.packbits(totals > 0, axis=1)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of the lesser counts over the sum of the larger ones, of two lists of shingles."""
    values, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x = np.bincount(at[: len(a)], minlength=len(values))
    y = np.bincount(at[len(a) :], minlength=len(values))
    most = int(np.maximum(x, y).sum())
    return int(np.minimum(x, y).sum()) / most if most else 0.0


class Items:
    """One part of the benchmark: shingles, fingerprints and block tables by number of words."""

    def __init__(self, texts: pa.Array):
        own = W.words(texts)
        self.words = own.counts
        self.shingles = W.shingles(own, K)
        item = np.repeat(np.arange(len(self.words)), self.shingles.counts)
        order = np.argsort(self.shingles.values, kind="stable")
        self.known, first = np.unique(self.shingles.values[order], return_index=True)
        self.holders, self.first = item[order], np.append(first, len(order))
        self.maybe = np.zeros(1 << _PREFILTER_BITS, bool)
        self.maybe[self.known >> np.uint64(64 - _PREFILTER_BITS)] = True
        self.groups = {}
        near = np.array([0] + [1 << i for i in range(8)], np.uint8)
        for n in np.unique(self.words[self.words > 0]).tolist():
            members = np.flatnonzero(self.words == n)
            prints = _packed(np.stack([_bits(self.shingles.row(i)).sum(axis=0) for i in members]))
            tables = np.zeros((BLOCKS, 256, len(members)), bool)
            for j in range(BLOCKS):
                for flip in near:
                    tables[j, prints[:, j] ^ flip, np.arange(len(members))] = True
            self.groups[n] = (members, prints, tables)
        #: Items of fewer than K words are one shingle each; documents are searched for these by length.
        self.short = sorted(n for n in self.groups if n < K)

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, item) for every hash that is a shingle of an item."""
        at = np.flatnonzero(self.maybe[hashes >> np.uint64(64 - _PREFILTER_BITS)])
        place = np.searchsorted(self.known, hashes[at])
        hit = self.known[np.minimum(place, len(self.known) - 1)] == hashes[at] if len(self.known) else np.zeros(len(at), bool)
        at, place = at[hit], place[hit]
        n = self.first[place + 1] - self.first[place]
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.holders[np.repeat(self.first[place], n) + offset]

    def search(self, shingles: np.ndarray, starts: np.ndarray, length: int, n: int) -> dict[int, tuple[float, int]]:
        """The best (similarity, start) per item of ``n`` words over windows of ``length`` shingles."""
        members, prints, tables = self.groups[n]
        low = int(starts.min())
        bits = _bits(shingles[low : int(starts.max()) + length])
        sums = np.concatenate([np.zeros((1, BITS), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
        own = _packed(sums[starts - low + length] - sums[starts - low])
        found: dict[int, tuple[float, int]] = {}
        for begin in range(0, len(starts), 256):
            some = own[begin : begin + 256]
            close = np.zeros((len(some), len(members)), bool)
            for j in range(BLOCKS):
                close |= tables[j, some[:, j]]
            for w, m in zip(*np.nonzero(close), strict=True):
                if int(np.bitwise_count(some[w] ^ prints[m]).sum()) > RADIUS:
                    continue
                start, item = int(starts[begin + w]), int(members[m])
                similarity = weighted_similarity(shingles[start : start + length], self.shingles.row(item))
                if similarity > found.get(item, (0.0, 0))[0]:
                    found[item] = (similarity, start)
        return found


def _hits(texts: pa.Array, items: Items, share: float) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, similarity, first word, words) of the best window per row and item."""
    own = W.words(texts)
    counts, all_shingles = own.counts, W.shingles(own, K)
    row_of = np.repeat(np.arange(len(counts)), all_shingles.counts)
    position, item = items.lookup(all_shingles.values)
    wanted: dict[tuple[int, int], list[np.ndarray]] = {}
    if len(position):
        rows, lengths = row_of[position], items.words[item]
        at = position - all_shingles.offsets[rows]
        for row, n, place in np.unique(np.stack([rows, lengths, at]), axis=1).T.tolist():
            length = min(max(n - K + 1, 1), int(all_shingles.counts[row]))
            last = int(all_shingles.counts[row]) - length
            wanted.setdefault((row, n), []).append(np.arange(max(place - length + 1, 0), min(place, last) + 1))
    for (row, n), windows in wanted.items():
        length = min(max(n - K + 1, 1), int(all_shingles.counts[row]))
        for i, (similarity, start) in items.search(all_shingles.row(row), np.unique(np.concatenate(windows)), length, n).items():
            if similarity >= share:
                yield row, i, similarity, start, min(n, int(counts[row]))
    for n in items.short:
        # A text of n words is one shingle already and was found above; here it is part of a longer one.
        begins = np.arange(len(own.values))
        row = np.repeat(np.arange(len(counts)), counts)
        fits = (begins + n <= own.offsets[row + 1]) & (counts[row] > n)
        begins, row = begins[fits], row[fits]
        pieces = W.Rows(own.values[(begins[:, None] + np.arange(n)).ravel()], np.arange(len(begins) + 1) * n)
        seen = set()
        for at, i in zip(*items.lookup(W.shingles(pieces, K).values), strict=True):
            if items.words[i] == n and (row[at], i) not in seen:
                seen.add((row[at], i))
                yield int(row[at]), int(i), 1.0, int(begins[at] - own.offsets[row[at]]), n


_built: dict[int, Items] = {}


def _items(part: Broadcast) -> Items:
    """Built once in each Python worker that sees the part."""
    key = hash(part.value)
    if key not in _built:
        _built.clear()
        _built[key] = Items(pa.ipc.open_stream(part.value).read_all().column("text").combine_chunks())
    return _built[key]


def _parts(spark: SparkSession, benchmark: DataFrame) -> Iterator[Broadcast]:
    """The benchmark by hash in parts of bounded size, each as an Arrow stream of item_id and text."""
    texts = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // PART_BYTES)
    for part in range(n):
        table = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part).toArrow()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as stream:
            stream.write_table(table)
        yield spark.sparkContext.broadcast(sink.getvalue().to_pybytes())


def find(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """One row per document row and benchmark row found in it: doc_id, item_id, similarity, first_word, n_words.

    The window given is the first of the greatest similarity. A text shorter than the item is one
    window. Items of fewer than 5 words are found as they are; null texts and texts without words
    contain nothing and are found nowhere. Ids may be null or repeat: each row counts by itself.
    Documents are read once for each part of the benchmark and never shuffled.
    """
    spark = docs.sparkSession
    ship(spark)
    doc_type, item_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    schema = f"doc_id {doc_type}, item_id {item_type}, similarity double, first_word long, n_words long"

    def search(part: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items(part)
            ids = pa.ipc.open_stream(part.value).read_all().column("item_id").combine_chunks()
            for batch in batches:
                for some in W.chunks(batch, "text"):
                    found = list(_hits(some.column("text"), items, share))
                    rows, which, similarity, start, n = zip(*found, strict=True) if found else ([],) * 5
                    columns = [
                        some.column("doc_id").take(pa.array(rows, pa.int64())),
                        ids.take(pa.array(which, pa.int64())),
                        pa.array(similarity, pa.float64()),
                        pa.array(start, pa.int64()),
                        pa.array(n, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)

    found = [search(part) for part in _parts(spark, benchmark)]
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def remove(docs: DataFrame, benchmark: DataFrame, share: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns as they are, in which ``find`` finds nothing."""
    ship(docs.sparkSession)

    def clean(part: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items(part)
            for batch in batches:
                for some in W.chunks(batch, "text"):
                    keep = np.ones(some.num_rows, bool)
                    keep[[row for row, *_ in _hits(some.column("text"), items, share)]] = False
                    yield some.filter(pa.array(keep))

        return run

    for part in _parts(docs.sparkSession, benchmark):
        docs = docs.mapInArrow(clean(part), docs.schema)
    return docs
