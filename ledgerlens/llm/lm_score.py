"""Stupid-backoff scores of documents under the bigram counts of all documents.

The score of a word w after v is c(vw) / c(v.) if vw occurs at least MIN_COUNT times in the corpus,
c(v.) being the bigrams that begin with v, and else BACKOFF * c(w) / N. A document's first word scores
c(w) / N. Logarithms are summed per document.

Words are 64-bit hashes. The n-grams of a block of documents are exploded into sorted arrays, grouped
by bigram and dealt to hash buckets; a bucket holds all occurrences of its bigrams, so it counts and
joins them in one place and returns the sums to the block. Backed-off words go on to the buckets of
the word counts. Words with a thousandth of all occurrences or more, at most HOT_SHARE of them, are
known to every task with their counts and those of all pairs of them, so what can be hot is looked
up where it occurs, and a bigram behind a hot word is dealt by both words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.memory import after_batches, after_cogroup, after_group
from ledgerlens.llm.shipping import ship
from ledgerlens.operators.shared import materialize, measure

BACKOFF, MIN_COUNT = 0.4, 2
HOT_SHARE = 1000
# Words and documents of a block; a document of more words is a block of its own. 16 bits number the documents.
BLOCK_WORDS, BLOCK_DOCS = 1_000_000, 60_000
# A bucket's task holds about ten times this.
BUCKET_BYTES = 24 << 20
SUMS = "block long, docs binary, scores binary, backoffs binary, ids binary, nulls binary, words binary"


class Hot(NamedTuple):
    """The frequent words, sorted, with their counts and those of bigrams that begin with them or lie among them."""

    words: np.ndarray
    count: np.ndarray
    begins: np.ndarray
    pairs: np.ndarray

    def find(self, words: np.ndarray) -> np.ndarray:
        """The place of each word, -1 if it is not among them."""
        if not len(self.words):
            return np.full(len(words), -1, np.int32)
        at = np.searchsorted(self.words, words).astype(np.int32)
        np.minimum(at, len(self.words) - 1, out=at)
        at[self.words[at] != words] = -1
        return at


class _Block:
    """The words of some documents: bigram i is (first[i], second[i]) in document doc[i]."""

    def __init__(self, parts: list[tuple[pa.RecordBatch, W.Rows]]):
        self.words = np.concatenate([w.values for _, w in parts])
        self.counts = np.concatenate([w.counts for _, w in parts])
        self.batches = [b for b, _ in parts]
        doc = np.repeat(np.arange(len(self.counts), dtype=np.uint16), self.counts)
        self.ends = np.ones(len(doc), bool)  # the last word of a document
        self.ends[:-1] = doc[1:] != doc[:-1]
        begins = np.flatnonzero(~self.ends)
        self.first, self.second, self.doc = self.words[begins], self.words[begins + 1], doc[begins]
        starts = np.cumsum(self.counts) - self.counts
        self.openers = np.flatnonzero(self.counts > 0)
        self.opening = self.words[starts[self.openers]]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    held, size, docs = [], 0, 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_DOCS):
            for part in W.chunks(batch.slice(start, BLOCK_DOCS), "text"):
                own = W.words(part.column("text"))
                if held and (size + len(own.values) > BLOCK_WORDS or docs + part.num_rows > BLOCK_DOCS):
                    full, held, size, docs = [_Block(held)], [], 0, 0
                    yield full.pop()  # the only reference, so that the block can go before the next
                held.append((_beside_text(part), own))
                size, docs = size + len(own.values), docs + part.num_rows
    if held:
        full, held = [_Block(held)], []
        yield full.pop()


def _beside_text(part: pa.RecordBatch) -> pa.RecordBatch:
    """A copy of the other columns; a slice would hold on to all that Spark sent with it."""
    others = part.select([c for c in part.schema.names if c != "text"])
    return others.take(pa.array(np.arange(part.num_rows))) if others.num_columns else others


def _tally(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = np.unique(keys, return_counts=True)
    return values, counts.astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """word (hash), n (occurrences) and begins (those followed by another word in their document)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            words, n = _tally(block.words)
            last, at_end = _tally(block.words[block.ends])
            begins = n.copy()
            begins[np.searchsorted(words, last)] -= at_end
            columns = [pa.array(words.view(np.int64)), pa.array(n), pa.array(begins)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "begins"])

    counted = docs.select("text").mapInArrow(after_batches(run), "word long, n long, begins long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("begins").alias("begins"))


def _hot(docs: DataFrame, table: DataFrame, total: int) -> Hot:
    # At most HOT_SHARE rows, and at most its square of pairs.
    rows = table.where(F.col("n") * HOT_SHARE >= total).collect() if total else []
    rows = sorted(rows, key=lambda r: r["word"] % (1 << 64))
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    hot = Hot(words, *(np.array([r[c] for r in rows], np.int64) for c in ("n", "begins")), np.zeros((0, 0), np.int64))
    size = len(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            a, b = hot.find(block.first), hot.find(block.second)
            both = (a >= 0) & (b >= 0)
            pair, n = _tally(a[both].astype(np.int64) * size + b[both])
            yield pa.RecordBatch.from_arrays([pa.array(pair.astype(np.int64)), pa.array(n)], ["pair", "n"])

    pairs = np.zeros(size * size, np.int64)
    if size:
        for r in docs.select("text").mapInArrow(after_batches(run), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
            pairs[r["pair"]] = r["n"]
    return hot._replace(pairs=pairs.reshape(size, size))


def _bytes(x: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(x, kind).tobytes()


def _sums(block: int, docs: np.ndarray, scores: np.ndarray, backoffs: np.ndarray) -> dict:
    return {"block": block, "docs": _bytes(docs, np.uint16), "scores": _bytes(scores, np.float64), "backoffs": _bytes(backoffs, np.uint32)}


def _per_doc(block: int, doc: np.ndarray, score: np.ndarray, backoff: np.ndarray) -> dict:
    docs, at = np.unique(doc, return_inverse=True)
    return _sums(block, docs, np.bincount(at, score, len(docs)), np.bincount(at, backoff, len(docs)))


def _asks(blocks: list[int], block: np.ndarray, words: np.ndarray, doc: np.ndarray, buckets: int) -> Iterator[dict]:
    """Backed-off words by the bucket of their counts; ``block`` holds places in the list of blocks."""
    bucket = ((words >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((words, bucket))
    words, doc, block, bucket = words[order], doc[order], block[order], bucket[order]
    edges = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        some = slice(edges[b], edges[b + 1])
        different, n = _tally(words[some])
        used, place = np.unique(block[some], return_inverse=True)
        yield {
            "bucket": b, "block": blocks[0], "second": _bytes(different, np.uint64), "n": _bytes(n, np.uint32), "docs": _bytes(doc[some], np.uint16),
            "ids": _bytes(np.array(blocks, np.int64)[used], np.int64), "words": _bytes(place, np.uint32), "kind": WORDS,
        }


_ROWS = pa.schema(
    [(n, pa.int64()) for n in ("bucket", "block")]
    + [(n, pa.binary()) for n in ("first", "second", "n", "docs", "scores", "backoffs", "ids", "nulls", "words")]
)
_ROWS_SQL = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'binary'}" for f in _ROWS)
# Which bucket column a row belongs to: bigrams and word counts have buckets of their own.
BIGRAMS, WORDS, DONE = 0, 1, 2


def _explode(hot: Hot, total: int, buckets: int):
    """Bigrams by bucket, and per block the ids and the sums of what the frequent words decide."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        number = (task << 32) - 1
        for block in _blocks(batches):
            number += 1
            rows = []
            a, b = hot.find(block.first), hot.find(block.second)
            known = (a >= 0) & (b >= 0)
            pair = hot.pairs[a[known], b[known]]
            seen = pair >= MIN_COUNT
            score = np.where(
                seen,
                np.log(np.maximum(pair, 1)) - np.log(np.maximum(hot.begins[a[known]], 1)),
                np.log(BACKOFF) + np.log(np.maximum(hot.count[b[known]], 1)) - np.log(max(total, 1)),
            )
            sums, off = np.zeros(len(block.counts)), np.zeros(len(block.counts))
            np.add.at(sums, block.doc[known], score)
            np.add.at(off, block.doc[known], ~seen)
            sums[block.openers] -= np.log(max(total, 1))
            at = hot.find(block.opening)
            sums[block.openers[at >= 0]] += np.log(hot.count[at[at >= 0]])
            ids = pa.concat_arrays([x.column("doc_id") for x in block.batches])
            done = _sums(number, np.arange(len(sums)), sums, off)
            done |= {
                "bucket": 0, "kind": DONE, "words": _bytes(block.counts, np.int64),
                "ids": _bytes(ids.fill_null(0).to_numpy(zero_copy_only=False), np.int64),
                "nulls": _bytes(ids.is_null().to_numpy(zero_copy_only=False), np.uint8),
            }
            rows.append(done)
            opening = block.opening[at < 0]
            rows += _asks([number], np.zeros(len(opening), np.int64), opening, block.openers[at < 0], buckets)
            # What is done with goes at once: a block's arrays together are many times its words.
            known = ~known
            first, second, doc, behind = block.first[known], block.second[known], block.doc[known], a[known] >= 0
            del a, b, known, pair, seen, score, block
            bucket = (W.mix(first ^ np.where(behind, W.mix(second), np.uint64(0))) % np.uint64(buckets)).astype(np.int32)
            del behind
            order = np.lexsort((second, first, bucket))
            first, second, doc, bucket = first[order], second[order], doc[order], bucket[order]
            del order
            new = np.ones(len(first), bool)
            new[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1]) | (bucket[1:] != bucket[:-1])
            pairs = np.flatnonzero(new)
            n = np.diff(np.append(pairs, len(first)))
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            pair_edges = np.searchsorted(pairs, edges)
            for b in np.flatnonzero(np.diff(edges)).tolist():
                p = slice(pair_edges[b], pair_edges[b + 1])
                contexts = first[pairs[p]]
                begin = np.flatnonzero(np.concatenate([[True], contexts[1:] != contexts[:-1]]))
                runs = np.diff(np.append(begin, len(contexts)))
                rows.append(
                    {
                        "bucket": b, "block": number, "kind": BIGRAMS, "first": _bytes(contexts[begin], np.uint64),
                        "words": _bytes(runs, np.uint32), "second": _bytes(second[pairs[p]], np.uint64),
                        "n": _bytes(n[p], np.uint32), "docs": _bytes(doc[edges[b] : edges[b + 1]], np.uint16),
                    }
                )
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_pylist(rows[i : i + 64], _ROWS.append(pa.field("kind", pa.int32())))

    return run


def _columns(table: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) if x.is_valid else np.zeros(0, kind) for x in table.column(name)]


def _count_bigrams(hot: Hot, total: int, buckets: int):
    """All bigrams of a bucket: counts, the sums of those seen often enough, and the words to ask for."""

    def run(_: tuple, table: pa.Table) -> pa.Table:
        rows = []
        blocks = table.column("block").to_numpy()
        runs = _columns(table, "words", np.uint32)
        first = np.concatenate([np.repeat(f, r) for f, r in zip(_columns(table, "first", np.uint64), runs, strict=True)])
        second = np.concatenate(_columns(table, "second", np.uint64))
        n_of = _columns(table, "n", np.uint32)
        n = np.concatenate(n_of).astype(np.int64)
        order = np.lexsort((second, first))
        f = first[order]
        new_first = np.concatenate([[True], f[1:] != f[:-1]])
        new, f = new_first.copy(), second[order]
        new[1:] |= f[1:] != f[:-1]
        del f

        def totals(fresh: np.ndarray) -> np.ndarray:
            back = np.empty(len(order), np.int64)
            back[order] = np.add.reduceat(n[order], np.flatnonzero(fresh))[np.cumsum(fresh) - 1]
            return back

        count, begins = totals(new), totals(new_first)
        at = hot.find(first)
        del order, new, new_first, first, n
        begins = np.where(at >= 0, hot.begins[np.maximum(at, 0)] if len(hot.begins) else 0, begins)
        seen = count >= MIN_COUNT
        at = hot.find(second)
        frequent = at >= 0
        usual = np.log(hot.count[np.maximum(at, 0)]) if len(hot.count) else np.zeros(len(at))
        score = np.where(seen, np.log(count) - np.log(np.maximum(begins, 1)), np.log(BACKOFF) - np.log(total) + np.where(frequent, usual, 0.0))
        del count, begins, at, usual
        place, asked = 0, []
        for k, (block, pairs, docs) in enumerate(zip(blocks.tolist(), n_of, _columns(table, "docs", np.uint16), strict=True)):
            own = slice(place, place + len(pairs))
            place += len(pairs)
            rows.append(_per_doc(block, docs, np.repeat(score[own], pairs), np.repeat(~seen[own], pairs)) | {"kind": DONE})
            open_ = np.repeat(~seen[own] & ~frequent[own], pairs)
            asked.append((np.full(int(open_.sum()), k), np.repeat(second[own], pairs)[open_], docs[open_]))
        block, words, docs = (np.concatenate(x) for x in zip(*asked, strict=True))
        rows += _asks(blocks.tolist(), block, words, docs, buckets)
        return pa.Table.from_pylist(rows, _ROWS.append(pa.field("kind", pa.int32())))

    return run


def _look_up(_: tuple, asks: pa.Table, counts: pa.Table) -> pa.Table:
    words = counts.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    words, logs = words[order], np.log(counts.column("n").to_numpy()[order])
    found = []
    kinds = (("second", np.uint64), ("n", np.uint32), ("docs", np.uint16), ("ids", np.int64), ("words", np.uint32))
    for asked, n, docs, blocks, place in zip(*(_columns(asks, c, k) for c, k in kinds), strict=True):
        found.append((blocks[place], docs, np.repeat(logs[np.searchsorted(words, asked)], n)))
    block, docs, score = (np.concatenate(x) if found else np.zeros(0) for x in (zip(*found, strict=True) if found else ((),) * 3))
    order = np.argsort(block, kind="stable")
    numbers, first = np.unique(block[order], return_index=True)
    rows = []
    for number, start, end in zip(numbers.tolist(), first, np.append(first[1:], len(order)), strict=False):
        some = order[start:end]
        rows.append(_per_doc(int(number), docs[some], score[some], np.zeros(len(some))))
    return pa.Table.from_pylist(rows, pa.schema([_ROWS.field(n) for n in ("block", "docs", "scores", "backoffs", "ids", "nulls", "words")]))


def _finish(_: tuple, table: pa.Table) -> pa.Table:
    """The rows of one block: as many sums as it has words at most."""
    ids, nulls, words = (np.concatenate(_columns(table, c, k)) for c, k in (("ids", np.int64), ("nulls", np.uint8), ("words", np.int64)))
    scores, backoffs = np.zeros(len(ids)), np.zeros(len(ids), np.int64)
    for docs, score, off in zip(*(_columns(table, c, k) for c, k in (("docs", np.uint16), ("scores", np.float64), ("backoffs", np.uint32))), strict=True):
        scores[docs] += score
        backoffs[docs] += off
    none = words == 0
    mean = np.divide(scores, words, where=~none, out=np.zeros(len(ids)))
    return pa.table(
        {
            "doc_id": pa.array(ids, mask=nulls.astype(bool)), "n_words": pa.array(words), "n_backoffs": pa.array(backoffs),
            "log_score": pa.array(scores, mask=none), "mean_log_score": pa.array(mean, mask=none),
        }
    )


def score(docs: DataFrame) -> DataFrame:
    """Per row doc_id, n_words, n_backoffs, log_score (sum of natural logarithms) and mean_log_score.

    Texts without words, null ones among them, have null scores. Rows may repeat a doc_id or a text,
    and each copy counts; ids may be null. Only the columns doc_id and text are read. The buckets are
    as many as keep one's arrays within memory. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    table = measure(word_counts(docs), "word_counts", total=F.sum("n"))
    total = table.measures["total"]
    hot = _hot(docs, table.table, total)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total * 10 // BUCKET_BYTES))
    exploded = docs.mapInArrow(after_batches(_explode(hot, total, buckets)), f"{_ROWS_SQL}, kind int")
    count = _count_bigrams(hot, total, buckets)

    def by_bucket(key: tuple, part: pa.Table) -> pa.Table:
        return count(key, part) if key[0].as_py() == BIGRAMS else part.select([*_ROWS.names, "kind"])

    # Rows that are done, or ask for single words, pass through in groups of their own block.
    mixed = exploded.withColumn("_group", F.when(F.col("kind") == BIGRAMS, F.col("bucket")).otherwise(F.col("block")))
    stage = materialize(mixed.groupBy("kind", "_group").applyInArrow(after_group(by_bucket), f"{_ROWS_SQL}, kind int"), "bigram_scores")
    asks = stage.where(F.col("kind") == WORDS).select("bucket", "second", "n", "docs", "ids", "words")
    bucket = F.pmod(F.shiftrightunsigned("word", 1), F.lit(buckets)).cast("long").alias("bucket")  # as in _asks
    known = table.table.where(F.col("n") * HOT_SHARE < total).select(bucket, "word", "n")
    looked = asks.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(after_cogroup(_look_up), SUMS)
    columns = [c.split()[0] for c in SUMS.split(", ")]
    done = stage.where(F.col("kind") == DONE).select(*columns).unionAll(looked.select(*columns))
    schema = "doc_id long, n_words long, n_backoffs long, log_score double, mean_log_score double"
    return done.groupBy("block").applyInArrow(after_group(_finish), schema)
