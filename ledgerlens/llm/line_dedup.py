"""Removal of lines that are similar to an earlier line, by an exact set-similarity join.

A line is the set of its words. Lines are taken in the order of doc_id, then of rows and lines; a line
goes if any line before it is equal as a set or has a Jaccard similarity of at least 0.8.

1. Lines with equal sets form a class, of which the first line stands for all.
2. Words are ordered by rarity, counted in a fixed number of hashed counters. Two similar lines share
   one of their rarest words, so each line is dealt by the words of its prefix. Lines that meet are
   compared if lengths, positions of the word and a bitmap of parities allow the similarity.
3. Of the earlier lines that a line may be similar to, the earliest under each word is verified first, by the
   words of the texts. Near copies of one line all find it, so their pairs grow with their number.
4. Only lines that this leaves without an earlier match are held against all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import words as W
from ledgerlens.llm.memory import after_batches, after_group
from ledgerlens.llm.shipping import ship
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, materialize, measure, measure_size

SHARE, PER = 4, 5
_WORD = r"[^\x20\x09-\x0D]"
# Sets of fewer words are similar only if they are equal.
LEAST_WORDS = 4
# The counters of words: a fixed size, whatever the vocabulary. They decide an order, not a result.
COUNTERS, SLICES = 1 << 20, 64
# Of up to SMALL lines under one word all pairs are compared, of up to PART lines those of fitting
# lengths. More lines, or more candidates than DENSE for each line, as among near copies, make an open
# group: beside each line's first candidate (of more lines, within PART lines of like length) its lines are
# kept, cut into parts of PART lines, and searched by the lines still without a match.
SMALL, PART, DENSE = 64, 4096, 4
# Results of so many tasks are added up by one task at a time.
FAN_IN = 256


class Lines:
    """The distinct words of each line of some texts: line i of the chunk is line ``number[i]`` of row ``row[i]``."""

    def __init__(self, texts: pa.Array):
        raw, offsets = W.utf8(texts)
        breaks = np.flatnonzero(raw == 10) + 1
        # Of lines that begin at one place only the last can have words.
        starts = np.unique(np.concatenate([offsets[:-1], breaks]))
        row = np.searchsorted(offsets[:-1], starts, "right") - 1
        at = np.searchsorted(starts, offsets[:-1])
        self.number = np.arange(len(starts)) - at[row]
        ends = np.append(starts[1:], len(raw))
        keep = ends > starts
        starts, ends, self.row, self.number = starts[keep], ends[keep], row[keep], self.number[keep]
        lines = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(raw)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(raw))]
        ) if len(starts) else pa.array([], pa.large_binary())
        own = W.words(lines.cast(pa.large_string()))
        some = own.counts > 0
        self.row, self.number = self.row[some], self.number[some]
        self.sets = W.distinct(W.Rows(own.values, np.append(own.offsets[:-1][some], len(own.values))))

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        first = W.mix(W.sums(self.sets, W.mix(self.sets.values)) + self.sets.counts.astype(np.uint64))
        return first, W.mix(W.sums(self.sets, W.mix(self.sets.values ^ np.uint64(0x2545F4914F6CDD1D))))


def _counter(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(44)).astype(np.int64)


def word_rarity(docs: DataFrame) -> np.ndarray:
    """The counters: lines with a word of each bucket, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in W.chunks(batch, "text"):
                total += np.bincount(_counter(Lines(part.column("text")).sets.values), minlength=COUNTERS)
        slices = total.reshape(SLICES, -1)
        columns = [pa.array(np.arange(SLICES)), pa.array([s.tobytes() for s in slices])]
        yield pa.RecordBatch.from_arrays([columns[0], pa.array(np.full(SLICES, TaskContext.get().partitionId())), columns[1]], ["slice", "part", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in table.column("counts"))
        return pa.table({"slice": [key[0].as_py()], "part": [key[1].as_py()], "counts": [total.tobytes()]})

    schema = "slice long, part long, counts binary"
    level = docs.select("text").mapInArrow(after_batches(count), schema)
    while True:
        level = level.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("slice", "part").applyInArrow(after_group(add), schema)
        level = measure(level, "word_counters", parts=F.max("part"))
        if level.measures["parts"] == 0:
            break
        level = level.table
    rows = {r["slice"]: r["counts"] for r in level.table.select("slice", "counts").collect()}
    empty = bytes(COUNTERS // SLICES * 8)
    return np.concatenate([np.frombuffer(rows.get(s, empty), np.int64) for s in range(SLICES)])


def _least_shared(a, b):
    """How many words sets of these sizes must share: the least whole number not below."""
    return -(-SHARE * (a + b) // (PER + SHARE))


# ``early`` grows with doc_id: of two lines, the one with the lesser value comes first; equal ones leave it open.
_POSTING = [
    ("word", np.uint32), ("digest", np.uint64), ("low", np.uint64), ("high", np.uint64), ("size", np.uint32),
    ("place", np.uint16), ("early", np.float32),
]


def _postings(rarity, buckets: int):
    """Per bucket of words the lines that have one of them in their prefix, as arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in batches:
            found = []
            for part in W.chunks(batch, "text"):
                lines = Lines(part.column("text"))
                digest, _ = lines.digests()
                once = np.zeros(len(digest), bool)
                early = part.column("_id").to_numpy()[lines.row].astype(np.float32)
                by_early = np.argsort(early, kind="stable")
                once[by_early[np.unique(digest[by_early], return_index=True)[1]]] = True
                picked = np.flatnonzero(once & (lines.sets.counts >= LEAST_WORDS))
                if not len(picked):
                    continue
                sizes = lines.sets.counts[picked]
                begin = np.cumsum(sizes) - sizes
                words = lines.sets.values[np.repeat(lines.sets.offsets[picked] - begin, sizes) + np.arange(sizes.sum())]
                line = np.repeat(np.arange(len(picked)), sizes)
                bit, upper = np.uint64(1) << (words & np.uint64(63)), (words >> np.uint64(6)) & np.uint64(1) > 0
                low = np.bitwise_xor.reduceat(np.where(upper, np.uint64(0), bit), begin)
                high = np.bitwise_xor.reduceat(np.where(upper, bit, np.uint64(0)), begin)
                order = np.lexsort((words, counts[_counter(words)], line))
                place = np.arange(len(words)) - begin[line]
                prefix = place < sizes[line] - -(-SHARE * sizes[line] // PER) + 1
                # A place that is too far back for its type is given as nearer, which only lets more pairs pass.
                words, line, place = words[order][prefix], line[prefix], np.minimum(place[prefix], 0xFFFF)
                found.append((W.mix(words), digest[picked][line], low[line], high[line], sizes[line], place, early[picked][line]))
            if not found:
                continue
            words, *rest = (np.concatenate(x) for x in zip(*found, strict=True))
            bucket = (words >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            some = np.flatnonzero(np.diff(edges))
            columns = [pa.array(some)]
            for (_, kind), values in zip(_POSTING, (words & np.uint64(0xFFFFFFFF), *rest), strict=True):
                values = values[order].astype(kind)
                columns.append(pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in some], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["bucket", *(n for n, _ in _POSTING)])

    return run


def _allowed(x: dict, y: dict) -> np.ndarray:
    """Whether lines that share a word can be similar, by lengths, positions and parities."""
    a, b = x["size"].astype(np.int64), y["size"].astype(np.int64)
    least = _least_shared(a, b)
    rest = np.minimum(a - x["place"], b - y["place"])
    apart = np.bitwise_count(x["low"] ^ y["low"]) + np.bitwise_count(x["high"] ^ y["high"])
    return (x["digest"] != y["digest"]) & (np.minimum(a, b) >= least) & (rest >= least) & (apart <= a + b - 2 * least)


def _take(data: dict, at: np.ndarray) -> dict:
    return {n: v[at] for n, v in data.items()}


def _within(data: dict, left: np.ndarray, right: np.ndarray, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Allowed pairs of two lists of lines, both by ascending size; of one list (``same``) each pair once.

    Blocks of the left list meet only the lengths they can be similar to.
    """
    sizes = data["size"].astype(np.int64)
    total = int(sizes[right].max(initial=0)) + int(sizes[left].max(initial=0)) + 1
    limit = np.arange(total) - 2 * _least_shared(np.arange(total), 0)
    own = sizes[right]
    for start in range(0, len(left), 256):
        some = left[start : start + 256]
        low, high = sizes[some[0]], sizes[some[-1]]
        begin = int(np.searchsorted(own, -(-SHARE * low // PER)))
        end = int(np.searchsorted(own, PER * high // SHARE, "right"))
        begin = max(begin, start) if same else begin
        other = right[begin:end]
        if not len(other):
            continue
        low, high = (np.bitwise_count(data[n][some][:, None] ^ data[n][other][None]) for n in ("low", "high"))
        i, j = np.nonzero(low + high <= limit[sizes[some][:, None] + sizes[other][None]])
        if same:
            keep = j + begin > i + start
            i, j = i[keep], j[keep]
        i, j = some[i], other[j]
        keep = _allowed(_take(data, i), _take(data, j))
        yield i[keep], j[keep]


def _meet(_: tuple, table: pa.Table) -> pa.Table:
    """Pairs of the groups of one bucket, ``a`` the earlier line: each line's first ones and (``later``) the others.

    Of open groups the first ones and the group's lines, ``more`` if a line has further candidates. Pairs of
    which the order is left open (``either``) are further candidates of both lines.
    """
    data = {n: np.concatenate([np.frombuffer(x.as_buffer(), k) for x in table.column(n)]) for n, k in _POSTING}
    data = _take(data, np.lexsort((data["early"], data["digest"], data["word"])))
    once = np.ones(len(data["word"]), bool)
    once[1:] = (data["word"][1:] != data["word"][:-1]) | (data["digest"][1:] != data["digest"][:-1])
    data = _take(data, once)
    data = _take(data, np.lexsort((data["size"], data["word"])))
    n_lines = len(data["word"])
    starts = np.flatnonzero(np.concatenate([[True], data["word"][1:] != data["word"][:-1]]))
    sizes = np.diff(np.append(starts, n_lines))
    group = np.repeat(np.arange(len(starts)), sizes)
    by_rank = np.lexsort((data["digest"], data["early"]))
    rank = np.empty(n_lines, np.int64)
    rank[by_rank] = np.arange(n_lines)
    first = np.full(n_lines, n_lines)
    candidates = np.zeros(n_lines, np.int64)
    found = []

    def note(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        swap = rank[i] > rank[j]
        before, after = np.where(swap, j, i), np.where(swap, i, j)
        np.minimum.at(first, after, rank[before])
        np.add.at(candidates, after, 1)
        either = data["early"][before] == data["early"][after]
        for end in (before, after):
            np.add.at(candidates, end[either], 2)
        return before, after

    small = (sizes > 1) & (sizes <= SMALL)
    for gap in range(1, int(sizes[small].max(initial=1))):
        # The pairs of neighbours at this distance, of all small groups at once.
        wide = small & (sizes > gap)
        n = sizes[wide] - gap
        i = np.repeat(starts[wide] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        keep = _allowed(_take(data, i), _take(data, i + gap))
        found.append(note(i[keep], i[keep] + gap))
    is_open = sizes > PART
    for g in np.flatnonzero(sizes > SMALL).tolist():
        pairs, n = [], 0
        for start in range(starts[g], starts[g] + sizes[g], PART):
            own = np.arange(start, min(start + PART, starts[g] + sizes[g]))
            for i, j in _within(data, own, own, True):
                ends = note(i, j)
                n += len(i)
                is_open[g] |= n > DENSE * sizes[g]
                if not is_open[g]:
                    pairs.append(ends)
        if not is_open[g]:
            found += pairs
    before, after = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*found, strict=True) if found else ((), ())))
    is_open |= np.bincount(group[after], minlength=len(starts)) > DENSE * sizes
    members = np.flatnonzero(is_open[group])
    more = (candidates[members] > 1) | (sizes[group[members]] > PART)
    later = np.flatnonzero(first < n_lines)
    rest = (first[after] != rank[before]) & ~is_open[group[after]]
    left = np.concatenate([by_rank[first[later]], before[rest]])
    right = np.concatenate([later, after[rest]])
    # The first pairs, then the others.
    pairs = {"a": pa.array(data["digest"][left].view(np.int64)), "b": pa.array(data["digest"][right].view(np.int64))}
    pairs |= {"later": pa.array(np.arange(len(left)) >= len(later)), "either": pa.array(data["early"][left] == data["early"][right])}
    key = int(table.column("bucket")[0].as_py()) << 32
    held = {n: data[n][members] for n in ("digest", "low", "high", "size", "place")}
    opened = {"group": pa.array(data["word"][members].astype(np.int64) + key)}
    opened |= {n: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64)) for n, v in held.items()}
    opened |= {"early": pa.array(data["early"][members]), "more": pa.array(more)}
    kinds = {**{n: c.type for n, c in pairs.items()}, **{n: c.type for n, c in opened.items()}}
    parts = [{n: c.get(n, pa.nulls(len(next(iter(c.values()))), k)) for n, k in kinds.items()} for c in (pairs, opened)]
    return pa.concat_tables([pa.table(c) for c in parts])


_MET = (
    "a long, b long, later boolean, either boolean, "
    "group long, digest long, low long, high long, size long, place long, early float, more boolean"
)


def _search(_: tuple, table: pa.Table) -> pa.Table:
    """Lines without a match against the lines, not after them, of one part of an open group."""
    table = table.sort_by("size")
    data = {n: table.column(n).to_numpy() for n in ("digest", "low", "high", "size", "place", "early")}
    data = {n: v.view(np.uint64) if n in ("digest", "low", "high") else v for n, v in data.items()}
    probe = table.column("probe").to_numpy(zero_copy_only=False)
    found = [np.zeros((0, 2), np.int64)]
    for i, j in _within(data, np.flatnonzero(probe), np.flatnonzero(~probe), False):
        keep = data["early"][j] <= data["early"][i]
        a, b = data["digest"][i[keep]], data["digest"][j[keep]]
        found.append(np.stack([np.minimum(a, b).view(np.int64), np.maximum(a, b).view(np.int64)], axis=1))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for part in W.chunks(batch, "text_b"):
            left, right = (W.distinct(W.words(part.column(c))) for c in ("text_a", "text_b"))
            for i in range(part.num_rows):
                x, y = left.row(i), right.row(i)
                both = len(np.unique(np.concatenate([x, y])))
                kept.append(PER * (len(x) + len(y) - both) >= SHARE * both)
        yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))


def _line_table(docs: DataFrame) -> DataFrame:
    """One row for each line with words: doc_id, row, line, digest, node (both digests)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.chunks(batch, "text"):
                lines = Lines(part.column("text"))
                first, second = lines.digests()
                both = np.stack([first, second], axis=1).tobytes()
                node = pa.array([both[i : i + 16] for i in range(0, len(both), 16)], pa.binary())
                at = pa.array(lines.row)
                columns = [part.column("_id").take(at), part.column("_hash").take(at), pa.array(lines.number), pa.array(first.view(np.int64)), node]
                yield pa.RecordBatch.from_arrays(columns, ["_id", "_hash", "line", "digest", "node"])

    return docs.select("_id", "_hash", "text").mapInArrow(after_batches(run), "_id long, _hash long, line long, digest long, node binary")


def _similar(pairs: DataFrame, first: DataFrame, docs: DataFrame) -> DataFrame:
    """Of pairs of digests the similar ones, as nodes: earlier and later."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("digest")).distinct()
    where = measure_size(first.join(wanted, "digest").select("_id", "_hash", "line", "digest", "node"), "candidate_lines")
    found = sized_join(docs, where, ["_id", "_hash"], ["_id", "_hash"], "inner")
    texts = found.select("digest", "node", F.element_at(F.split("text", "\n"), (F.col("line") + 1).cast("int")).alias("text"))
    texts = materialize(texts.dropDuplicates(["node"]), "candidate_texts")
    # A digest of several classes stands for each of them.
    left, right = (texts.toDF(k, c, f"text_{c}") for k, c in (("da", "a"), ("db", "b")))
    joined = pairs.toDF("da", "db").join(left, "da").join(right, "db").select("a", "b", "text_a", "text_b")
    linked = joined.mapInArrow(after_batches(_verify), "a binary, b binary")
    place = first.select("node", F.struct("_id", "_hash", "line").alias("place"))
    both = linked.join(place.toDF("a", "pa"), "a").join(place.toDF("b", "pb"), "b")
    a_first = F.col("pa") < F.col("pb")
    return materialize(
        both.select(
            F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("earlier"),
            F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("later"),
            F.least("pa", "pb").alias("place"),
        ),
        "similar_lines",
    )


def later_matches(docs: DataFrame) -> tuple[Measured, Measured]:
    """Per _id and _hash the _lines to remove, and the _id and _hash of several rows; ``docs`` has both and text."""
    spark = docs.sparkSession
    lines = materialize(_line_table(docs), "lines")
    first = lines.groupBy("node", "digest").agg(F.min(F.struct("_id", "_hash", "line")).alias("_p"))
    first = materialize(first.select("node", "digest", "_p.*"), "first_lines")
    rarity = spark.sparkContext.broadcast(word_rarity(docs))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    schema = "bucket long, " + ", ".join(f"{n} binary" for n, _ in _POSTING)
    dealt = docs.select("_id", "text").mapInArrow(after_batches(_postings(rarity, buckets)), schema)
    met = dealt.groupBy("bucket").applyInArrow(after_group(_meet), _MET)
    met = measure(met, "met_lines", later=F.count_if("later"), opened=F.count_if("more"))
    twins = first.select("digest").groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = met.table.where("not later").select("a", "b").distinct().unionAll(twins.selectExpr("digest as a", "digest as b"))
    similar = _similar(pairs, first, docs)

    if met.measures["later"] or met.measures["opened"]:
        matched = similar.select(F.col("later").alias("node")).distinct()
        resting = materialize(first.join(matched, "node", "left_anti").select("digest").distinct(), "unmatched_lines")
        further = met.table.where("later")
        rest = further.join(resting.toDF("b"), "b", "left_semi").select("a", "b")
        rest = rest.unionAll(further.where("either").join(resting.toDF("a"), "a", "left_semi").select("a", "b"))
        if met.measures["opened"]:
            opened = met.table.where("group is not null").drop("a", "b", "later", "either")
            probes = materialize(opened.where("more").join(resting, "digest", "left_semi"), "open_lines")
            held = opened.join(probes.select("group").distinct(), "group", "left_semi")
            parts = held.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
            held = held.join(parts, "group").withColumn("part", F.pmod(F.xxhash64("digest"), F.col("parts")).cast("int"))
            probes = probes.join(parts, "group").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            rows = held.withColumn("probe", F.lit(False)).unionByName(probes.withColumn("probe", F.lit(True)))
            rest = rest.unionAll(rows.groupBy("group", "part").applyInArrow(after_group(_search), "a long, b long"))
        ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        similar = similar.unionAll(_similar(materialize(rest.select(*ends).distinct(), "further_pairs"), first, docs))

    gone = similar.select(F.col("later").alias("node")).distinct().withColumn("_gone", F.lit(True))
    judged = first.select("node", F.struct("_id", "_hash", "line").alias("_first")).join(gone, "node", "left")
    by_class = measure_size(judged, "judged_lines")
    marked = sized_join(lines.select("_id", "_hash", "line", "node"), by_class, ["node"], ["_id", "_hash", "line"], "inner")
    later = F.coalesce(F.col("_gone"), F.lit(False)) | (F.struct("_id", "_hash", "line") != F.col("_first"))
    # A text's own lines.
    removed = marked.where(later).groupBy("_id", "_hash").agg(F.collect_set("line").alias("_lines"))
    again = lines.groupBy("_id", "_hash", "line").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return measure_size(removed, "removed_lines"), measure_size(again.select("_id", "_hash").distinct(), "repeated_texts")


def _keep(lines: Column, gone: Callable[[Column, Column], Column]) -> Column:
    return F.array_join(F.filter(lines, lambda line, i: ~gone(line, i)), "\n")


def dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without later matches: columns as they are, ``text`` of the lines that stay, ``n_removed``.

    Lines end at line feeds; words are as elsewhere, A-Z lowered. Lines without words stay. Null and
    empty texts stay as they are, a text of which all lines go becomes empty. Rows with a null doc_id
    come first; rows that repeat a doc_id follow one another by a hash of their texts, and of rows that
    repeat the text too, any one comes first. A column named n_removed is replaced; names with a leading
    underscore are for internal use.
    """
    ship(docs.sparkSession)
    docs = docs.drop("n_removed")
    least = F.lit(-(1 << 63)).cast("bigint")
    keyed = docs.withColumns(
        {"_id": F.coalesce(F.col("doc_id").cast("bigint"), least), "_hash": F.xxhash64(F.col("text").cast("string"))}
    )
    key = ["_id", "_hash"]
    listed, repeated = later_matches(keyed.select(*key, F.col("text").cast("string").alias("text")))
    joined = sized_join(keyed, listed, key, key, "left")
    lines = F.split("text", "\n", -1)
    text = _keep(lines, lambda line, i: F.array_contains("_lines", i.cast("bigint")))
    none = F.col("_lines").isNull()
    cut = joined.withColumns(
        {"text": F.when(none, F.col("text")).otherwise(text), "n_removed": F.when(none, 0).otherwise(F.size("_lines"))}
    ).drop("_lines")
    if repeated.measures["bytes"]:
        copies = sized_join(cut, repeated, key, key, "left_semi").withColumn("_copy", F.monotonically_increasing_id())
        copies = materialize(copies, "repeated_rows")
        chosen = measure_size(copies.groupBy(*key).agg(F.min("_copy").alias("_first")), "first_copies")
        judged = sized_join(copies, chosen, key, ["_copy"], "inner")
        later = F.col("_copy") != F.col("_first")
        n_words = F.size(F.filter(lines, lambda line: line.rlike(_WORD)))
        judged = judged.withColumns(
            {
                "n_removed": F.when(later, F.col("n_removed") + n_words).otherwise(F.col("n_removed")),
                "text": F.when(later, _keep(lines, lambda line, i: line.rlike(_WORD))).otherwise(F.col("text")),
            }
        )
        cut = sized_join(cut, repeated, key, key, "left_anti").unionByName(judged.select(*cut.columns))
    return cut.select(*docs.columns, "n_removed")
