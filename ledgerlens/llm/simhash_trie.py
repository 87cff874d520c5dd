"""SimHash near-duplicates by a self-join of a binary trie.

The fingerprints of all documents form one binary trie, a level per bit. The join starts with the pair
(root, root) and goes down both sides together: a pair of nodes becomes the pairs of their children, each
with the bits that differ so far, and a pair beyond the radius is dropped with all that lies below it.

Spark walks the upper part of the trie, STEP bits at a time, until a node holds at most LEAF fingerprints.
The pairs of such leaf nodes are the units of work: each task gets the sorted fingerprints of both nodes
and walks the rest of the way in numpy. A crowded region only makes the trie deeper there. Of the links
found in a batch a spanning forest leaves the task, so that a dense group of m fingerprints gives fewer
than m rows a batch and not its m^2 pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.components import components
from ledgerlens.llm.shipping import ship
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, materialize, measure, measure_size

# How a fingerprint is made.
WORDS, SEED, BITS = 3, 42, 64
BLANKS = b" \t\n\x0b\x0c\r"

# The trie in Spark: bits per round, and fingerprints of a node that need no further cut.
STEP, LEAF = 4, 2048
PAIRS_PER_TASK = 128
# The trie in a task: text and shingles at a time, fingerprints at a time, node pairs at a time, and node
# pairs of so few fingerprint pairs that these are compared at once.
PIECE_BYTES, VOTES = 1 << 20, 1 << 16
GROUP, FRONTIER, DIRECT = 1 << 18, 1 << 19, 16


# Fingerprints


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in pieces that repeat the last words of the piece before."""
    carried: list[bytes] = []
    start, whole = 0, True
    while start < len(text):
        end = start + PIECE_BYTES
        while end < len(text) and text[end] not in BLANKS:
            end += 1
        words = carried + text[start:end].lower().split()
        # A piece with too few words is carried whole: the next one completes its shingle.
        if len(words) >= WORDS:
            yield words
            carried, whole = words[1 - WORDS :], False
        else:
            carried = words
        start = end
    if whole and carried:
        yield carried


def shingle_hashes(words: list[bytes]) -> list[int]:
    """XXH64 of each run of three words, or of all words if they are fewer."""
    h = xxhash.xxh64_intdigest
    if len(words) < WORDS:
        return [h(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    return [h(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[WORDS - 1 :], strict=False)]


def _votes(hashes: list[int], starts: list[int]) -> np.ndarray:
    """How often each bit, highest first, is set in the hashes from one start to the next."""
    bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, starts, axis=0, dtype=np.int64)


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        votes, counts = np.zeros((rows, BITS), np.int64), np.zeros(rows, np.int64)
        hashes: list[int] = []
        starts: list[int] = []
        owners: list[int] = []

        def count() -> None:
            if hashes:
                # One text may come in several pieces, but no two of them lie in the same call.
                votes[owners] += _votes(hashes, starts)
                counts[owners] += np.diff([*starts, len(hashes)])
                hashes.clear(), starts.clear(), owners.clear()

        column = batch.column("text").cast(pa.large_binary())
        for row in range(rows):
            text = column[row].as_py() or b""
            for words in _pieces(text):
                found = shingle_hashes(words)
                if len(hashes) + len(found) > VOTES or (owners and owners[-1] == row):
                    count()
                starts.append(len(hashes))
                owners.append(row)
                hashes += found
        count()
        packed = np.packbits(2 * votes > counts[:, None], axis=1).view(">u8").reshape(rows)
        prints = pa.array(packed.astype(np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), prints], ["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as a signed long) of every row."""
    ship(docs.sparkSession)
    of = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, f"doc_id {of}, fingerprint long")


# The trie in a task


def _joined(frontier: list[list[np.ndarray]]) -> list[np.ndarray]:
    return [np.concatenate(parts) for parts in zip(*frontier, strict=True)]


def _compared(values: np.ndarray, nodes: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All links between the fingerprints of small node pairs."""
    a, a_end, b, b_end, _ = nodes
    width = b_end - b
    n = (a_end - a) * width
    pair = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = a[pair] + place // width[pair], b[pair] + place % width[pair]
    near = np.bitwise_count(values[i] ^ values[j]) <= radius
    near &= (a[pair] != b[pair]) | (i < j)
    return i[near], j[near]


def trie_links(
    values: np.ndarray, starts: dict[int, list[np.ndarray]], radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the linked fingerprints below the given node pairs.

    ``values`` holds sorted blocks of distinct fingerprints. A node is a range of one block; ``starts``
    has by depth the pairs of nodes as (begin, end, begin, end, bits that differ above that depth). Of a
    node and itself each link is given once.
    """
    ones: dict[int, np.ndarray] = {}
    stack = list(starts.items())
    while stack:
        depth, nodes = stack.pop()
        if len(nodes[0]) > FRONTIER:
            half = len(nodes[0]) // 2
            stack += [(depth, [c[:half] for c in nodes]), (depth, [c[half:] for c in nodes])]
            continue
        a, a_end, b, b_end, differ = nodes
        small = (a_end - a) * (b_end - b) <= DIRECT
        if small.any():
            yield _compared(values, [c[small] for c in nodes], radius)
            a, a_end, b, b_end, differ = (c[~small] for c in nodes)
        if not len(a):
            continue
        if depth not in ones:
            ones[depth] = np.zeros(len(values) + 1, np.int32)
            np.cumsum((values >> np.uint64(BITS - 1 - depth)) & np.uint64(1), out=ones[depth][1:])
        at = ones[depth]
        a_cut, b_cut = a_end - (at[a_end] - at[a]), b_end - (at[b_end] - at[b])
        same = a == b
        children = []
        for x, x_end, y, y_end, more, once in (
            (a, a_cut, b, b_cut, 0, None),
            (a_cut, a_end, b_cut, b_end, 0, None),
            (a, a_cut, b_cut, b_end, 1, None),
            (a_cut, a_end, b, b_cut, 1, ~same),
        ):
            keep = (x < x_end) & (y < y_end) & (differ + more <= radius)
            if once is not None:
                keep &= once
            children.append([c[keep] for c in (x, x_end, y, y_end, differ + more)])
        stack.append((depth + 1, _joined(children)))


class Forest:
    """Joins links into trees; every place knows the least place of its tree."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.root[a], self.root[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def _linked(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(pc.list_value_length(batch.column(c)).to_numpy() for c in ("xs", "ys"))
            group = np.cumsum(sizes) // GROUP
            for g in np.unique(group).tolist():
                rows = batch.slice(int(np.searchsorted(group, g)), int((group == g).sum()))
                yield _forest_of(rows, radius)

    return run


def _forest_of(rows: pa.RecordBatch, radius: int) -> pa.RecordBatch:
    """Links that connect what the traversal of these node pairs links."""
    blocks, starts, offset = [], {}, 0
    depths = rows.column("depth").to_pylist()
    itself = rows.column("itself").to_pylist()
    differ = rows.column("differ").to_pylist()
    for i, depth in enumerate(depths):
        ranges = []
        for c in ("xs",) if itself[i] else ("xs", "ys"):
            block = np.sort(rows.column(c)[i].values.to_numpy().view(np.uint64))
            ranges += [offset, offset + len(block)]
            offset += len(block)
            blocks.append(block)
        if itself[i]:
            ranges *= 2
        starts.setdefault(depth, []).append([*ranges, differ[i]])
    values = np.concatenate(blocks)
    known, at = np.unique(values, return_inverse=True)
    forest = Forest(len(known))
    by_depth = {d: list(np.array(nodes, np.int64).T) for d, nodes in starts.items()}
    for i, j in trie_links(values, by_depth, radius):
        forest.add(at[i], at[j])
    members = np.flatnonzero(forest.root != np.arange(len(known)))
    ends = known.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ends[forest.root[members]]), pa.array(ends[members])], ["a", "b"])


# The trie in Spark


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("fingerprint", BITS - depth) if depth else F.lit(0).cast("long")


def _name(depth: Column, prefix: Column) -> Column:
    return F.concat_ws(":", depth.cast("string"), prefix.cast("string"))


def _cut(prints: DataFrame, rows: int) -> tuple[list[Measured], DataFrame]:
    """The trie above its leaf nodes: the nodes of each level, and the fingerprints of every leaf node.

    A level has (parent, prefix, depth, leaf); the level before names the parents. Nodes are cut as long as
    one of them holds more than LEAF fingerprints, which ends at depth 64 as fingerprints are distinct.
    """
    if rows <= LEAF:
        packed = prints.agg(F.collect_list("fingerprint").alias("prints")).select(F.lit("0:0").alias("node"), "prints")
        return [], packed.where("size(prints) > 0")
    levels, leaves, depth, rest = [], [], 0, prints
    while depth < BITS:
        depth += STEP
        counts = rest.groupBy(_prefix(depth).alias("prefix")).agg((F.count(F.lit(1)) <= LEAF).alias("leaf"))
        nodes = counts.select(
            F.shiftrightunsigned("prefix", STEP).alias("parent"), "prefix", F.lit(depth).alias("depth"), "leaf"
        )
        open_ = F.count_if(~F.col("leaf"))
        level = measure(nodes, "trie_level", bytes=F.count(F.lit(1)) * 40, open=open_)
        levels.append(level)
        crowded = Measured(level.table.where("not leaf").select("prefix"), {"bytes": level.measures["open"] * 40})
        at = rest.withColumn("prefix", _prefix(depth))
        members = sized_join(at, crowded, ["prefix"], ["fingerprint"], "left_anti") if level.measures["open"] else at
        # At most LEAF fingerprints each.
        packed = members.groupBy("prefix").agg(F.collect_list("fingerprint").alias("prints"))
        leaves.append(packed.select(_name(F.lit(depth), F.col("prefix")).alias("node"), "prints"))
        if not level.measures["open"]:
            break
        rest = sized_join(at, crowded, ["prefix"], ["fingerprint"], "left_semi").select("fingerprint")
        rest = materialize(rest, "trie_rest")
    packed = leaves[0]
    for more in leaves[1:]:
        packed = packed.unionAll(more)
    return levels, packed


def _differing(radius: int) -> tuple[Column, Column]:
    """Depth that both nodes of a pair have reached, and the bits that differ up to there."""
    depth = F.least("depth_a", "depth_b")

    def top(side: str) -> Column:
        return F.expr(f"shiftrightunsigned(prefix_{side}, depth_{side} - least(depth_a, depth_b))")

    return depth, F.bit_count(top("a").bitwiseXOR(top("b")))


def _node_pairs(spark, levels: list[Measured], radius: int) -> DataFrame:
    """Pairs of leaf nodes within the radius, by going down from (root, root) one level of nodes a round."""
    schema = ", ".join(f"depth_{s} int, prefix_{s} long, leaf_{s} boolean" for s in "ab")
    frontier = spark.createDataFrame([(0, 0, not levels, 0, 0, not levels)], schema)
    done = [frontier] if not levels else []
    for level in levels:
        pairs = frontier.withColumn("same", (F.col("prefix_a") == F.col("prefix_b")) & (F.col("depth_a") == F.col("depth_b")))
        for side, other in (("a", "b"), ("b", "a")):
            children = level.table.toDF("parent", f"child_{side}", f"child_depth_{side}", f"child_leaf_{side}")
            # A leaf node of an earlier level has no parent to look for and stays as it is.
            pairs = pairs.withColumn("parent", F.when(~F.col(f"leaf_{side}"), F.col(f"prefix_{side}")))
            pairs = sized_join(pairs, Measured(children, level.measures), ["parent"], [f"prefix_{other}"]).drop("parent")
        for side in "ab":
            pairs = pairs.withColumns(
                {
                    f"prefix_{side}": F.coalesce(f"child_{side}", f"prefix_{side}"),
                    f"depth_{side}": F.coalesce(f"child_depth_{side}", f"depth_{side}"),
                    f"leaf_{side}": F.coalesce(f"child_leaf_{side}", f"leaf_{side}"),
                }
            ).drop(f"child_{side}", f"child_depth_{side}", f"child_leaf_{side}")
        pairs = pairs.where(~F.col("same") | (F.col("prefix_a") <= F.col("prefix_b"))).drop("same")
        pairs = materialize(pairs.where(_differing(radius)[1] <= radius), "trie_pairs")
        finished = F.col("leaf_a") & F.col("leaf_b")
        done.append(pairs.where(finished))
        frontier = pairs.where(~finished)
    found = done[0]
    for more in done[1:]:
        found = found.unionAll(more)
    depth, differ = _differing(radius)
    return found.select(
        _name(F.col("depth_a"), F.col("prefix_a")).alias("node_a"),
        _name(F.col("depth_b"), F.col("prefix_b")).alias("node_b"),
        depth.alias("depth"),
        differ.alias("differ"),
    )


def links(prints: DataFrame, rows: int, radius: int = 2) -> DataFrame:
    """(a, b) that connect all of the ``rows`` distinct fingerprints within ``radius`` bits of each other."""
    spark = prints.sparkSession
    levels, packed = _cut(prints, rows)
    nodes = measure_size(packed, "trie_leaves")
    pairs = measure(_node_pairs(spark, levels, radius), "trie_leaf_pairs", rows=F.count(F.lit(1)))
    tasks = max(spark.sparkContext.defaultParallelism, -(-pairs.measures["rows"] // PAIRS_PER_TASK))
    work = pairs.table.repartition(tasks)
    a = Measured(nodes.table.toDF("node_a", "xs"), nodes.measures)
    b = Measured(nodes.table.toDF("node_b", "ys"), nodes.measures)
    work = sized_join(work, a, ["node_a"], ["node_b"], "inner")
    work = sized_join(work, b, ["node_b"], ["node_a"], "inner")
    ship(spark)
    work = work.select("depth", F.col("differ").cast("int"), (F.col("node_a") == F.col("node_b")).alias("itself"), "xs", "ys")
    return work.mapInArrow(_linked(radius), "a long, b long")


# Documents


def near_duplicates(docs: DataFrame, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text).

    A-Z are lowered and words are runs of anything but ASCII blanks. The fingerprint, 16 hex digits, has
    those bits that are set in more than half of the XXH64 hashes (seed 42) of the text's 3-word shingles,
    repeats included; fewer words are one shingle, and a null text or one without words has fingerprint
    zero, which links like any other. Rows link if their fingerprints differ in at most ``radius`` bits,
    and ``component_id`` is the least doc_id reachable by links. Repeated rows and equal ids each give a
    row. A null doc_id is never the least: such a row has the least id among those it reaches, or null.
    Other columns of ``docs`` are not read; an empty table gives an empty result.
    """
    of = docs.schema["doc_id"].dataType.simpleString()
    rows = materialize(fingerprints(docs), "simhash")
    classes = measure(
        rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least"), (F.count(F.lit(1)) > 1).alias("several")),
        "simhash_classes",
        rows=F.count(F.lit(1)),
    )
    found = materialize(links(classes.table.select("fingerprint"), classes.measures["rows"], radius), "simhash_links")
    linked = measure_size(components(found).toDF("fingerprint", "component"), "simhash_components")
    # Fingerprints of one row without links need no look-up: their component is the row itself.
    members = sized_join(classes.table, linked, ["fingerprint"], ["fingerprint"])
    members = members.where(F.col("several") | F.col("component").isNotNull())
    members = members.select("fingerprint", F.coalesce("component", "fingerprint").alias("component"), "least")
    members = materialize(members, "simhash_members")
    least = measure_size(members.groupBy("component").agg(F.min("least").alias("component_id")), "simhash_least")
    named = sized_join(members.select("fingerprint", "component"), least, ["component"], ["fingerprint"], "inner")
    named = measure_size(named.select("fingerprint", "component_id"), "simhash_named")
    joined = sized_join(rows, named, ["fingerprint"], ["doc_id"])
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").cast(of).alias("component_id"),
    )
