"""Nearest neighbours by inner product, through robust-pruned directed graphs, one for each shard.

Equal vectors are indexed once. The distinct ones are dealt to shards by length (of a shard the longest
is at most NORM_RATIO times the shortest, so no long one swallows the others' distances) and by hash; a shard's task builds
its graph: points enter in growing batches, a greedy search from the entry point proposes neighbours,
pruning keeps a proposal unless a kept one is closer to it by the factor ALPHA, and edges are added
both ways. The graphs are written. Each block of queries is searched with a beam in every shard, and
the shards' best are merged.

The greatest inner product is the least distance once each vector has an extra coordinate that lifts
all of a shard to the same length; queries have 0 there. A shard's points and each query are scaled to
components up to 1, so nothing overflows. Scores are recomputed in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.shipping import ship
from ledgerlens.operators.shared import materialize, measure

DEGREE, BEAM, ALPHA = 32, 96, 1.2
# Vectors in a shard, on average: bounds a task's memory, whatever the size of the table.
SHARD_ROWS = 6000
# Lengths in a shard; the bands' borders are 1/4, 4, 64 and so on, so that unit vectors are in the midst of one.
NORM_RATIO = 16
# Queries in a block, on average, of which a shard's task searches QUERY_ROWS at a time.
QUERY_BLOCK = 20_000
QUERY_ROWS = 512


def _merge(ids: np.ndarray, far: np.ndarray, seen: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row the ``keep`` nearest of the candidates, each once; -1 fills up."""
    order = np.argsort(ids * 2 + ~seen, axis=1, kind="stable")  # of equal ids, a seen one first
    ids, far, seen = (np.take_along_axis(x, order, 1) for x in (ids, far, seen))
    again = np.zeros(ids.shape, bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    far = np.where(again | (ids < 0), np.inf, far)
    ids = np.where(again, -1, ids)
    order = np.argsort(far, axis=1, kind="stable")[:, :keep]
    return tuple(np.take_along_axis(x, order, 1) for x in (ids, far, seen))


def _scaled(points: np.ndarray) -> np.ndarray:
    return points / np.abs(points).max(initial=np.finfo(np.float64).tiny)


class Graph:
    """A searchable graph over the rows of ``points``, built here unless its edges and entry are given."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, entry: int = 0):
        points = _scaled(points)
        top = float((points * points).sum(axis=1).max(initial=0.0))
        lift = np.sqrt(np.maximum(top - (points * points).sum(axis=1), 0.0))
        self.points = np.concatenate([points, lift[:, None]], axis=1).astype(np.float32)
        self.square = np.float32(top)  # of every lifted point's length
        if edges is not None:
            self.edges, self.entry = edges, entry
            return
        n = len(points)
        self.edges = np.full((n, DEGREE), -1, np.int64)
        self.entry = int(((self.points - self.points.mean(axis=0)) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[self.entry], order[order != self.entry]])
        for alpha in (1.0, ALPHA):
            done, size = 1, 1
            while done < n:
                self._insert(order[done : done + size], alpha)
                done, size = done + size, min(size * 2, max(64, n // 16))

    def _order(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Ascends with the distance, without the part all points share."""
        return -np.matmul(self.points[ids], queries[:, :, None])[:, :, 0]

    def _far(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances; of a query, up to its own length, which is the same for all points."""
        return 2 * (self.square - np.matmul(self.points[ids], queries[:, :, None])[:, :, 0])

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam of nearest points found and all points visited, per (lifted) query; -1 fills up."""
        rows = len(queries)
        ids = np.full((rows, beam), -1, np.int64)
        far = np.full((rows, beam), np.inf, np.float32)
        seen = np.zeros((rows, beam), bool)
        ids[:, 0] = self.entry
        far[:, 0] = self._order(queries, ids[:, :1])[:, 0]
        visited = []
        active = np.arange(rows)
        while len(active):
            open_ = np.where(seen[active] | (ids[active] < 0), np.inf, far[active])
            best = open_.argmin(axis=1)
            going = np.isfinite(open_[np.arange(len(active)), best])
            active, best = active[going], best[going]
            if not len(active):
                break
            seen[active, best] = True
            at = ids[active, best]
            column = np.full(rows, -1, np.int64)
            column[active] = at
            visited.append(column)
            near = self.edges[at]
            distance = np.where(near >= 0, self._order(queries[active], near), np.inf)
            ids[active], far[active], seen[active] = _merge(
                np.concatenate([ids[active], near], axis=1),
                np.concatenate([far[active], distance], axis=1).astype(np.float32),
                np.concatenate([seen[active], np.zeros(near.shape, bool)], axis=1),
                beam,
            )
        return ids, np.stack(visited, axis=1) if visited else ids[:, :0]

    def _prune(self, nodes: np.ndarray, proposals: np.ndarray, alpha: float) -> None:
        """Set the edges of ``nodes``: nearest proposals first, without those that a kept one covers."""
        proposals = np.where(proposals == nodes[:, None], -1, proposals)
        far = np.where(proposals >= 0, self._far(self.points[nodes], proposals), np.inf).astype(np.float32)
        proposals, far, _ = _merge(proposals, far, np.zeros(far.shape, bool), min(far.shape[1], 3 * DEGREE))
        there = self.points[proposals]
        left, rows = far.copy(), np.arange(len(nodes))
        kept = np.full((len(nodes), DEGREE), -1, np.int64)
        for slot in range(DEGREE):
            best = left.argmin(axis=1)
            some = np.isfinite(left[rows, best])
            if not some.any():
                break
            kept[some, slot] = proposals[rows[some], best[some]]
            between = 2 * (self.square - np.matmul(there, there[rows, best][:, :, None])[:, :, 0])
            left = np.where(some[:, None] & (alpha * alpha * between <= far), np.inf, left)
            left[rows, best] = np.inf
        self.edges[nodes] = kept

    def _insert(self, nodes: np.ndarray, alpha: float) -> None:
        for start in range(0, len(nodes), 512):
            some = nodes[start : start + 512]
            beam, visited = self.search(self.points[some], 2 * DEGREE)
            self._prune(some, np.concatenate([beam, visited[:, : 3 * DEGREE], self.edges[some]], axis=1), alpha)
        target = self.edges[nodes]
        source = np.repeat(nodes, DEGREE)[target.ravel() >= 0]
        target = target.ravel()[target.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        to, first, n = np.unique(target, return_index=True, return_counts=True)
        for start in range(0, len(to), 512):
            block = slice(start, start + 512)
            wide = int(n[block].max())
            back = np.full((len(to[block]), wide), -1, np.int64)
            cells = np.arange(wide) < n[block][:, None]
            back[cells] = source[first[block][0] : first[block][-1] + n[block][-1]]
            both = np.concatenate([self.edges[to[block]], back], axis=1)
            # Those with room take all; only the others are pruned.
            repeats = np.sort(both, axis=1)
            size = (repeats >= 0).sum(axis=1) - ((repeats[:, 1:] == repeats[:, :-1]) & (repeats[:, 1:] >= 0)).sum(axis=1)
            full = size > DEGREE
            if full.any():
                self._prune(to[block][full], both[full], alpha)
            if (~full).any():
                zero = np.zeros(both[~full].shape)
                packed, _, _ = _merge(both[~full], zero, zero.astype(bool), DEGREE)
                self.edges[to[block][~full]] = packed

    def nearest(self, queries: np.ndarray, beam: int) -> np.ndarray:
        scaled = queries / np.abs(queries).max(axis=1, keepdims=True, initial=np.finfo(np.float64).tiny)
        lifted = np.concatenate([scaled, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        return self.search(lifted, min(beam, max(len(self.points), 1)))[0]


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not all zero, every component finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def norm_band(vector: Column) -> Column:
    """Number of the band of lengths that a usable vector is in."""
    sizes = F.transform(vector, lambda x: F.abs(x.cast("double")))
    most = F.array_max(sizes)
    squares = F.aggregate(sizes, F.lit(0.0), lambda total, x: total + (x / most) * (x / most))
    return F.floor((F.log2(most) + F.log2(squares) / 2) / F.log2(F.lit(float(NORM_RATIO))) + 0.5).cast("int")


def inner_product(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def _matrix(table: pa.Table, column: str, dtype: type) -> np.ndarray:
    flat = table.column(column).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(table.num_rows, -1).astype(dtype)


def _build(_: tuple, table: pa.Table) -> pa.Table:
    table = table.sort_by("vec_id")
    points = _matrix(table, "embedding", np.float64)
    graph = Graph(points)
    edges = pa.FixedSizeListArray.from_arrays(pa.array(graph.edges.astype(np.int32).ravel()), DEGREE).cast(pa.list_(pa.int32()))
    place = np.arange(table.num_rows)
    return table.select(["length", "shard", "vec_id", "embedding"]).append_column("place", pa.array(place)).append_column(
        "edges", edges
    ).append_column("entry", pa.array(place == graph.entry))


def build(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written graphs over the distinct usable vectors; vec_id is the least of equal vectors."""
    ship(vectors.sparkSession)
    distinct = _usable_rows(vectors).groupBy("embedding").agg(F.min("vec_id").alias("vec_id"))
    distinct = materialize(distinct.withColumn("band", norm_band(F.col("embedding"))), "distinct_vectors")
    # A few hundred bands at most, as doubles have 2,100 powers of two.
    first, places = 0, []
    for r in sorted(distinct.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).collect()):
        shards = max(1, round(r["rows"] / shard_rows))
        places.append((r["band"], first, shards))
        first += shards
    bands = vectors.sparkSession.createDataFrame(places, "band int, first int, shards int")
    shard = F.col("first") + F.pmod(F.xxhash64("embedding"), F.col("shards")).cast("int")
    points = distinct.join(F.broadcast(bands), "band").select(F.size("embedding").alias("length"), shard.alias("shard"), "vec_id", "embedding")
    kind = vectors.schema["embedding"].dataType.simpleString()
    schema = f"length int, shard int, vec_id long, embedding {kind}, place long, edges array<int>, entry boolean"
    return materialize(points.groupBy("length", "shard").applyInArrow(_build, schema), "graphs")


def _usable_rows(vectors: DataFrame) -> DataFrame:
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return rows.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = BEAM, index: DataFrame | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest rows of ``vectors`` found for each query.

    Both tables have vec_id and embedding, ``index`` is what ``build`` returned for ``vectors``. A
    query's own id is left out of its result, ties go to the smaller vec_id, and a query has fewer rows
    if there are fewer candidates. Null vectors, zero vectors and vectors with null or non-finite
    components take no part, nor do null ids; a query meets vectors of its own length only. Rows that
    repeat an id and its vector count once. Every usable row can be found: of equal vectors, one
    enters the graph and stands for the k + 1 with the smallest ids, of which no result has more.
    """
    index = build(vectors) if index is None else index
    ship(vectors.sparkSession)
    # The window keeps k + 1 rows of each vector before the shuffle already, however often it occurs.
    same = Window.partitionBy("embedding").orderBy("vec_id")
    few = _usable_rows(vectors).distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    kept = few.select(F.min("vec_id").over(Window.partitionBy("embedding")).alias("_class"), "vec_id", "embedding")
    asked = measure(_usable_rows(queries).distinct(), "queries", rows=F.count(F.lit(1)))
    blocks = max(1, -(-asked.measures["rows"] // QUERY_BLOCK))
    kind = vectors.schema["embedding"].dataType
    last_shard = index.agg(F.max("shard")).first()[0] or 0
    graphs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    sent = asked.table.select(
        F.size("embedding").alias("length"),
        F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(last_shard))).alias("shard"),
        "vec_id",
        F.col("embedding").cast(kind).alias("embedding"),
    )

    def look(_: tuple, graph: pa.Table, asked: pa.Table) -> pa.Table:
        names = ["query_id", "_class", "_about"]
        found_rows = [pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64())], names)]
        if graph.num_rows and asked.num_rows:
            graph = graph.sort_by("place")
            points, ids = _matrix(graph, "embedding", np.float64), graph.column("vec_id").to_numpy()
            entry = int(np.flatnonzero(graph.column("entry").to_numpy())[0])
            searched = Graph(points, _matrix(graph, "edges", np.int64), entry)
            for start in range(0, asked.num_rows, QUERY_ROWS):
                some = asked.slice(start, QUERY_ROWS)
                vectors, query_ids = _matrix(some, "embedding", np.float64), some.column("vec_id").to_numpy()
                found = searched.nearest(vectors, max(beam, 2 * k))
                product = np.where(found >= 0, np.einsum("qd,qnd->qn", vectors, points[found]), -np.inf)
                best = np.argsort(-product, axis=1, kind="stable")[:, : k + 1]
                found, product = np.take_along_axis(found, best, 1), np.take_along_axis(product, best, 1)
                rows, columns = np.nonzero(found >= 0)
                values = (query_ids[rows], ids[found[rows, columns]], product[rows, columns])
                found_rows.append(pa.table([pa.array(v) for v in values], names))
        return pa.concat_tables(found_rows)

    keys = ("length", "shard", "block")
    # Under new names, as both sides may stem from one table.
    graphs, sent = graphs.toDF(*graphs.columns), sent.toDF(*sent.columns)
    found = graphs.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(look, "query_id long, _class long, _about double")
    # k + 1 classes of a query hold its k nearest, its own row being at most one of them.
    by_query = Window.partitionBy("query_id")
    nearest = F.row_number().over(by_query.orderBy(F.desc("_about"), "_class"))
    classes = found.withColumn("_r", nearest).where(F.col("_r") <= k + 1).select("query_id", "_class")
    pairs = classes.join(kept, "_class").where("vec_id <> query_id")
    scored = pairs.join(asked.table.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("_query")), "query_id").select(
        "query_id", "vec_id", inner_product(F.col("_query"), F.col("embedding")).alias("score")
    )
    rank = F.row_number().over(by_query.orderBy(F.desc("score"), "vec_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
