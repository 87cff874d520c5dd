"""Recall against all pairs, and the rules of the result."""

import numpy as np
import pytest

from ledgerlens.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, score string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "clash") for i, v in vectors], SCHEMA)


def brute(vectors, queries, k):
    ids = np.array([i for i, _ in vectors])
    points = np.array([v for _, v in vectors], np.float32).astype(np.float64)
    found = {}
    for i, v in queries:
        product = points @ np.array(v, np.float32).astype(np.float64)
        order = [j for j in np.lexsort((ids, -product.round(12))) if ids[j] != i][:k]
        found[i] = [(int(ids[j]), product[j]) for j in order]
    return found


def rows_of(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(got, expected):
    hits = sum(len({v for v, _ in got.get(q, [])} & {v for v, _ in e}) for q, e in expected.items())
    return hits / sum(len(e) for e in expected.values())


@pytest.mark.parametrize("lengths", [(1.0, 1.0), (0.1, 3.0)])
def test_recall(spark, lengths, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_ROWS", 700)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 60)
    random = np.random.default_rng(5)
    points = random.normal(size=(2000, 24)) * random.uniform(*lengths, size=(2000, 1))
    vectors = [(int(i), p.tolist()) for i, p in enumerate(points)]
    queries = vectors[::20]
    df = frame(spark, vectors)
    got = rows_of(neighbours.search(df, frame(spark, queries), k=20, index=neighbours.build(df, 700)))
    expected = brute(vectors, queries, 20)
    assert recall(got, expected) >= 0.95
    for q, rows in got.items():
        assert len(rows) == 20 and q not in {v for v, _ in rows}
        assert all(a[1] > b[1] or (a[1] == b[1] and a[0] < b[0]) for a, b in zip(rows, rows[1:], strict=False))
        known = dict(brute(vectors, [(q, vectors[q][1])], 2000)[q])
        assert all(abs(known[v] - s) < 1e-9 for v, s in rows)


def test_given_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    queries = [(i, v) for i, v in vectors if i % 20 == 0]
    got = rows_of(neighbours.search(table, table.where("vec_id % 20 = 0")))
    assert recall(got, brute(vectors, queries, 20)) >= 0.9


def test_equal_vectors(spark):
    vectors = [(i, [1.0, 0.0]) for i in range(300)] + [(1000, [0.0, 1.0])]
    got = rows_of(neighbours.search(frame(spark, vectors), frame(spark, [vectors[5], (1000, [0.0, 1.0])]), k=20))
    assert [v for v, _ in got[5]] == [i for i in range(21) if i != 5]
    assert [v for v, _ in got[1000]] == list(range(20))


def test_unusable_vectors_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [None, 1.0]), (6, [inf, 1.0]),
               (7, [2.0, 1.0]), (8, [1.0, 1.0, 1.0]), (9, []), (None, [1.0, 1.0]), (7, [2.0, 1.0])]
    df = frame(spark, vectors)
    assert rows_of(neighbours.search(df, df)) == {1: [(7, 4.0)], 7: [(1, 4.0)]}
    assert neighbours.search(df.limit(0), df).collect() == []
    assert neighbours.search(df, df.limit(0)).collect() == []


@pytest.mark.parametrize("norm", [1e4, 1e25])
def test_a_few_long_vectors(spark, norm):
    random = np.random.default_rng(6)
    points = random.normal(size=(2000, 64))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points[[3, 700, 1500]] *= norm
    vectors = [(int(i), p.tolist()) for i, p in enumerate(points)]
    queries = vectors[::40] + [vectors[3]]
    df = frame(spark, vectors)
    got = rows_of(neighbours.search(df, frame(spark, queries), k=20))
    assert all(len(rows) == 20 for rows in got.values())
    assert recall(got, brute(vectors, queries, 20)) >= 0.9
