"""The permutation, row numbers and shards on small tables."""

import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import sharding

SCHEMA = "doc_id long, text string, shard string, _x int"


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 1000])
def test_permutation_and_its_inverse(spark, n):
    there = sharding.permuted(spark.range(n), "id", n, "to", seed=3)
    rows = sharding.permuted(there, "to", n, "back", seed=3, inverse=True).collect()
    assert sorted(r["to"] for r in rows) == list(range(n))
    assert all(r["back"] == r["id"] for r in rows)
    if n >= 97:
        assert sum(r["to"] == r["id"] for r in rows) < 12


def test_seeds_differ(spark):
    places = [
        [r["to"] for r in sharding.permuted(spark.range(100), "id", 100, "to", seed=s).orderBy("id").collect()]
        for s in (1, 2)
    ]
    assert places[0] != places[1]


def test_rows_law_and_slots(spark):
    rows = [(i % 40, "same" if i % 3 else f"text {i}", "clash", i) for i in range(203)] + [(None, None, None, None)]
    sharded = sharding.shard(spark.createDataFrame(rows, SCHEMA), ["doc_id", "text"], shards=8).collect()
    slots = {}
    for r in sharded:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len(sharded) == 204 and sorted(slots) == list(range(8))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_partitions_do_not_matter(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"))
    one, many = ({tuple(r) for r in sharding.shard(df.repartition(k, F.rand(k)), ["doc_id"]).collect()} for k in (1, 13))
    assert one == many


def test_empty_and_fewer_rows_than_shards(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.shard(empty, ["doc_id"]).collect() == []
    three = sharding.shard(spark.range(3), ["id"], shards=8).collect()
    assert len({r["shard"] for r in three}) == 3 and {r["slot"] for r in three} == {0}


def test_digest(spark):
    texts = [(1, "é\n", "", 0), (2, None, "", 0), (3, "", "", 0), (4, "x" * 300_000, "", 0)]
    rows = {r["doc_id"]: r for r in sharding.document_digest(spark.createDataFrame(texts, SCHEMA)).collect()}
    for doc_id, text, *_ in texts:
        data = (text or "").encode()
        assert (rows[doc_id]["size"], rows[doc_id]["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
