"""Each stage on its own input against a brute-force version, and the whole run."""

from collections import Counter

import pytest

import corpus_pipeline
from compare import duck
from ledgerlens.llm import quality
from ledgerlens.llm.oracle import MIX_SOURCES
from ledgerlens.operators.shared import materialize
from test_decontaminate import brute as leaks
from test_ngram_join import brute as near

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the outputs of all stages."""
    tables = [spark.read.parquet(f"{FOLDER}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], FOLDER), "tested_stage"))
    return tables


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns(stages):
    for table in stages[:-1]:
        assert table.columns == stages[0].columns
    assert stages[-1].columns == [*stages[0].columns, "shard", "slot"]


def test_quality(spark, stages):
    expected = [r["doc_id"] for r in quality.classify(stages[0]).where("keep").collect()]
    assert sorted(i for i, _ in pairs(stages[1])) == sorted(expected)
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = {r["doc_id"] for r in stages[1].collect()}
    clean = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(clean & kept) > 0.98 * len(clean)


def brute_near(docs):
    import test_ngram_join

    plain = test_ngram_join.shingle_set
    try:
        test_ngram_join.shingle_set = lambda text: plain(text, 5)
        return near(docs, 80, 100)
    finally:
        test_ngram_join.shingle_set = plain


def test_near_duplicates(stages):
    expected = sorted(i for i, n, c in brute_near(pairs(stages[1])) if n == 0 or i == c)
    assert sorted(i for i, _ in pairs(stages[2])) == expected


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    docs = pairs(stages[2])
    found = {i for i, _ in leaks(docs, items)}
    assert found and sorted(i for i, _ in pairs(stages[3])) == sorted({i for i, _ in docs} - found)


def test_mixing(stages, tmp_path):
    stages[3].write.parquet(f"{tmp_path}/documents.parquet")
    connection = duck(str(tmp_path / "none"))
    connection.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = Counter(r[0] for r in connection.execute(f"select doc_id from ({MIX_SOURCES})").fetchall())
    assert Counter(i for i, _ in pairs(stages[4])) == expected


def test_shards(stages):
    rows = stages[5].collect()
    assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter(pairs(stages[4]))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_run_gives_the_same(spark, stages):
    assert sorted(pairs(corpus_pipeline.run(spark, FOLDER))) == sorted(pairs(stages[5]))


def test_awkward_rows_go_through(spark, tmp_path):
    text = "some words that make a document of a reasonable length which nobody would reject out of hand I hope"
    rows = [(None, text, None, None, None), (1, text, "en", "a", 9), (1, text, "en", "a", 9), (1, text + " too", "en", "b", 9),
            (2, None, "en", "a", 0), (3, "", "en", "a", 0), (4, "long " + text * 3000, "en", "b", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "a b c d e f g")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    kept = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).collect()
    assert Counter(r["doc_id"] for r in kept) == {None: 1, 1: 1, 2: 1, 3: 1, 4: 1}
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[-2:] == ["shard", "slot"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.collect() == []
