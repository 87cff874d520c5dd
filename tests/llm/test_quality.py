"""Votes, the weak-label model, and accuracy against labels that no training sees."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerlens.llm import quality

FOLDER = "/root/testdata/sf0.01"
PROSE = "The quick brown fox went over the hill and then came back to see what was left of its dinner there. "


def votes(text):
    return dict(zip(quality.LABELLERS, quality._Texts(pa.array([text])).votes()[0], strict=True))


def test_votes():
    assert set(votes(PROSE).values()) <= {quality.GOOD, quality.ABSTAIN}
    assert votes("spam " * 40)["repeated_next"] == quality.BAD
    assert votes("a b c d e f g h " * 20)["repeated_any"] == quality.BAD
    assert votes(PROSE.upper())["shouting"] == quality.BAD
    assert votes("| word " * 30)["wordless"] == quality.BAD
    assert votes("one### two$$$ three%%%")["decorated"] == quality.BAD
    assert set(votes("").values()) == {quality.ABSTAIN}


def test_rows_do_not_mix():
    texts = [PROSE, None, "spam " * 40, "", "x", PROSE]
    together = quality._Texts(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        alone = quality._Texts(pa.array([text], pa.string()))
        assert (together.measures[i] == alone.measures[0]).all()


def test_em_recovers_accuracies():
    random = np.random.default_rng(1)
    good = random.random(20_000) < 0.85
    cast = np.where(random.random((20_000, 7)) < np.where(good, 0.02, 0.6)[:, None], quality.BAD, quality.GOOD)
    counts = np.bincount(cast @ 3 ** np.arange(7), minlength=quality.PATTERNS)
    fitted, prior = quality.fit_labellers(counts)
    assert abs(prior[1] - 0.85) < 0.03
    found = quality.posteriors(fitted, prior)[cast @ 3 ** np.arange(7)] > 0.5
    assert (found == good).mean() > 0.97


def test_against_labels(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = quality.classify(docs).join(labels, "doc_id").collect()
    good = [r["keep"] for r in rows if r["quality"] == 1]
    bad = [r["keep"] for r in rows if r["quality"] == 0]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_awkward_rows(spark):
    rows = [(None, None, 1.0), (1, "", 2.0), (2, "spam " * 100_000, 3.0), (3, PROSE * 3, 4.0), (3, PROSE * 3, 4.0)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = quality.classify(docs).collect()
    assert len(found) == len(rows)
    assert all(not r["keep"] for r in found if r["doc_id"] in (None, 1))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} <= {2, 3}
    assert quality.classify(docs.limit(0)).collect() == [] and quality.keep_good(docs.limit(0)).collect() == []


def test_one_table_gives_one_model(spark):
    """However the rows are dealt out and ordered."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    results = []
    for parts, order in ((1, F.col("doc_id")), (7, F.desc("doc_id"))):
        dealt = docs.repartition(parts, F.xxhash64("doc_id")).sortWithinPartitions(order)
        rows = quality.classify(dealt).select("doc_id", "posterior", "score", "keep").collect()
        results.append(sorted(map(tuple, rows)))
    assert results[0] == results[1]
