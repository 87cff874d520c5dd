"""Scores against counters in plain Python."""

import math
import random
import re
import weakref
from collections import Counter

import pyarrow as pa
import pytest

from ledgerlens.llm import lm_score

FOLDER = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, n_words string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs):
    texts = [(i, words(t)) for i, t in docs]
    single = Counter(w for _, t in texts for w in t)
    pairs = Counter(p for _, t in texts for p in zip(t, t[1:], strict=False))
    begins = Counter()
    for (v, _), n in pairs.items():
        begins[v] += n
    total = sum(single.values())
    result = []
    for i, t in texts:
        score, off = (math.log(single[t[0]] / total) if t else None), 0
        for v, w in zip(t, t[1:], strict=False):
            if pairs[v, w] >= 2:
                score += math.log(pairs[v, w] / begins[v])
            else:
                score += math.log(0.4 * single[w] / total)
                off += 1
        result.append((i, len(t), off, score, score / len(t) if t else None))
    return result


def check(spark, docs):
    got = lm_score.score(spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA)).collect()
    key = lambda r: tuple((x is None, round(x, 6) if isinstance(x, float) else x or 0) for x in r)
    got, expected = sorted((tuple(r) for r in got), key=key), sorted(brute(docs), key=key)
    assert len(got) == len(expected)
    for g, e in zip(got, expected, strict=True):
        assert g[:3] == e[:3] and g[3:] == (pytest.approx(e[3], abs=1e-6), pytest.approx(e[4], abs=1e-6))


def test_whole_table(spark):
    check(spark, [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()])


@pytest.mark.parametrize("vocabulary", [5, 400, 20_000])
def test_frequent_and_rare_words(spark, monkeypatch, vocabulary):
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 500)
    monkeypatch.setattr(lm_score, "BLOCK_DOCS", 30)
    draw = random.Random(vocabulary)
    docs = []
    for i in range(200):
        text = [f"w{int(draw.paretovariate(0.6)) % vocabulary}" for _ in range(draw.randrange(60))]
        docs.append((i, " ".join(text)))
    check(spark, docs)


def test_awkward_rows(spark):
    docs = [(1, None), (2, ""), (None, "a b a b"), (3, "A b"), (3, "A b"), (4, "x " * 60_000), (5, "once"), (6, "é É\n\ta")]
    check(spark, docs)
    check(spark, [(1, None)])
    check(spark, [(1, "alone")])
    assert lm_score.score(spark.createDataFrame([], SCHEMA)).collect() == []


def test_blocks_hold_no_batch_and_are_held_by_no_one(monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 1000)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600)), "text": pa.array(["some words " * 50] * 600)})
    with pa.BufferOutputStream() as sink:
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        sent = sink.getvalue()
    del batch
    ids, before = [], None
    for block in lm_score._blocks(pa.ipc.open_stream(sent)):
        assert before is None or before() is None
        ids += [i for b in block.batches for i in b.column("doc_id").to_pylist()]
        assert all("text" not in b.schema.names and b.column("doc_id").buffers()[1].size < 8192 for b in block.batches)
        assert all(not sent.address <= b.column("doc_id").buffers()[1].address < sent.address + sent.size for b in block.batches)
        before = weakref.ref(block)
        del block
    assert ids == list(range(600))
