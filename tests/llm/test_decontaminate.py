"""Windows against a brute-force search over all windows of all lengths asked for."""

import re
from collections import Counter

import pytest

from ledgerlens.llm import decontaminate

FOLDER = "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def shingles(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(docs, items):
    """The best similarity per document and item, over all windows of the item's length."""
    found = {}
    for doc_id, text in docs:
        own = words(text)
        grams = set(shingles(own))
        for item_id, item in items:
            other = words(item)
            theirs = shingles(other)
            if not own or not other or (len(other) >= 5 and not grams & set(theirs)):
                continue
            n = min(len(other), len(own))
            best = max(
                sum((w & theirs).values()) / sum((w | theirs).values())
                for w in (shingles(own[s : s + n]) for s in range(len(own) - n + 1))
            )
            if best >= 0.8:
                found[doc_id, item_id] = best
    return found


def check(spark, docs, items, may_miss=0):
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], DOCS)
    b = spark.createDataFrame(items, ITEMS)
    rows = decontaminate.find(d, b).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in rows}
    expected = brute(docs, items)
    assert set(got) <= set(expected) and len(expected) - len(got) <= may_miss
    for k, v in got.items():
        assert v <= expected[k] + 1e-12 and v > expected[k] - 0.1
    kept = decontaminate.remove(d, b)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in got}
    return got


def test_whole_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert len(check(spark, docs, items)) > 0


def test_edited_passages_and_short_items(spark):
    item = " ".join(f"w{i}" for i in range(40))
    edited = item.replace("w1 ", "other ")
    far = " ".join(f"w{i}" if i % 6 else "x" for i in range(40))
    docs = [
        (1, f"before {item} after"), (2, f"Some words {edited.upper()} and more"), (3, far), (4, " ".join(item.split()[:36])),
        (5, None), (6, ""), (7, "two words"), (8, "here are two words inside"), (9, "w1 w2 w3 w4 w5 w6 " + "z " * 30_000),
        (10, "again " * 60),
    ]
    items = [(1, item), (2, "two words"), (3, None), (4, ""), (5, "again " * 60)]
    got = check(spark, docs, items)
    assert {(1, 1), (2, 1), (4, 1), (7, 2), (8, 2), (10, 5)} == set(got)


def test_several_parts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 200)
    items = [(i, " ".join(f"i{i}w{j}" for j in range(20))) for i in range(8)]
    docs = [(i, f"lead {t} tail") for i, t in items] + [(99, "nothing of all that is in here at all")]
    assert set(check(spark, docs, items)) == {(i, i) for i in range(8)}
    none = spark.createDataFrame([], ITEMS)
    d = spark.createDataFrame([(1, "a b c d e f", "x")], DOCS)
    assert decontaminate.find(d, none).collect() == [] and decontaminate.remove(d, none).count() == 1
    assert decontaminate.find(d.limit(0), spark.createDataFrame(items, ITEMS)).collect() == []


@pytest.mark.parametrize("distance", [0, 1, 15, 31])
def test_block_tables_guarantee_the_radius(distance):
    import numpy as np
    import pyarrow as pa

    random = np.random.default_rng(distance)
    items = decontaminate.Items(pa.array([" ".join(f"t{i}u{j}" for j in range(30)) for i in range(40)]))
    members, prints, tables = items.groups[30]
    for m in range(len(members)):
        bits = np.unpackbits(prints[m])
        bits[random.choice(128, distance, replace=False)] ^= 1
        near = np.packbits(bits)
        assert any(tables[j, near[j], m] for j in range(decontaminate.BLOCKS))
