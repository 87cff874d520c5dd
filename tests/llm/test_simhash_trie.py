"""SimHash near-duplicates against all pairs."""

import os
import random

import numpy as np
import pytest
import xxhash

from ledgerlens.llm import simhash_trie
from ledgerlens.llm.queries import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "doc_id long, text string, fingerprint string, component string"


def plain_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    runs = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) >= 3 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(r), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Least place reachable, by comparing all pairs."""
    prints = np.array(prints, np.uint64)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= radius) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def expected(rows, radius=2):
    """(doc_id, fingerprint, least doc_id) of (doc_id, text) with ascending ids."""
    prints = [plain_fingerprint(t) for _, t in rows]
    return sorted((i, f"{p:016x}", rows[c][0]) for (i, _), p, c in zip(rows, prints, plain_components(prints, radius)))


def found(df):
    return sorted(tuple(r) for r in df.collect())


def test_given_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = found(queries()["op13_simhash_trie"](spark, FOLDER))
    assert rows == expected([tuple(r) for r in docs])
    assert len({r[2] for r in rows}) < len(rows)


def test_awkward_rows(spark):
    long = " ".join(f"Word{i % 977}" for i in range(400_000))
    texts = [
        None, "", " \t\n", "one", "ONE", "one two", "one\ttwo ", "a b c", "A B C", "é É ü", "a b c d", "  x",
        long, long + " end", "w" * 3_000_000, "w" * 2_000_000 + " v", "x y " + "z" * 1_100_000 + " q r", "a b c",
    ]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, "clash", None) for i, t in rows], SCHEMA)
    result = found(simhash_trie.near_duplicates(df))
    assert result == expected(rows)
    assert [c for i, _, c in result if i in (0, 1, 2)] == [0, 0, 0]


def test_null_and_repeated_ids(spark):
    rows = [(None, "a b c"), (7, "a b c"), (7, "a b c"), (None, "quite another text"), (3, "third text here")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    result = [(r["doc_id"], r["component_id"]) for r in simhash_trie.near_duplicates(df).collect()]
    assert sorted(result, key=str) == sorted([(None, 7), (7, 7), (7, 7), (None, None), (3, 3)], key=str)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    result = simhash_trie.near_duplicates(empty)
    assert result.columns == ["doc_id", "fingerprint", "component_id"] and result.collect() == []


def crowd(n, seed):
    """Distinct fingerprints, half of them random, half within a few bits of a few centres."""
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(3)] + [0, 2**64 - 1]
    prints = set()
    while len(prints) < n:
        x = rng.getrandbits(64)
        if rng.random() < 0.5:
            x = rng.choice(centres)
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
        prints.add(x)
    return sorted(prints)


@pytest.mark.parametrize("radius", [0, 1, 2, 4])
def test_trie_links_each_pair_once(radius):
    values = np.array(crowd(1500, radius), np.uint64)
    whole = np.array([[0, len(values), 0, len(values), 0]], np.int64).T
    pairs = [p for i, j in simhash_trie.trie_links(values, {0: list(whole)}, radius) for p in zip(i.tolist(), j.tolist())]
    i, j = np.triu_indices(len(values), 1)
    near = np.bitwise_count(values[i] ^ values[j]) <= radius
    assert sorted(tuple(sorted(p)) for p in pairs) == sorted(zip(i[near].tolist(), j[near].tolist()))


@pytest.mark.parametrize("leaf", [1, 5, 40])
def test_trie_cut_in_spark(spark, monkeypatch, leaf):
    """Small leaf nodes make many levels, nodes of different depths and pairs between them."""
    monkeypatch.setattr(simhash_trie, "LEAF", leaf)
    values = crowd(150 if leaf == 1 else 600, leaf)
    prints = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in values], "fingerprint long")
    links = simhash_trie.links(prints, len(values)).collect()
    at = {x: i for i, x in enumerate(values)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        a, b = at[r["a"] % 2**64], at[r["b"] % 2**64]
        a, b = sorted((find(a), find(b)))
        root[b] = a
    assert [find(i) for i in range(len(values))] == plain_components(values, 2)


def test_without_the_trie_nothing_links(spark, monkeypatch):
    """All links come from the traversal."""
    monkeypatch.setattr(simhash_trie, "_node_pairs", lambda spark, levels, radius: spark.createDataFrame([], "node_a string, node_b string, depth int, differ int"))
    df = spark.createDataFrame([(1, "a b c d e f g", None, None), (2, "a b c d e f", None, None)], SCHEMA)
    assert {r["component_id"] for r in simhash_trie.near_duplicates(df).collect()} == {1, 2}
