"""Vector codes against Lloyd's rounds over plain Python numbers."""

import hashlib
import math
import os
import random

import pytest

from ledgerlens.llm import codebooks
from ledgerlens.llm.queries import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SCHEMA = "vec_id long, embedding array<double>, label int, row string, position string"


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))


def expected(rows):
    """Result rows of (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = codebooks.cuts(len(kept[0][1]))
    parts = [[v[a:b] for a, b in zip(cut, cut[1:])] for _, v, _ in kept]
    books = [[p[k] for p in parts[:16]] for k in range(8)]
    for _ in range(6):
        for k, book in enumerate(books):
            members = {}
            for p in parts:
                members.setdefault(nearest(p[k], book)[1], []).append(p[k])
            books[k] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else entry for e, entry in enumerate(book)]
    found = [[nearest(p[k], books[k]) for k in range(8)] for p in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, label), error in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for _, e in f), error, by_label[label], sha) for (i, _, label), f, error in zip(kept, found, errors)),
        key=str,
    )


def coded(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def test_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert coded(queries()["op12_vector_codes"](spark, FOLDER)) == expected(rows)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def vectors(n, size, seed, scale=1.0):
    rng = random.Random(seed)
    return [[rng.gauss(0, scale) for _ in range(size)] for _ in range(n)]


def test_awkward_rows(spark):
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(vectors(60, 16, 1))]
    rows += [(3, rows[3][1], 0), (3, rows[4][1], 0), (None, rows[5][1], None), (None, rows[6][1], 1)]
    rows += [(100, None, 0), (-5, [], 0), (101, [None] * 16, 0), (-4, [0.5] * 15 + [None], 0)]
    rows += [(-3, [float("nan")] + [0.0] * 15, 0), (-2, [float("-inf")] + [0.0] * 15, 1), (200, [0.0] * 16, 2), (201, [-0.0] * 16, 2)]
    rows += [(202, [1.0] * 16, 2)] * 40
    assert coded(codebooks.encode(table(spark, rows))) == expected(rows)


def test_other_lengths_are_left_out(spark):
    rows = [(i, v, None) for i, v in enumerate(vectors(20, 11, 2))]
    assert coded(codebooks.encode(table(spark, [*rows, (50, [1.0] * 8, 1)]))) == expected(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 15, 17])
def test_few_rows(spark, n):
    rows = [(i, v, 1) for i, v in enumerate(vectors(n, 8, 3))]
    assert coded(codebooks.encode(table(spark, rows))) == expected(rows)


def test_numbers_beyond_64_bits(spark):
    rows = [(i, v, 1) for i, v in enumerate(vectors(30, 8, 4, 1e6) + vectors(10, 8, 5, 1e25))]
    limit = 2**63 - 1
    want = expected(rows)
    fit = [(i, c, e if e <= limit else None, sha) for i, c, e, _, sha in want]
    assert sorted(((r[0], r[1], r[2], r[4]) for r in coded(codebooks.encode(table(spark, rows)))), key=str) == sorted(fit, key=str)


def test_partitions_do_not_matter(spark):
    df = table(spark, [(i, v, i % 2) for i, v in enumerate(vectors(300, 16, 6))])
    assert coded(codebooks.encode(df.repartition(1))) == coded(codebooks.encode(df.repartition(13)))


def test_only_parts_that_change_entry_move(spark, monkeypatch):
    """The first round deals out everything; the later ones shuffle what changed."""
    moved = []
    dealt = codebooks._dealt
    monkeypatch.setattr(codebooks, "_dealt", lambda parts, rows: (moved.append(parts.count()), dealt(parts, rows))[1])
    codebooks.encode(table(spark, [(i, v, 0) for i, v in enumerate(vectors(400, 16, 7))])).collect()
    assert moved[0] == 400 * 8 and len(moved) == 6 and all(n < 400 * 4 for n in moved[1:]) and moved[-1] < moved[1]
