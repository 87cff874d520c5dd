"""Components and set sizes against all pairs, in settings that reach every step."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import ngram_join

SCHEMA = "doc_id long, text string, component_id string"
FOLDER = "/root/testdata/sf0.01"


def shingle_set(text, k=3):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(docs, share=90, per=100):
    sets = [(i, shingle_set(t)) for i, t in docs]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    order = sorted((j for j, (i, s) in enumerate(sets) if s and i is not None), key=lambda j: len(sets[j][1]))
    for at, x in enumerate(order):
        for y in order[at + 1 :]:
            a, b = sets[x][1], sets[y][1]
            if share * len(b) > per * len(a):
                break
            shared = len(a & b)
            if per * shared >= share * (len(a) + len(b) - shared):
                parent[max(root(x), root(y))] = min(root(x), root(y))
    least = {}
    for j in order:
        least[root(j)] = min(least.get(root(j), sets[j][0]), sets[j][0])
    return sorted(
        ((i, len(s), least[root(j)] if s and i is not None else i) for j, (i, s) in enumerate(sets)), key=str
    )


def check(spark, docs, **settings):
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA)
    rows = ngram_join.join(df, **settings)
    assert rows.columns == ["doc_id", "n_shingles", "component_id"]
    got = sorted((tuple(r) for r in rows.collect()), key=str)
    assert got == brute(docs, **{k: v for k, v in settings.items() if k != "k"})
    return got


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert len({c for _, _, c in check(spark, docs)}) < len(docs)


def drifting(seed, groups, members, words, edits):
    """Near copies of some texts, each with a few words changed, around the threshold."""
    draw = random.Random(seed)
    docs = []
    for g in range(groups):
        base = [f"w{draw.randrange(5000)}" for _ in range(words)]
        for _ in range(members):
            text = list(base)
            for _ in range(draw.randrange(edits)):
                text[draw.randrange(words)] = f"e{draw.randrange(10**6)}"
            docs.append((len(docs), " ".join(text)))
    draw.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed, words, edits", [(1, 60, 4), (2, 150, 9), (3, 14, 3)])
def test_chains_around_the_threshold(spark, monkeypatch, seed, words, edits):
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 12)  # several trees for one cell
    got = check(spark, drifting(seed, 4, 40, words, edits))
    assert 4 < len({c for _, _, c in got}) < 160


def test_awkward_rows(spark):
    text = " ".join(f"a{i}" for i in range(30))
    docs = [(5, text), (3, text), (3, text.upper()), (None, text), (4, None), (7, ""), (8, " \n\t "), (9, "one two"),
            (10, "ONE  two"), (11, "word " * 40_000), (12, "word word word"), (13, text + " and"), (2, "é é é É")]
    check(spark, docs)
    assert check(spark, [(1, None)]) == [(1, 0, 1)]
    assert ngram_join.join(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tree_finds_all_that_the_bound_allows():
    draw = np.random.default_rng(4)
    link = ngram_join.Link(3, 90, 100)
    points = np.repeat(draw.poisson(4, (30, 64)), 10, axis=0) + draw.poisson(0.15, (300, 64))
    sizes = points.sum(axis=1)
    tree = ngram_join.RTree(points, sizes)
    found = {(int(a), int(b)) for p, t in tree.search(points, sizes, link) for a, b in zip(p, t, strict=True)}
    shared = np.minimum(points[:, None], points[None]).sum(axis=2)
    expected = {(int(a), int(b)) for a, b in zip(*np.nonzero(link.holds(shared, sizes[:, None], sizes[None])), strict=True)}
    assert found == expected and len(expected) > 300


@pytest.mark.parametrize("seed, words, edits, part", [(1, 60, 4, 512), (2, 150, 9, 16), (3, 14, 3, 7)])
def test_every_link(spark, monkeypatch, seed, words, edits, part):
    monkeypatch.setattr(ngram_join, "PART_ROWS", part)  # components of one part and of several
    monkeypatch.setattr(ngram_join, "PART_COLUMNS", 50)
    docs = drifting(seed, 4, 40, words, edits)
    docs += [(200 + i, docs[i][1]) for i in range(5)] + [(None, docs[0][1]), (300, None), (301, "alone")]
    sets = [(i, shingle_set(t)) for i, t in docs if i is not None and t]
    expected = {}
    for at, (i, a) in enumerate(sets):
        for j, b in sets[at + 1 :]:
            if 100 * len(a & b) >= 90 * len(a | b):
                expected[min(i, j), max(i, j)] = len(a & b) / len(a | b)
    assert len(expected) > 100
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA)
    rows = ngram_join.pairs(df).collect()
    assert len(rows) == len(expected) and {(r["a"], r["b"]): r["similarity"] for r in rows} == pytest.approx(expected)
    number = {i: 0 for i, _ in docs}
    for pair in expected:
        for i in pair:
            number[i] += 1
    joined = ngram_join.join(df, n_links=True).collect()
    assert sorted((r["doc_id"] or -1, r["n_links"]) for r in joined) == sorted((i or -1, n) for i, n in number.items())


def test_links_come_through_the_tree(monkeypatch):
    """Without the R-tree a component's classes have no links."""
    texts = [t for _, t in drifting(2, 2, 20, 150, 3)]
    n = len(texts)
    columns = {c: [0] * n for c in ("group", "low", "high", "home")}
    classes = {"component": [b"c"] * n, "node": [bytes([i]) for i in range(n)], "rows": [1] * n, "text": texts}
    table, part = pa.table({**columns, **classes}), ngram_join._part_links(ngram_join.Link(3, 90, 100), True)
    assert part((), table).num_rows > 100
    monkeypatch.setattr(ngram_join.RTree, "search", lambda *_: iter(()))
    assert part((), table).num_rows == 0


def test_count_vectors_fold():
    draw = np.random.default_rng(2)
    values = draw.integers(0, 2**63, 5000).astype(np.uint64)
    sets = ngram_join.W.Rows(values, np.array([0, 1000, 5000]))
    assert ngram_join.groups_of(np.array([0, 1, 1536, 1537, 6145])).tolist() == [64, 64, 64, 256, 1024]
    counts, offsets = ngram_join.count_vectors(sets, ngram_join.groups_of(sets.counts))
    assert offsets.tolist() == [0, 64, 64 + 256] and counts.sum() == 5000
    coarse, _ = ngram_join.count_vectors(sets, np.array([64, 64]))
    assert (ngram_join.folded(counts[None, 64:], 64)[0] == coarse[64:]).all() and (counts[:64] == coarse[:64]).all()


def test_keep_one_leaves_columns_as_they_are(spark):
    text = " ".join(f"a{i}" for i in range(30))
    rows = [(1, text, 10, "x"), (2, text + " b", 20, "y"), (3, "else", 30, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id long, _hash string")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_passages_of_all_texts_make_no_cells(spark, monkeypatch):
    draw = random.Random(5)
    common = " ".join(f"c{i}" for i in range(40))
    docs = [(i, " ".join(f"w{draw.randrange(10**6)}" for _ in range(60)) + " " + common) for i in range(300)]
    docs += [(300 + i, f"{common} {i}") for i in range(20)]
    rows, plain = {}, ngram_join.measure

    def spy(df, name, **measures):
        written = plain(df, name, **measures)
        rows[name] = written.measures.get("rows")
        return written

    monkeypatch.setattr(ngram_join, "measure", spy)
    kept = ngram_join.keep_one(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in kept) == [*range(301)]
    assert rows["open_cells"] == 0


@pytest.mark.parametrize("share", [80, 90])
def test_linked_sets_share_a_cell_in_any_order(share):
    draw, link = np.random.default_rng(share), ngram_join.Link(5, share, 100)
    for _ in range(300):
        both = draw.integers(0, 2**63, int(draw.integers(3, 60))).astype(np.uint64) * np.uint64(2)
        one, other = (draw.integers(0, 2**63, int(draw.integers(0, 12))).astype(np.uint64) * np.uint64(2) for _ in "ab")
        sets = [np.unique(np.concatenate([both, x])) for x in (one, other)]
        a, b = map(len, sets)
        if not link.holds(len(both), a, b) or len(both) == a == b:
            continue
        known = draw.permutation(np.concatenate(sets))[: int(draw.integers(0, a + b))]
        codes = np.unique((ngram_join._bucket(known, 7) << np.uint64(32) | known & np.uint64(0xFFFFFFFF)).astype(np.int64))
        frequent = ngram_join.Frequent(7, codes, draw.integers(16, 40, len(codes)))
        rows = ngram_join.W.Rows(np.concatenate(sets), np.array([0, a, a + b]))
        cell, member = ngram_join._cells_of(rows, np.array([0, 1]), link, frequent, frequent.maybe())
        assert np.bincount(member).tolist() == link.meeting(np.array([a, b])).tolist()
        assert set(cell[member == 0]) & set(cell[member == 1])


def test_shingles_of_many_documents_are_counted(spark):
    texts = [f"a b c d e {i} {i}x {i}y {i}z {i}q" for i in range(40)] + ["k l m n o"] * 15 + [None, ""]
    ngram_join.ship(spark)
    found = ngram_join._frequent(spark.createDataFrame([(t,) for t in texts], "text string"), ngram_join.Link(5, 80, 100), 3)
    value = ngram_join.W.shingles(ngram_join.W.words(pa.array(["a b c d e"])), 5).values
    at, levels = found.of(np.concatenate([value + np.uint64(1), value]), found.maybe())
    assert len(found.codes) == 1 and at.tolist() == [1] and levels.tolist() == [int(4 * np.log2(40))]


def test_pairs_are_named_in_their_first_common_cell():
    draw = np.random.default_rng(8)
    lists = [sorted(draw.choice(30, int(draw.integers(1, 9)), replace=False).tolist()) for _ in range(40)]
    a, b, here = (draw.integers(0, n, 2000) for n in (40, 40, 30))
    expected = [int(h) <= min(set(lists[x]) & set(lists[y]), default=int(h)) for x, y, h in zip(a, b, here, strict=True)]
    assert ngram_join._first_met(a, b, here, pa.array(lists, pa.list_(pa.int64()))).tolist() == expected
    assert 100 < sum(expected) < 1900


def test_parities_differ_in_no_more_than_the_sets_do():
    draw, link = np.random.default_rng(6), ngram_join.Link(5, 80, 100)
    both = draw.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.concatenate([both[int(draw.integers(0, 30)) :], draw.integers(0, 2**63, int(draw.integers(0, 20))).astype(np.uint64)]) for _ in range(80)]
    rows = ngram_join.W.Rows(np.concatenate([np.unique(x) for x in [*sets, both[:0]]]), np.cumsum([0, *map(len, sets), 0]))
    odd, n = ngram_join._bits(pa.array([x.tobytes() for x in ngram_join.parities(rows)])), rows.counts
    assert odd.shape == (81, 16) and not odd[80].any()
    i, j = np.triu_indices(80, 1)
    allowed = ngram_join._few_differ(odd[i], odd[j], n[i], n[j], link)
    linked = np.array([link.holds(len(np.intersect1d(sets[x], sets[y])), n[x], n[y]) for x, y in zip(i, j, strict=True)])
    assert allowed[linked].all() and linked.sum() > 100
    assert linked.sum() <= allowed.sum() < 1.3 * linked.sum() < len(i) / 2
