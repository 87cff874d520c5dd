"""Lines kept against a plain search through all earlier lines."""

import random
import re

import pytest

from ledgerlens.llm import line_dedup

SCHEMA = "doc_id long, text string, n_removed string"
FOLDER = "/root/testdata/sf0.01"


def words(text):
    return frozenset(re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))


def brute(docs):
    """For each document its lines that stay, documents in the order of doc_id."""
    seen, holders, result = [], {}, []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        if text is None:
            result.append((doc_id, None, 0))
            continue
        stay, gone = [], 0
        for line in text.split("\n"):
            w = words(line)
            counts = {}
            for x in w:
                for j in holders.get(x, ()):
                    counts[j] = counts.get(j, 0) + 1
            match = any(5 * n >= 4 * (len(w) + len(seen[j]) - n) for j, n in counts.items())
            if w:
                for x in w:
                    holders.setdefault(x, []).append(len(seen))
                seen.append(w)
            if match:
                gone += 1
            else:
                stay.append(line)
        result.append((doc_id, "\n".join(stay) if gone else text, gone))
    return result


def check(spark, docs):
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], SCHEMA).coalesce(1)
    rows = line_dedup.dedup(df)
    assert rows.columns == ["doc_id", "text", "n_removed"]
    got, expected = sorted((tuple(r) for r in rows.collect()), key=str), sorted(brute(docs), key=str)
    assert got == expected
    return sum(n for _, _, n in got)


def test_whole_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert check(spark, docs) > 100


@pytest.mark.parametrize("seed, vocabulary, edits", [(1, 2000, 3), (2, 60, 2), (3, 300, 8)])
def test_near_copies(spark, monkeypatch, seed, vocabulary, edits):
    monkeypatch.setattr(line_dedup, "SMALL", 6)
    monkeypatch.setattr(line_dedup, "DENSE", 1)  # most groups are open
    monkeypatch.setattr(line_dedup, "PART", 20)
    draw = random.Random(seed)
    bases = [[f"w{draw.randrange(vocabulary)}" for _ in range(draw.randrange(3, 30))] for _ in range(12)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(draw.randrange(1, 4)):
            line = list(draw.choice(bases))
            for _ in range(draw.randrange(edits)):
                line[draw.randrange(len(line))] = f"w{draw.randrange(vocabulary)}"
            lines.append(" ".join(line))
        docs.append((i, "\n".join(lines)))
    draw.shuffle(docs)
    assert check(spark, docs) > 20


def test_pairs_grow_with_near_copies(spark, monkeypatch):
    similar, asked = line_dedup._similar, []

    def counted(pairs, *others):
        asked.append(pairs.count())
        return similar(pairs, *others)

    monkeypatch.setattr(line_dedup, "_similar", counted)
    words_ = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join([*words_, f"own{i}"] if i else words_)) for i in range(60)]
    # Near copies within one text, of which the row's id does not tell the order.
    docs.append((60, "\n".join(" ".join([*(f"v{i}" for i in range(12)), f"own{j}"]) for j in range(9, 0, -1))))
    assert check(spark, docs) == 59 + 8
    assert sum(asked) < 4 * 70  # of 1,770 + 36


def test_awkward_rows(spark):
    line = "one two three four five"
    docs = [(5, line), (3, f"{line}\n\n{line.upper()} \n"), (None, "null id first"), (4, None), (6, ""), (7, "\n\n"), (7, "again\n"),
            (7, "again\n"), (8, "word " * 40_000 + "\nend"), (9, "word"), (10, "é É\nnull id first"), (11, "one two three four")]
    check(spark, docs)
    check(spark, [(1, None)])
    assert line_dedup.dedup(spark.createDataFrame([], SCHEMA)).collect() == []
