"""Replication counts, weights and awkward rows."""

from collections import Counter

from ledgerlens.llm import mixing

SCHEMA = "doc_id long, text string, source string, copy string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_sources_meet_their_weights(spark):
    rows = [(i, f"t{i}", "big" if i < 3000 else "small", "") for i in range(3300)]
    mixed = mixing.mix(frame(spark, rows), {"big": 1, "small": 3}, total=8000).collect()
    counts = Counter(r["source"] for r in mixed)
    assert abs(counts["big"] - 2000) < 5 * 2000**0.5
    assert abs(counts["small"] - 6000) < 5 * 6000**0.5
    small = Counter(r["doc_id"] for r in mixed if r["source"] == "small")
    mean = sum(small.values()) / 300
    variance = sum((small.get(i, 0) - mean) ** 2 for i in range(3000, 3300)) / 300
    assert 0.7 * mean < variance < 1.3 * mean  # Poisson: equal


def test_large_rates_are_sums_of_parts(spark):
    mixed = mixing.mix(frame(spark, [(i, "x", "a", "") for i in range(5)]), total=5 * 700).collect()
    assert abs(len(mixed) - 3500) < 5 * 3500**0.5
    assert all(0 <= r["copy"] < r["copies"] for r in mixed)
    assert len({(r["doc_id"], r["copy"]) for r in mixed}) == len(mixed)


def test_same_result_for_any_partitioning_and_shuffled(spark):
    df = frame(spark, [(i, f"t{i}", f"s{i % 3}", "") for i in range(400)])
    first, second = (mixing.mix(df.repartition(k)).collect() for k in (2, 9))
    assert sorted(first) == sorted(second)
    ids = [r["doc_id"] for r in first]
    assert ids != sorted(ids)


def test_nulls_repeats_and_empty(spark):
    rows = [(None, None, None, None), (1, "", "a", "x"), (1, "", "a", "x"), (1, "other", "a", "x")] * 50
    mixed = mixing.mix(frame(spark, rows), total=2000).collect()
    assert {r["source"] for r in mixed} == {None, "a"}
    repeats = Counter(r["copies"] for r in mixed if r["text"] == "")
    assert len(repeats) == 1  # equal rows, equal counts
    assert mixing.mix(frame(spark, [])).collect() == []
    assert mixing.mix(frame(spark, rows), weights={}).collect() == []
    assert {r["source"] for r in mixing.mix(frame(spark, rows), {"a": 1, "missing": 5}, total=500).collect()} == {"a"}


def test_names_of_its_own(spark):
    """Columns named like those the operator uses, and a very long text."""
    rows = [(i, "x" * (3_000_000 if i == 0 else 9), "ab"[i % 2], i, -i, "k") for i in range(40)]
    clashing = spark.createDataFrame(rows, "doc_id long, text string, source string, _rate long, _Key long, own_rate string")
    mixed = mixing.mix(clashing)
    assert mixed.columns[:6] == clashing.columns
    plain = mixing.mix(clashing.select("doc_id", "text", "source")).select("doc_id", "copy").collect()
    assert sorted((r["doc_id"], r["copy"]) for r in mixed.collect()) == sorted(map(tuple, plain))
    assert all(r["_rate"] == -r["_Key"] == r["doc_id"] for r in mixed.select("doc_id", "_rate", "_Key").collect())
