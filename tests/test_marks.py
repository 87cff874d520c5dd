"""Repeated ids that are too many to be looked up, and what the joins that mark rows carry."""

import pytest
from pyspark.sql import functions as F

from ledgerlens import RevenueAudit
from ledgerlens.operators import joins, marks
from ledgerlens.operators.rules import classify, decided, invalid, suspicious, trusted
from ledgerlens.plans import metrics, validators
from ledgerlens.sources import fixtures


@pytest.fixture
def many(monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)


def rows(spark):
    """Ids that two or three rows share, one of 400 rows, null ids and null places; some rows agree in all."""
    n = F.col("id")
    key = F.when(n % 11 == 0, None).when(n < 400, -1).otherwise(n % 700)
    return spark.range(1500).select(
        key.alias("k"),
        F.when(n % 13 == 0, None).otherwise(n * 37 % 101).alias("a"),
        F.when(n % 2 == 0, n * 53 % 7).alias("b"),
        n.alias("row"),
    )


@pytest.mark.parametrize("order", [["a"], ["a", "b"], ["a", "b", "row"]])
@pytest.mark.parametrize("crowd", [50, 10**9])
def test_ranked_like_looked_up(spark, monkeypatch, order, crowd):
    df = rows(spark)
    looked_up = marks.repeated_keys(df, "k", order)
    assert not looked_up.ranked
    expected = marks.mark_repeats(df, looked_up, "k", order, "later")
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", crowd)
    ranked = marks.repeated_keys(df, "k", order)
    assert ranked.ranked and ranked.firsts.table.count() == (1 if crowd == 50 else 0)
    got = marks.mark_repeats(df, ranked, "k", order, "later")
    assert got.columns == expected.columns
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert 0 < got.where("later").count() < got.count()


def test_rows_outside_are_no_first(spark, many):
    df = rows(spark).withColumn("sound", F.col("row") % 3 != 0)
    repeated = marks.repeated_keys(df.where("sound"), "k", ["row"])
    got = marks.mark_repeats(df, repeated, "k", ["row"], "later", F.col("sound")).where("sound and not later and k >= 0")
    assert got.count() == df.where("sound and k >= 0").select("k").distinct().count()


def test_rows_are_shuffled_once_without_lookup(spark, many):
    df = rows(spark)
    marked = marks.mark_repeats(df, marks.repeated_keys(df, "k", ["a", "row"]), "k", ["a", "row"], "later")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_decided_rules_classify_alike(spark):
    df = spark.range(60).select(F.when(F.col("id") % 7 > 0, F.col("id") - 30).alias("x"), (F.col("id") % 5 == 0).alias("_mark"))
    rules = [
        invalid(F.col("x") < 0, "negative"),
        invalid(F.col("_mark"), "marked", marked=True),
        suspicious(F.col("x").isNull(), "missing"),
        suspicious(F.col("x") > 20, "large"),
    ]
    before, late = decided(df, rules, "_held")
    assert late[1] is rules[1]
    got = classify(before.withColumn("x", F.lit(None)), late).select("_mark", "record_status", "status_reason")
    expected = classify(df, rules).select("_mark", "record_status", "status_reason")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_invoices_are_classified_once_for_a_report(spark, monkeypatch):
    calls = []
    classify = validators.clean_invoices
    sums = metrics.invoice_sums
    monkeypatch.setattr(validators, "clean_invoices", lambda *a, **k: calls.append("classified") or classify(*a, **k))
    monkeypatch.setattr(metrics, "invoice_sums", lambda *a, **k: calls.append("summed") or sums(*a, **k))
    audit = RevenueAudit(fixtures.derive_tables(spark, "/root/testdata/sf0.001"), fixtures.AS_OF, fixtures.ORDERS)
    audit.reports["contradictions"]().collect()
    audit.executive_summary.collect()
    assert calls == ["classified", "summed"]
    assert set(audit.invoice_facts.columns) == set(metrics.INVOICE_FACTS)


def test_trusted_rows_are_chosen_before_later_marks(spark):
    """Rows that are INVALID by themselves do not travel to the join that marks unknown references."""
    rules = [
        invalid(F.col("a") < 0, "negative"),
        invalid(F.col("_unknown_ref"), "unknown", marked=True),
        suspicious(F.col("b").isNull(), "missing"),
    ]
    df, rules = decided(spark.range(100).selectExpr("id as k", "id - 50 as a", "nullif(id % 3, 0) as b"), rules, "_held")
    unknown = spark.range(0, 100, 7).selectExpr("id as k", "true as _unknown").hint("merge")
    marked = df.join(unknown, "k", "left").withColumn("_unknown_ref", F.coalesce("_unknown", F.lit(False)))
    found = trusted(classify(marked, rules))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "- 50) < 0" in plan[plan.index("Join") :].split("Filter", 1)[1].split("\n")[0]
    assert sorted(r["k"] for r in found.collect()) == [k for k in range(50, 100) if k % 7]
    assert {r["record_status"] for r in classify(marked, rules).collect()} == {"VALID", "SUSPICIOUS", "INVALID"}


def test_ids_too_many_to_look_up_are_not_all_counted(spark, monkeypatch):
    df = spark.range(20_000).select((F.col("id") % 9000).alias("k"), F.col("id").alias("row"))
    counted = []
    shared_keys = marks._shared_keys
    monkeypatch.setattr(marks, "_shared_keys", lambda d, k, n: counted.append(d.count()) or shared_keys(d, k, n))
    expected = marks.mark_repeats(df, marks.repeated_keys(df, "k", ["row"]), "k", ["row"], "later")
    assert len(counted) == 2 and counted[0] < 1000 and counted[1] == 20_000
    for limit, ranked, rounds in [(50_000, True, 1), (200_000, True, 2), (10**6, False, 2)]:
        counted.clear()
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        repeated = marks.repeated_keys(df, "k", ["row"])
        assert (repeated.ranked, len(counted)) == (ranked, rounds)
        got = marks.mark_repeats(df, repeated, "k", ["row"], "later")
        assert got.exceptAll(expected).isEmpty() and got.where("later").count() == 11_000
