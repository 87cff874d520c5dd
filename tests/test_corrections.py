from datetime import datetime

import pytest

from frames import AS_OF, frame
from ledgerlens import Corrections, RevenueAudit
from ledgerlens.plans import executive, metrics, reports, validators

pytestmark = pytest.mark.usefixtures("tiny_data")


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "subscriptions": frame(
            spark,
            "subscriptions",
            {"region": None, "monthly_fee": 100.0, "discount_pct": 0.0},
            {"subscription_id": "S1", "region": "South", "customer_id": "C2"},
            {"customer_id": "C3", "subscription_status": " active", "monthly_fee": 40.0},
            {"customer_id": "C3", "subscription_status": "Expired", "signup_date": None, "region": "Gone"},
            {"customer_id": "C3", "subscription_status": "Cancelled", "signup_date": datetime(2024, 5, 1)},
            {"subscription_id": "S9", "monthly_fee": -5.0},
            {"subscription_id": "S9", "customer_id": "C4", "renewal_date": datetime(2024, 5, 1), "auto_renew": "N"},
        ),
        "invoices": frame(
            spark,
            "invoices",
            {},
            {"payment_status": "Failed", "payment_date": None},
            {"payment_status": None, "payment_date": None},
            {"tax_amount": -1.0},
            {"payment_date": None},
            {"subscription_id": "S9"},
        ),
        "product_usage": frame(spark, "product_usage", {}),
        "support_cases": frame(
            spark, "support_cases", {"case_status": "Escalated"}, {"case_status": None}, {"customer_id": "C3"}
        ),
    }


@pytest.fixture(scope="module")
def audited(tables):
    built = {}

    def build(**switches):
        key = tuple(sorted(switches))
        if key not in built:
            built[key] = RevenueAudit(tables, AS_OF, corrections=Corrections(**switches))
        return built[key]

    return build


def pairs(df, *columns):
    return {r[0]: r[1] for r in df.select(*columns).collect()}


def test_missing_groups(audited):
    standard = audited().reports["trusted_vs_reported_mrr"]().where("region is null").collect()
    assert len(standard) == 2
    matched = audited(match_missing_groups=True).reports["trusted_vs_reported_mrr"]().where("region is null").collect()
    assert [tuple(r) for r in matched] == [(None, "Pro", 100.0, 100.0, 0.0)]


def test_reported_status(tables):
    def reported(corrections):
        fees = reports.reported_fees(tables["subscriptions"], "plan_name", corrections=corrections)
        return [float(r.reported) for r in fees.collect()]

    assert reported(Corrections()) == [295.0]
    assert reported(Corrections(normalise_reported_status=True)) == [335.0]


def test_missing_status(audited):
    for switches, rates in (({}, (1 / 3, 0.5)), ({"ignore_missing_status": True}, (0.5, 1.0))):
        audit = audited(**switches)
        paid = metrics.payments(audit.clean_invoices, audit.clean_subscriptions, audit.corrections)
        asked = metrics.support(audit.clean_support_cases, audit.corrections)
        assert pairs(paid, "customer_id", "payment_failure_rate")["C1"] == rates[0]
        assert pairs(asked, "customer_id", "support_escalation_rate")["C1"] == rates[1]


def test_links_and_payment_dates(audited):
    def found(**switches):
        audit = audited(**switches)
        rows = reports.invoice_contradictions(
            audit.clean_invoices, audit.clean_subscriptions, corrections=audit.corrections
        )
        return sorted((r.customer_id, r.description.split(":")[0]) for r in rows.collect())

    everything = found()
    assert ("C2", "Invoice I4") in everything and ("C1", "Invoice I6") in everything
    assert found(trusted_links_only=True) == [("C1", "Invoice I4"), ("C1", "Invoice I5")]
    assert found(payment_dates_only=True) == [("C1", "Invoice I5"), ("C2", "Invoice I5")]
    audit = audited(trusted_links_only=True)
    totals = executive.invoice_totals(audit.clean_invoices, audit.clean_subscriptions, audit.corrections)
    assert [(r[0], float(r[1])) for r in totals.collect()] == [("C1", 150.0)]


def test_reported_per_customer(audited):
    own = pairs(audited(reported_per_customer=True).executive_summary, "customer_id", "reported_mrr")
    assert own == {"C1": 95.0, "C3": None}
    shared = pairs(audited().executive_summary, "customer_id", "reported_mrr")
    assert shared == {"C1": None, "C3": None}


def test_attributes(audited):
    for switches, region in (({}, "Gone"), ({"prefer_active": True}, "North")):
        assert pairs(audited(**switches).customer_metrics, "customer_id", "region")["C3"] == region


def test_renewals_and_sound_rows(audited):
    assert set(pairs(audited().customer_metrics, "customer_id", "renewal_risk_score")) == {"C1", "C3"}
    both = audited(first_sound_row=True)
    reasons = [r.status_reason for r in both.clean_subscriptions.where("subscription_id = 'S9'").orderBy("source_seq").collect()]
    assert reasons == ["Negative monthly_fee", "No issues detected"]
    assert both.clean_invoices.where("subscription_id = 'S9'").first().status_reason == "No issues detected"
    assert pairs(both.customer_metrics, "customer_id", "renewal_risk_score")["C4"] == 40.0
    upcoming = audited(first_sound_row=True, upcoming_renewals_only=True)
    assert pairs(upcoming.customer_metrics, "customer_id", "renewal_risk_score")["C4"] == 25.0


def test_activity_flags(audited):
    rows = audited(activity_flags=True).customer_summary.select("customer_id", "has_usage", "has_invoices").collect()
    assert sorted(tuple(r) for r in rows) == [("C1", True, True), ("C3", False, False)]
    assert "has_usage" not in audited().customer_summary.columns


def test_plans(spark):
    rows = [{"plan_name": "A", "discount_pct": 30.0, "subscription_status": s} for s in ("Active", "Expired", "Cancelled")]
    rows += [{"plan_name": "B", "discount_pct": 40.0, "subscription_status": "Active"}]
    rows += [{"plan_name": "C", "discount_pct": 0.0, "subscription_status": "Active"}] * 4
    summary = spark.createDataFrame(
        [(p, 50.0) for p in "ABC"], "plan_name string, customer_health_score double"
    )

    def flagged(**switches):
        clean = validators.clean_subscriptions(frame(spark, "subscriptions", *rows), AS_OF)
        report = reports.discount_vs_retention(clean, summary, Corrections(**switches))
        return [(r.plan_name, r.cancellation_rate_pct) for r in report.collect()]

    assert flagged() == [("A", 33.33)]
    assert flagged(expired_is_cancelled=True) == [("A", 66.67)]
    rows[3] = {**rows[3], "discount_pct": 100.0}
    assert flagged() == []
    assert flagged(weigh_plans=True) == [("A", 33.33)]
