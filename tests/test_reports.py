from datetime import datetime

import pytest

from frames import AS_OF, frame
from ledgerlens import RevenueAudit
from ledgerlens.operators import ranking
from ledgerlens.plans import executive, metrics, reports, validators

pytestmark = pytest.mark.usefixtures("tiny_data")


def build(spark, subscriptions, invoices=(), usage=(), cases=()):
    return RevenueAudit(
        {
            "subscriptions": frame(spark, "subscriptions", *subscriptions),
            "invoices": frame(spark, "invoices", *invoices),
            "product_usage": frame(spark, "product_usage", *usage),
            "support_cases": frame(spark, "support_cases", *cases),
        },
        AS_OF,
    )


def table(df):
    return [tuple(r) for r in df.collect()]


def test_missing_region_gives_a_row_per_side(spark):
    audit = build(
        spark,
        [
            {"region": None, "monthly_fee": 100.0, "discount_pct": 0.0},
            {"region": "South", "subscription_status": " active", "monthly_fee": 40.0, "discount_pct": 50.0},
            {"monthly_fee": 200.0, "discount_pct": 25.0},
            {"monthly_fee": 300.0, "customer_id": None},
        ],
    )
    assert sorted(table(audit.reports["trusted_vs_reported_mrr"]()), key=repr) == sorted(
        [
            (None, "Pro", 100.0, 0.0, 100.0),
            (None, "Pro", 0.0, 100.0, 0.0),
            ("South", "Pro", 0.0, 20.0, 0.0),
            ("North", "Pro", 500.0, 150.0, 70.0),
        ],
        key=repr,
    )
    ranked = table(audit.reports["region_ranking"]())
    assert ranked[0] == ("North", 500.0, 150.0, 70.0, 1)
    assert sorted(r[0] or "" for r in ranked[1:]) == ["", "South"] and {r[4] for r in ranked[1:]} == {2}


def test_renewal_risk_and_attributes(spark):
    subs = validators.clean_subscriptions(
        frame(
            spark,
            "subscriptions",
            {"signup_date": datetime(2022, 1, 1), "region": "Old"},
            {"signup_date": None, "region": "Undated", "subscription_status": "Expired", "auto_renew": None},
            {"customer_id": "C2", "renewal_date": datetime(2024, 7, 1, 23), "auto_renew": "y"},
            {"customer_id": "C3", "renewal_date": datetime(2024, 7, 2), "auto_renew": " Y"},
            {"customer_id": "C4", "renewal_date": datetime(2023, 2, 1), "subscription_status": "cancelled"},
            {"customer_id": "C4", "signup_date": datetime(2023, 1, 1), "region": "Later row"},
        ),
        AS_OF,
    )
    risk = dict(table(metrics.renewal_risk(subs, AS_OF)))
    assert risk == {"C1": 42.5, "C2": 15.0, "C3": 25.0, "C4": 45.0}
    attributes = {r.customer_id: r.region for r in metrics.latest_attributes(subs, AS_OF).collect()}
    assert attributes == {"C1": "Undated", "C2": "North", "C3": "North", "C4": "Later row"}
    assert dict(table(metrics.recurring_revenue(subs, AS_OF))) == {"C1": 90.0, "C2": 90.0, "C3": 90.0, "C4": 90.0}


def test_payment_metrics(spark):
    audit = build(
        spark,
        [{}, {"customer_id": "C1"}, {"customer_id": "C2"}],
        [
            {"invoice_amount": 10.0},
            {"subscription_id": "S2", "invoice_amount": 20.0},
            {"subscription_id": "S2", "invoice_amount": None},
            {"subscription_id": "S2", "payment_status": "failed", "payment_date": None},
            {"subscription_id": "S2", "payment_status": None, "payment_date": None},
            {"subscription_id": "S9"},
            {"subscription_id": "S3", "payment_status": "Pending", "payment_date": None},
        ],
    )
    args = audit.clean_invoices, audit.clean_subscriptions
    assert dict(table(metrics.effective_revenue(*args))) == {"C1": 15.0}
    assert dict(table(metrics.payment_failure(*args))) == {"C1": 0.2, "C2": 0.0}


SUMMARY = (
    "customer_id string, MRR double, effective_monthly_revenue double, payment_failure_rate double, "
    "usage_intensity_score double, support_escalation_rate double, average_csat double, plan_name string, "
    "subscription_status_norm string, customer_health_score double, risk_category string"
)


def test_customer_contradictions(spark):
    summary = spark.createDataFrame(
        [
            ("A", 90.0, 1.0, 2 / 3, 10.0, 0.0, 3.0, "Pro", "Active", 50.0, "Watchlist"),
            ("B", 0.0, 2.0, 0.0, 60.5, 0.0, 3.0, "Pro", "Cancelled", 50.0, "Watchlist"),
            ("C", 0.0, 3.0, 0.0, 0.0, 1 / 3, 4.25, "Enterprise", "Trial", 50.0, "Watchlist"),
            ("D", 0.0, 12345678.5, 0.0, 30.0, 0.0, 3.0, "Pro", "Trial", 29.99, "High Risk"),
        ],
        SUMMARY,
    )
    got = {r.contradiction_type: tuple(r) for r in reports.customer_contradictions(summary).collect()}
    assert {v[0]: (v[2], v[3]) for k, v in got.items() if v[0] != "C"} == {
        "A": ("Payment failure rate 66.7% while subscription is Active", 90.0),
        "B": ("Usage intensity 60.5 (above company average) yet subscription Cancelled", 2.0),
        "D": ("Revenue 12345679.0 with health score 29.99", 12345678.5),
    }
    assert got["Low usage on Enterprise plan"][2] == "Usage intensity only 0.0 on an Enterprise contract"
    assert (
        got["High CSAT despite repeated escalations"][2] == "Average CSAT 4.3 but escalation rate 33.3%"
    )
    one = reports.customer_contradictions(summary, "rich_but_unhealthy").collect()
    assert [r.customer_id for r in one] == ["D"]


def test_invoice_contradictions_follow_repeated_subscriptions(spark):
    audit = build(
        spark,
        [{}, {"subscription_id": "S1"}, {"subscription_id": "S1", "customer_id": "C2"}, {"subscription_id": "S1", "customer_id": None}],
        [
            {"tax_amount": -1.0, "invoice_amount": 70.0},
            {"invoice_id": None, "invoice_amount": 80.0},
            {"subscription_id": "S9"},
            {"invoice_amount": 500.0, "payment_status": "Failed", "tax_amount": -1.0},
            {"invoice_amount": None, "tax_amount": -2.0},
            {"invoice_amount": 11.0},
        ],
    )
    kind = "Paid invoice with invalid payment timeline"
    text = "Invoice I1: Negative tax_amount"
    expected = []
    for customer in ("C1", "C1", "C2", None):
        expected += [(customer, kind, text, 70.0), (customer, kind, None, 80.0)]
        expected += [(customer, kind, "Invoice I5: Negative tax_amount; Missing invoice_amount", None)]
    got = table(reports.invoice_contradictions(audit.clean_invoices, audit.clean_subscriptions))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    top = table(audit.reports["contradictions"]())
    assert top == [(c, kind, None, 80.0) for c in (None, "C1", "C1", "C2")] + [
        (c, kind, text, 70.0) for c in (None, "C1", "C1", "C2")
    ]
    totals = dict(table(executive.invoice_totals(audit.clean_invoices, audit.clean_subscriptions)))
    assert {k: float(v) for k, v in totals.items()} == {"C1": 22.0, "C2": 11.0, None: 11.0}


def test_top_contradictions_are_the_first_of_all(spark):
    subscriptions = [{"subscription_id": f"S{i % 4}", "customer_id": f"C{i % 7}"} for i in range(40)]
    invoices = [
        {"subscription_id": f"S{i % 6}", "invoice_amount": float(i % 9), "tax_amount": -1.0, "invoice_id": f"I{i % 50}"}
        for i in range(120)
    ]
    audit = build(spark, subscriptions, invoices)
    everything = reports.contradictions(audit.customer_summary, audit.clean_invoices, audit.clean_subscriptions)
    rows = [r for r in table(everything) if r[3] is not None]
    rows.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or "", r[1], r[2] is not None, r[2] or ""))
    assert len(rows) > 500
    assert table(audit.reports["contradictions"]()) == rows[:20]


def test_many_copies_are_written_out(spark):
    links = spark.createDataFrame([("C1", "I1", "r", 1.0, 2500), ("C2", "I2", "r", 2.0, 1000)], "customer_id string, invoice_id string, status_reason string, invoice_amount double, copies long")
    counts = {r.customer_id: r["count"] for r in reports._invoice_rows(links).groupBy("customer_id").count().collect()}
    assert counts == {"C1": 2500, "C2": 1000}


def test_priorities(spark):
    summary = spark.createDataFrame(
        [
            ("A", "High Risk", 10.0, "Active"),
            ("B", "High Risk", 0.0, "Active"),
            ("C", "High Risk", 10.0, "Expired"),
            ("D", "Watchlist", 90.0, "Active"),
            ("E", "Watchlist", 1.0, "Active"),
            ("F", "Healthy", 90.0, "Active"),
            ("G", None, 90.0, "Active"),
        ],
        "customer_id string, risk_category string, MRR double, subscription_status_norm string",
    )
    from pyspark.sql import functions as F

    got = dict(table(summary.select("customer_id", executive.priority(F.lit(40.0)))))
    assert got == {
        "A": "Immediate Action",
        "B": "Investigate",
        "C": "Investigate",
        "D": "Monitor Closely",
        "E": "Monitor",
        "F": "Low Priority",
        "G": "Low Priority",
    }


def test_no_customers_at_all(spark):
    audit = build(spark, [{"customer_id": None}])
    assert audit.customer_summary.count() == 0
    assert audit.executive_summary.count() == 0
    assert table(audit.reports["contradictions"]()) == []
    assert table(audit.reports["high_revenue_low_usage"]()) == []
    assert audit.reports["kpis"]().first().trusted_mrr == 0.0
    assert ranking.percent_ranks(audit.customer_summary, "customer_id", ["MRR"]).count() == 0


def test_absurd_amounts_do_not_stop_the_audit(spark):
    audit = build(
        spark,
        [{"monthly_fee": 1e18, "discount_pct": 0.0}, {"customer_id": "C2"}],
        [{"invoice_amount": 1e20}, {"subscription_id": "S2"}],
        [{"active_minutes": 1e19}, {"customer_id": "C2"}],
    )
    row = audit.executive_summary.where("customer_id = 'C1'").first()
    assert (row.trusted_mrr, row.total_invoice_value) == (1e18, 1e20)
    assert audit.reports["trusted_vs_reported_mrr"]().first().reported_mrr == 1e18 + 100
    assert audit.reports["contradictions"]().count() == 0


def test_no_report_joins_by_customer_again(spark):
    """Once the customers are written, the executive table and the escalations report need no shuffle by customer."""
    from ledgerlens.plans import executive, reports
    from ledgerlens.sources.fixtures import AS_OF as DERIVED, ORDERS, derive_tables

    audit = RevenueAudit(derive_tables(spark, "/root/testdata/sf0.001"), DERIVED, ORDERS)
    customers = audit.customers
    for df in (
        executive.executive_summary(customers, audit.raw["subscriptions"]),
        reports.high_revenue_low_usage(customers).drop("nothing"),
    ):
        plan = df._jdf.queryExecution().toString()
        assert "hashpartitioning(customer_id" not in plan and "SortMergeJoin" not in plan
