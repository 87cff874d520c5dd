from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import AS_OF, frame
from ledgerlens.operators import joins
from ledgerlens.operators.rules import classify, invalid, rule_counts, status_counts, suspicious
from ledgerlens.plans import validators

EARLY = datetime(1990, 1, 1)

pytestmark = pytest.mark.usefixtures("tiny_data")


def verdicts(df, key):
    return {r[key]: (r.record_status, r.status_reason) for r in df.collect()}


def in_order(df):
    return [(r.record_status, r.status_reason) for r in df.orderBy("source_seq").collect()]


@pytest.fixture(scope="module")
def subs(spark):
    return validators.clean_subscriptions(
        frame(spark, "subscriptions", {}, {"customer_id": "C2", "monthly_fee": -1.0}), AS_OF
    )


FINE = ("VALID", "No issues detected")


def test_subscription_rules(spark):
    rows = [
        ({}, FINE),
        ({"subscription_id": None}, ("INVALID", "Missing subscription_id")),
        ({"subscription_id": None}, ("INVALID", "Missing subscription_id")),
        ({"subscription_id": "S1"}, ("INVALID", "Duplicate subscription_id")),
        ({"customer_id": None}, ("INVALID", "Missing customer_id")),
        ({"signup_date": None}, ("SUSPICIOUS", "Missing/invalid signup_date")),
        ({"renewal_date": datetime(2022, 1, 1)}, ("INVALID", "Renewal date earlier than signup date")),
        ({"monthly_fee": None}, ("SUSPICIOUS", "Missing monthly_fee")),
        ({"monthly_fee": float("nan")}, ("SUSPICIOUS", "Missing monthly_fee")),
        ({"monthly_fee": -0.01}, ("INVALID", "Negative monthly_fee")),
        ({"discount_pct": 100.0}, FINE),
        ({"discount_pct": 100.5}, ("INVALID", "Discount_pct outside 0-100 range")),
        ({"discount_pct": -1.0}, ("INVALID", "Discount_pct outside 0-100 range")),
        ({"discount_pct": None}, FINE),
        ({"renewal_date": None}, ("SUSPICIOUS", "Active subscription with missing/implausible renewal date")),
        (
            {"signup_date": EARLY, "renewal_date": datetime(2021, 6, 1), "subscription_status": " aCTIVE "},
            ("SUSPICIOUS", "Active subscription with missing/implausible renewal date"),
        ),
        ({"signup_date": EARLY, "renewal_date": datetime(2021, 6, 3)}, FINE),
        ({"renewal_date": None, "subscription_status": "Cancelled"}, FINE),
        ({"subscription_status": None}, ("SUSPICIOUS", "Missing subscription_status")),
        (
            {"subscription_id": "S1", "customer_id": None, "monthly_fee": None, "subscription_status": None},
            (
                "INVALID",
                "Duplicate subscription_id; Missing customer_id; Missing monthly_fee; Missing subscription_status",
            ),
        ),
    ]
    clean = validators.clean_subscriptions(frame(spark, "subscriptions", *[r for r, _ in rows]), AS_OF)
    assert in_order(clean) == [v for _, v in rows]
    assert clean.where("discount_pct is null").count() == 0
    assert {r[0] for r in clean.select("subscription_status_norm").collect()} == {"Active", "Cancelled", "Nan"}


def test_invoice_rules(spark, subs):
    unknown = "Invoice references non-existent/invalid subscription"
    rows = [
        ({}, FINE),
        ({"invoice_id": None}, ("INVALID", "Missing invoice_id")),
        ({"invoice_id": "I1"}, ("INVALID", "Duplicate invoice_id")),
        ({"subscription_id": "S9"}, ("INVALID", unknown)),
        ({"subscription_id": "S2"}, ("INVALID", unknown)),
        ({"subscription_id": None}, ("INVALID", "Missing subscription_id on invoice")),
        ({"invoice_amount": -1.0}, ("INVALID", "Negative invoice_amount")),
        ({"tax_amount": -1.0}, ("INVALID", "Negative tax_amount")),
        ({"invoice_amount": None}, ("SUSPICIOUS", "Missing invoice_amount")),
        ({"payment_status": None}, ("SUSPICIOUS", "Missing payment_status")),
        ({"payment_status": " paid", "payment_date": None}, ("INVALID", "Paid invoice missing valid payment_date")),
        ({"payment_status": "Failed", "payment_date": None}, FINE),
        ({"payment_date": datetime(2023, 12, 31)}, ("INVALID", "Payment date earlier than invoice date")),
        (
            {"invoice_id": "I1", "subscription_id": "S9", "tax_amount": -1.0, "payment_status": None},
            ("INVALID", f"Duplicate invoice_id; {unknown}; Negative tax_amount; Missing payment_status"),
        ),
    ]
    clean = validators.clean_invoices(frame(spark, "invoices", *[r for r, _ in rows]), subs)
    assert in_order(clean) == [v for _, v in rows]


def test_usage_rules(spark, subs):
    unknown = "Usage record references customer not in subscriptions"
    rows = [
        ({}, FINE),
        ({"usage_id": None}, ("INVALID", "Missing usage_id")),
        ({"usage_id": "U1"}, ("INVALID", "Duplicate usage_id")),
        ({"customer_id": "C9"}, ("INVALID", unknown)),
        ({"customer_id": "C2"}, ("INVALID", unknown)),
        ({"customer_id": None}, ("INVALID", "Missing customer_id on usage record")),
        ({"login_count": -1.0}, ("INVALID", "Negative login_count")),
        ({"active_minutes": -1.0}, ("INVALID", "Negative active_minutes")),
        ({"seat_count": None}, FINE),
        ({}, FINE),
        ({}, FINE),
        ({"seat_count": 900.0}, ("SUSPICIOUS", "Seat_count is a statistical outlier (>99th pct)")),
    ]
    clean = validators.clean_product_usage(frame(spark, "product_usage", *[r for r, _ in rows]), subs)
    assert in_order(clean) == [v for _, v in rows]


def test_few_seat_counts_have_no_outlier(spark, subs):
    rows = [{}] * 9 + [{"seat_count": 900.0}]
    clean = validators.clean_product_usage(frame(spark, "product_usage", *rows), subs)
    assert {r[0] for r in clean.select("record_status").distinct().collect()} == {"VALID"}


def test_case_rules(spark, subs):
    rows = [
        ({}, FINE),
        ({"case_id": None}, ("INVALID", "Missing case_id")),
        ({"case_id": "K1"}, ("INVALID", "Duplicate case_id")),
        ({"customer_id": "C9"}, ("INVALID", "Support case references customer not in subscriptions")),
        ({"customer_id": None}, FINE),
        ({"closed_date": datetime(2023, 12, 31)}, ("INVALID", "Closed date earlier than opened date")),
        ({"resolution_hours": -1.0}, ("INVALID", "Negative resolution_hours")),
        ({"csat_score": 0.5}, ("INVALID", "CSAT score outside 1-5 range")),
        ({"csat_score": 5.5}, ("INVALID", "CSAT score outside 1-5 range")),
        ({"csat_score": None}, FINE),
        ({"closed_date": None}, ("INVALID", "Closed case missing closure date/resolution hours")),
        (
            {"case_status": " RESOLVED", "resolution_hours": None},
            ("INVALID", "Closed case missing closure date/resolution hours"),
        ),
        ({"case_status": "Open", "closed_date": None, "resolution_hours": None}, FINE),
        ({"case_status": None}, ("SUSPICIOUS", "Missing case_status")),
    ]
    raw = frame(spark, "support_cases", *[r for r, _ in rows])
    assert in_order(validators.clean_support_cases(raw, subs)) == [v for _, v in rows]
    strict = in_order(validators.clean_support_cases(raw, subs, require_customer=True))
    assert strict[4] == ("INVALID", "Missing customer_id on support case")


def test_first_row_is_by_load_order(spark):
    rows = [{"source_seq": s, "subscription_id": "S1", "monthly_fee": float(s)} for s in (5, 2, 9)]
    clean = validators.clean_subscriptions(frame(spark, "subscriptions", *rows), AS_OF)
    assert [r.monthly_fee for r in clean.where("record_status = 'VALID'").collect()] == [2.0]


def test_same_marks_without_broadcast(spark, subs, monkeypatch):
    rows = [{"invoice_id": f"I{i % 3 if i < 60 else i}"} for i in range(90)]
    rows += [{"invoice_id": None}] * 40 + [{"subscription_id": s} for s in ["S9"] * 30 + [None] * 20 + ["S8", "S1"]]
    raw = frame(spark, "invoices", *rows)
    broadcast = in_order(validators.clean_invoices(raw, subs))
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    assert in_order(validators.clean_invoices(raw, subs)) == broadcast
    assert sum("Duplicate" in reason for _, reason in broadcast) == 57


def test_null_condition_does_not_hold_and_counts(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, -5)], "id int, x int")
    done = classify(df, [invalid(F.col("x") < 0, "negative"), suspicious(F.col("x") > -9, "any")])
    assert verdicts(done, "id") == {1: FINE, 2: ("SUSPICIOUS", "any"), 3: ("INVALID", "negative; any")}
    assert {tuple(r) for r in status_counts(done).collect()} == {("VALID", 1), ("SUSPICIOUS", 1), ("INVALID", 1)}
    assert {tuple(r) for r in rule_counts(done).collect()} == {("No issues detected", 1), ("any", 2), ("negative", 1)}


def test_classify_without_rules(spark):
    done = classify(spark.range(1), [])
    assert verdicts(done, "id") == {0: FINE}
