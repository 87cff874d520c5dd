"""Small hand-made tables. Every row is fine unless a test says otherwise."""

from __future__ import annotations

from datetime import date, datetime

AS_OF = date(2024, 6, 1)

SCHEMAS = {
    "subscriptions": "source_seq long, subscription_id string, customer_id string, signup_date timestamp_ntz, "
    "renewal_date timestamp_ntz, monthly_fee double, discount_pct double, subscription_status string, "
    "auto_renew string, region string, plan_name string, sales_channel string",
    "invoices": "source_seq long, invoice_id string, subscription_id string, invoice_amount double, tax_amount double, "
    "invoice_date timestamp_ntz, due_date timestamp_ntz, payment_date timestamp_ntz, payment_status string",
    "product_usage": "source_seq long, usage_id string, customer_id string, usage_date timestamp_ntz, login_count double, "
    "active_minutes double, feature_clicks double, reports_created double, data_exports double, seat_count double",
    "support_cases": "source_seq long, case_id string, customer_id string, opened_date timestamp_ntz, "
    "closed_date timestamp_ntz, resolution_hours double, csat_score double, case_status string",
}

DEFAULTS = {
    "subscriptions": dict(
        customer_id="C1",
        signup_date=datetime(2023, 1, 1),
        renewal_date=datetime(2025, 1, 1),
        monthly_fee=100.0,
        discount_pct=10.0,
        subscription_status="Active",
        auto_renew="Y",
        region="North",
        plan_name="Pro",
        sales_channel="Partner",
    ),
    "invoices": dict(
        subscription_id="S1",
        invoice_amount=50.0,
        tax_amount=5.0,
        invoice_date=datetime(2024, 1, 1),
        due_date=datetime(2024, 1, 31),
        payment_date=datetime(2024, 1, 15),
        payment_status="Paid",
    ),
    "product_usage": dict(
        customer_id="C1",
        usage_date=datetime(2024, 1, 1),
        login_count=3.0,
        active_minutes=30.0,
        feature_clicks=5.0,
        reports_created=1.0,
        data_exports=1.0,
        seat_count=4.0,
    ),
    "support_cases": dict(
        customer_id="C1",
        opened_date=datetime(2024, 1, 1),
        closed_date=datetime(2024, 1, 2),
        resolution_hours=5.0,
        csat_score=4.0,
        case_status="Closed",
    ),
}

IDS = {
    "subscriptions": ("subscription_id", "S"),
    "invoices": ("invoice_id", "I"),
    "product_usage": ("usage_id", "U"),
    "support_cases": ("case_id", "K"),
}


def frame(spark, name, *rows):
    """A table of one row per given dict, which replaces defaults; ids count up from 1."""
    key, letter = IDS[name]
    columns = [c.split()[0] for c in SCHEMAS[name].split(", ")]
    data = []
    for i, changes in enumerate(rows, 1):
        row = {"source_seq": i, key: f"{letter}{i}", **DEFAULTS[name], **changes}
        data.append(tuple(row[c] for c in columns))
    return spark.createDataFrame(data, SCHEMAS[name])
