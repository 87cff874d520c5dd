"""What the four audited tables look like."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class TableSpec:
    """Column roles of one audited table.

    ``order`` names the columns that put the rows in load order, which decides which of several
    rows with the same id counts as the first. Together they must tell any two rows apart.
    """

    id: str
    numbers: tuple[str, ...]
    timestamps: tuple[str, ...]
    text: tuple[str, ...]
    status: str | None = None
    order: tuple[str, ...] = ("source_seq",)

    @property
    def columns(self) -> tuple[str, ...]:
        status = (self.status,) if self.status else ()
        return (self.id, *self.text, *self.timestamps, *self.numbers, *status)


TABLES: dict[str, TableSpec] = {
    "subscriptions": TableSpec(
        id="subscription_id",
        numbers=("monthly_fee", "discount_pct"),
        timestamps=("signup_date", "renewal_date"),
        text=("customer_id", "auto_renew", "region", "plan_name", "sales_channel"),
        status="subscription_status",
    ),
    "invoices": TableSpec(
        id="invoice_id",
        numbers=("invoice_amount", "tax_amount"),
        timestamps=("invoice_date", "due_date", "payment_date"),
        text=("subscription_id",),
        status="payment_status",
    ),
    "product_usage": TableSpec(
        id="usage_id",
        numbers=(
            "login_count",
            "active_minutes",
            "feature_clicks",
            "reports_created",
            "data_exports",
            "seat_count",
        ),
        timestamps=("usage_date",),
        text=("customer_id",),
    ),
    "support_cases": TableSpec(
        id="case_id",
        numbers=("resolution_hours", "csat_score"),
        timestamps=("opened_date", "closed_date"),
        text=("customer_id",),
        status="case_status",
    ),
}
