"""The executive customer risk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import round_half_up, round_money
from ledgerlens.functions.sums import exact_mean, exact_sum
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.rules import trusted
from ledgerlens.operators.shared import Measured, measure_size
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.plans.health import HIGH_RISK, WATCHLIST
from ledgerlens.plans.metrics import invoice_sums
from ledgerlens.plans.reports import TOP, at_risk, reported_fees, subscription_links

# Figures of a customer beside the summary.
TOTALS = ("total_invoice_value", "support_case_count", "escalation_count")


def invoice_totals(
    invoices: DataFrame, subscriptions: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """Trusted invoice amounts per customer, see ``totals_of_sums``."""
    return totals_of_sums(invoice_sums(invoices, corrections), subscriptions, corrections)


def totals_of_sums(sums: Measured, subscriptions: DataFrame, corrections: Corrections = STANDARD) -> DataFrame:
    """Trusted invoice amounts per customer, counted once per classified row of the subscription id.

    ``sums`` has them per subscription (``invoice_sums``); repeats of the id multiply the sum instead of
    the rows.
    """
    sums = Measured(sums.table.select("subscription_id", "amount"), sums.measures)
    links = subscription_links(subscriptions, corrections)
    # The rows that make the links hold their keys at least as often, and are counted without grouping them first.
    links = sized_join(links, sums, ["subscription_id"], ["customer_id"], "inner", counted=subscriptions)
    total = exact_sum(F.col("amount") * F.col("copies"))
    return links.groupBy("customer_id").agg(total.alias("total_invoice_value"))


def case_totals(cases: DataFrame) -> DataFrame:
    return (
        trusted(cases)
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("support_case_count"),
            F.count_if(F.col("case_status_norm") == "Escalated").alias("escalation_count"),
        )
    )


def priority(mean_mrr: Column) -> Column:
    # The labels.
    high, watch = F.col("risk_category") == HIGH_RISK, F.col("risk_category") == WATCHLIST
    return (
        F.when(at_risk(), "Immediate Action")
        .when(high, "Investigate")
        .when(watch & (F.col("MRR") > mean_mrr), "Monitor Closely")
        .when(watch, "Monitor")
        .otherwise("Low Priority")
    )


def with_totals(
    summary: DataFrame,
    subscriptions: DataFrame,
    invoices: Measured,
    cases: DataFrame,
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """The customer summary with ``TOTALS``, as all reports on customers read it; ``invoices`` as of ``metrics.invoice_sums``."""
    return (
        summary.join(totals_of_sums(invoices, subscriptions, corrections), "customer_id", "left")
        .join(case_totals(cases), "customer_id", "left")
        .withColumns({c: F.coalesce(c, F.lit(0)) for c in TOTALS[1:]})
    )


def executive_summary(customers: DataFrame, raw_subscriptions: DataFrame, corrections: Corrections = STANDARD) -> DataFrame:
    """One row per customer, of the summary ``with_totals``: nothing is joined by customer any more.

    ``reported_mrr`` is the figure of the customer's whole region and plan."""
    place = ["customer_id"] if corrections.reported_per_customer else ["region", "plan_name"]
    reported = reported_fees(raw_subscriptions, *place, corrections=corrections).na.drop(subset=place)
    reported = measure_size(reported, "reported_fees")
    mean_mrr = customers.select(exact_mean(F.col("MRR"))).scalar()
    mrr = round_money(F.col("MRR"))
    return sized_join(customers, reported, place, ["customer_id"]).select(
        "customer_id",
        "region",
        "plan_name",
        "sales_channel",
        round_money(F.col("reported")).alias("reported_mrr"),
        mrr.alias("trusted_mrr"),
        F.coalesce(round_money(F.col("total_invoice_value")), F.lit(0.0)).alias("total_invoice_value"),
        round_half_up(F.col("payment_failure_rate"), 4).alias("payment_failure_rate"),
        "usage_intensity_score",
        "support_case_count",
        "escalation_count",
        round_half_up(F.col("average_csat"), 2).alias("average_csat"),
        "customer_health_score",
        "risk_category",
        F.when(at_risk(), mrr).otherwise(0.0).alias("revenue_at_risk"),
        priority(mean_mrr).alias("recommended_priority"),
    )


def top_at_risk(executive: DataFrame) -> DataFrame:
    return executive.orderBy(F.desc("revenue_at_risk"), "customer_id").limit(TOP)
