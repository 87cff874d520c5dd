"""The data sets behind the executive dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import net_fee, parse_number, round_half_up, round_money
from ledgerlens.functions.sums import exact_sum, mean_of, merged_sums, partial_sums, summed
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.lattice import subtotals
from ledgerlens.operators.ranking import running_total
from ledgerlens.operators.rules import INVALID, trusted
from ledgerlens.operators.shared import materialize, measure_size
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.plans.health import HIGH_RISK
from ledgerlens.plans.reports import (
    TOP,
    at_risk,
    is_active,
    is_cancelled,
    overstatement_pct,
    reported_active,
    reported_fees,
    trusted_fees,
)


def _sum_cents(column: Column) -> Column:
    return round_money(exact_sum(column))


def _revenue_at_risk() -> Column:
    return F.coalesce(_sum_cents(F.when(at_risk(), F.col("MRR"))), F.lit(0.0))


def region_ranking(
    raw_subscriptions: DataFrame, subscriptions: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """Regions from the most to the least overstated; rows without a region are one region."""
    r = reported_fees(raw_subscriptions, "region", corrections=corrections).alias("r")
    t = trusted_fees(subscriptions, "region").alias("t")
    regions = r.join(t, F.col("r.region").eqNullSafe(F.col("t.region")), "full_outer").select(
        F.coalesce("r.region", "t.region").alias("region"),
        F.coalesce(round_money(F.col("reported")), F.lit(0.0)).alias("reported_mrr"),
        F.coalesce(round_money(F.col("trusted")), F.lit(0.0)).alias("trusted_mrr"),
        overstatement_pct(F.col("reported"), F.col("trusted")).alias("revenue_overstatement_pct"),
    )
    regions = materialize(regions, "regions")
    # Regions are free text and may be many: rank the distinct percentages, which are cut into ranges.
    counts = regions.groupBy(F.col("revenue_overstatement_pct").alias("pct")).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_total(counts.withColumn("down", -F.col("pct")).withColumn("all", F.lit(0)), ["all"], ["down"], "n", "before", "total")
    ranks = ranked.table.select(F.col("pct").alias("revenue_overstatement_pct"), (F.col("before") + 1).cast("int").alias("overstatement_rank"))
    ranks = measure_size(ranks, "overstatement_ranks")
    joined = sized_join(regions, ranks, ["revenue_overstatement_pct"], ["region"], "inner")
    return joined.select(*regions.columns, "overstatement_rank").orderBy("overstatement_rank", F.asc_nulls_first("region"))


def kpis(
    raw_subscriptions: DataFrame,
    subscriptions: DataFrame,
    summary: DataFrame,
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """One row with the headline figures."""
    fee = net_fee(F.col("monthly_fee"), F.col("discount_pct"))
    reported = raw_subscriptions.where(reported_active(corrections)).agg(
        exact_sum(parse_number(raw_subscriptions, "monthly_fee")).alias("reported")
    )
    subs = trusted(subscriptions).agg(
        exact_sum(F.when(is_active(), fee)).alias("trusted"),
        round_half_up(F.try_divide(F.count_if(is_active()), F.count(F.lit(1))) * 100, 2).alias("renewal_rate_pct"),
    )
    customers = summary.agg(
        _revenue_at_risk().alias("revenue_at_risk"),
        round_half_up(F.try_divide(F.count_if(F.col("risk_category") == HIGH_RISK), F.count(F.lit(1))) * 100, 2).alias(
            "high_risk_customers_pct"
        ),
    )
    reported, trusted_ = reported.scalar(), F.col("trusted")
    return subs.select(
        F.coalesce(round_money(reported), F.lit(0.0)).alias("reported_mrr"),
        F.coalesce(round_money(trusted_), F.lit(0.0)).alias("trusted_mrr"),
        overstatement_pct(reported, trusted_).alias("revenue_overstatement_pct"),
        customers.select("revenue_at_risk").scalar().alias("revenue_at_risk"),
        customers.select("high_risk_customers_pct").scalar().alias("high_risk_customers_pct"),
        "renewal_rate_pct",
    )


def customer_points(executive: DataFrame) -> DataFrame:
    """Per customer what the scatter plot of revenue against health shows."""
    return executive.select(
        "customer_id", "trusted_mrr", "customer_health_score", "support_case_count", "risk_category"
    )


def region_plan_matrix(
    subscriptions: DataFrame, summary: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """Region and plan with subtotals; ``level`` is 0 for a cell, 1 for a region, 3 for the total.

    Rows are summed into cells; the subtotals are made of the cells.
    """
    keys = ["region", "plan_name"]
    fee = F.when(is_active(), net_fee(F.col("monthly_fee"), F.col("discount_pct")))
    counts = {"rows": F.lit(True), "active": is_active(), "cancelled": is_cancelled(corrections)}
    subs = subtotals(
        trusted(subscriptions),
        keys,
        [*partial_sums(fee, "fees"), *[F.count_if(condition).alias(name) for name, condition in counts.items()]],
        [*merged_sums("fees"), *[F.sum(c).alias(c) for c in counts]],
    )
    customers = subtotals(
        summary,
        keys,
        [*partial_sums(F.col("customer_health_score"), "score"), *partial_sums(F.when(at_risk(), F.col("MRR")), "risk")],
        [*merged_sums("score"), *merged_sums("risk")],
    )
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"c.{k}")) for k in (*keys, "level")]
    return subs.alias("s").join(customers.alias("c"), same, "left").select(
        *[f"s.{k}" for k in (*keys, "level")],
        F.coalesce(round_money(summed("fees")), F.lit(0.0)).alias("trusted_mrr"),
        round_half_up(F.col("active") / F.col("rows") * 100, 2).alias("renewal_rate_pct"),
        round_half_up(F.col("cancelled") / F.col("rows") * 100, 2).alias("cancellation_rate_pct"),
        round_half_up(mean_of("score"), 2).alias("avg_health_score"),
        F.coalesce(round_money(summed("risk")), F.lit(0.0)).alias("revenue_at_risk"),
    )


def monthly_revenue(invoices: DataFrame) -> DataFrame:
    """Invoiced amounts by month of invoice: all of them, and those that are not INVALID."""
    amount = F.col("invoice_amount")
    return (
        invoices.where(F.col("invoice_date").isNotNull())
        .groupBy(F.date_trunc("month", "invoice_date").cast("date").alias("month"))
        .agg(
            F.coalesce(round_money(exact_sum(amount)), F.lit(0.0)).alias("reported_revenue"),
            F.coalesce(round_money(exact_sum(F.when(F.col("record_status") != INVALID, amount))), F.lit(0.0)).alias(
                "trusted_revenue"
            ),
        )
        .orderBy("month")
    )


def customers_to_act_on(executive: DataFrame, summary: DataFrame) -> DataFrame:
    """The twenty customers with most revenue at risk, the unhealthier first among equals."""
    revenue = summary.select("customer_id", round_half_up(F.col("effective_monthly_revenue"), 2).alias("revenue"))
    return (
        executive.join(revenue, "customer_id")
        .orderBy(F.desc("revenue_at_risk"), "customer_health_score", "customer_id")
        .limit(TOP)
        .select(
            "customer_id",
            "plan_name",
            "revenue",
            F.col("usage_intensity_score").alias("usage_score"),
            "escalation_count",
            F.col("average_csat").alias("csat"),
            F.col("customer_health_score").alias("health_score"),
            "revenue_at_risk",
        )
    )


def region_plan_customer(executive: DataFrame) -> DataFrame:
    """Drill-down from the total over region and plan to the customer.

    ``level`` is 7 for the total, 3 for a region, 1 for a plan in a region and 0 for a customer. Customers
    are unique: they are their own level, and the levels above are made of the cells that sum them.
    """
    keys = ["region", "plan_name"]
    money, risk, score = F.col("trusted_mrr"), F.col("revenue_at_risk"), F.col("customer_health_score")
    names = ("fees", "risk", "score")
    above = subtotals(
        executive,
        keys,
        [
            F.count(F.lit(1)).alias("customers"),
            F.sum("escalation_count").alias("escalation_count"),
            *[p for column, name in zip((money, risk, score), names) for p in partial_sums(column, name)],
        ],
        [*[F.sum(c).alias(c) for c in ("customers", "escalation_count")], *[m for name in names for m in merged_sums(name)]],
    )
    columns = [*keys, "customer_id", "level", "customers", "trusted_mrr", "avg_health_score", "escalation_count", "revenue_at_risk"]
    above = above.select(
        *keys,
        F.lit(None).cast(executive.schema["customer_id"].dataType).alias("customer_id"),
        (F.col("level") * 2 + 1).alias("level"),
        "customers",
        round_money(summed("fees")).alias("trusted_mrr"),
        round_half_up(mean_of("score"), 2).alias("avg_health_score"),
        "escalation_count",
        round_money(summed("risk")).alias("revenue_at_risk"),
    )
    own = executive.select(
        *keys,
        "customer_id",
        F.lit(0).alias("level"),
        F.lit(1).cast("long").alias("customers"),
        round_money(money).alias("trusted_mrr"),
        round_half_up(score, 2).alias("avg_health_score"),
        F.col("escalation_count").cast("long").alias("escalation_count"),
        round_money(risk).alias("revenue_at_risk"),
    )
    return own.select(*columns).unionByName(above.select(*columns))
