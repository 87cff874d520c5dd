"""The business questions on trusted revenue, usage, discounts, risk and contradictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import net_fee, normalise_status, parse_number, round_half_up, round_money, share
from ledgerlens.functions.sums import exact_mean, exact_sum
from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.rules import INVALID, trusted
from ledgerlens.operators.selection import not_before, row_at, tile_start
from ledgerlens.operators.shared import materialize, measure_size, together
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.plans.health import HIGH_RISK
from ledgerlens.sources.tables import load_order

TOP = 20
# Two means of percentages are equal if they agree to so many decimals; doubles of this size have more.
COMPARED_DIGITS = 10
# Reasons of the rules, and below the kinds and descriptions of contradictions with their limits.
PAYMENT_DATE_MISSING = "Paid invoice missing valid payment_date"
PAYMENT_DATE_EARLY = "Payment date earlier than invoice date"


def is_active() -> Column:
    return F.col("subscription_status_norm") == "Active"


def at_risk() -> Column:
    """An active high-risk customer with revenue to lose."""
    return is_active() & (F.col("risk_category") == HIGH_RISK) & (F.col("MRR") > 0)


# Reported against trusted revenue


def is_cancelled(corrections: Corrections) -> Column:
    ended = ("Cancelled", "Expired") if corrections.expired_is_cancelled else ("Cancelled",)
    return F.col("subscription_status_norm").isin(*ended)


def reported_active(corrections: Corrections = STANDARD) -> Column:
    """Raw rows that the reported figures count: those whose status is exactly 'Active'."""
    status = F.col("subscription_status")
    return (normalise_status(status) if corrections.normalise_reported_status else status) == "Active"


def reported_fees(raw_subscriptions: DataFrame, *keys: str, corrections: Corrections = STANDARD) -> DataFrame:
    """Fees as reported, nothing excluded."""
    active = raw_subscriptions.where(reported_active(corrections))
    fee = parse_number(raw_subscriptions, "monthly_fee")
    return active.groupBy(*keys).agg(exact_sum(fee).alias("reported"))


def trusted_fees(subscriptions: DataFrame, *keys: str) -> DataFrame:
    """Net fees of the active subscriptions that are not INVALID."""
    active = trusted(subscriptions).where(is_active())
    fee = net_fee(F.col("monthly_fee"), F.col("discount_pct"))
    return active.groupBy(*keys).agg(exact_sum(fee).alias("trusted"))


def overstatement_pct(reported: Column, trusted_: Column) -> Column:
    """By how many percent of itself the reported figure exceeds the trusted one; 0 if nothing was reported."""
    reported, trusted_ = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (reported, trusted_))
    return F.when(reported == 0, 0.0).otherwise(round_half_up((reported - trusted_) / reported * 100, 2))


def trusted_vs_reported(
    raw_subscriptions: DataFrame, subscriptions: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """Reported and trusted MRR by region and plan.

    A missing region or plan equals no other, so such groups give a row per side.
    """
    keys = ("region", "plan_name")
    r = reported_fees(raw_subscriptions, *keys, corrections=corrections).alias("r")
    t = trusted_fees(subscriptions, *keys).alias("t")
    if corrections.match_missing_groups:
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    else:
        same = [F.col(f"r.{k}") == F.col(f"t.{k}") for k in keys]
    return (
        r.join(t, same, "full_outer")
        .select(
            *[F.coalesce(f"r.{k}", f"t.{k}").alias(k) for k in keys],
            F.coalesce(round_money(F.col("reported")), F.lit(0.0)).alias("reported_mrr"),
            F.coalesce(round_money(F.col("trusted")), F.lit(0.0)).alias("trusted_mrr"),
            overstatement_pct(F.col("reported"), F.col("trusted")).alias("revenue_overstatement_pct"),
        )
        .orderBy(F.desc("revenue_overstatement_pct"), F.asc_nulls_first("region"), F.asc_nulls_first("plan_name"))
    )


# High revenue, low usage, many escalations


def high_revenue_low_usage(customers: DataFrame) -> DataFrame:
    """Of the summary with each customer's ``escalation_count``: customers in the top fifth by revenue and the lowest three tenths by usage, with more

    escalations than the average customer. Equal figures are put in order of customer id."""
    revenue, usage = "effective_monthly_revenue", "usage_intensity_score"
    top, low = together(
        lambda: row_at(customers, revenue, "customer_id", 0.8, lambda n: tile_start(n, 5, 5)),
        lambda: row_at(customers, usage, "customer_id", 0.3, lambda n: tile_start(n, 10, 4)),
    )
    wanted = not_before(revenue, "customer_id", top) & ~not_before(usage, "customer_id", low)
    average = customers.agg(F.avg("escalation_count")).scalar()
    return (
        customers.where((F.col("escalation_count") > average) & wanted)
        .orderBy(F.desc("effective_monthly_revenue"), "customer_id")
        .select(
            "customer_id",
            round_half_up(F.col("effective_monthly_revenue"), 2).alias("revenue"),
            "plan_name",
            F.col("usage_intensity_score").alias("usage_score"),
            "escalation_count",
            round_half_up(F.col("average_csat"), 2).alias("csat"),
            F.col("customer_health_score").alias("health_score"),
        )
    )


# Discounts that do not keep customers


def discount_vs_retention(
    subscriptions: DataFrame, summary: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """Plans with a discount above and a renewal rate below the mean over the plans."""
    fee = F.when(is_active(), net_fee(F.col("monthly_fee"), F.col("discount_pct"))).otherwise(F.lit(0.0))
    plans = (
        trusted(subscriptions)
        .where(F.col("plan_name").isNotNull())
        .groupBy("plan_name")
        .agg(
            exact_mean(F.col("discount_pct")).alias("discount"),
            share(is_active()).alias("renewal"),
            share(is_cancelled(corrections)).alias("cancellation"),
            exact_sum(fee).alias("fees"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    plans = materialize(plans, "plan_stats")
    score = F.col("customer_health_score")
    health = summary.where(F.col("plan_name").isNotNull()).groupBy("plan_name").agg(exact_mean(score).alias("health"))

    def beyond(column: str) -> Column:
        """How far a plan's figure lies above the company's, with no more digits than both have:

        a plan that equals the mean is neither above nor below it."""
        if corrections.weigh_plans:
            company = plans.select(exact_sum(F.col(column) * F.col("rows")) / F.sum("rows")).scalar()
        else:
            company = plans.select(exact_mean(F.col(column))).scalar()
        return F.round(F.col(column) - company, COMPARED_DIGITS)

    return (
        plans.where((beyond("discount") > 0) & (beyond("renewal") < 0))
        .join(health, "plan_name")
        .orderBy(F.desc("discount"), "plan_name")
        .select(
            "plan_name",
            round_half_up(F.col("discount"), 2).alias("avg_discount_pct"),
            round_half_up(F.col("renewal") * 100, 2).alias("renewal_rate_pct"),
            round_half_up(F.col("cancellation") * 100, 2).alias("cancellation_rate_pct"),
            round_half_up(F.col("health"), 2).alias("avg_health_score"),
            round_money(F.col("fees")).alias("trusted_mrr"),
        )
    )


# Revenue at risk


def revenue_at_risk(summary: DataFrame, key: str) -> DataFrame:
    return (
        summary.where(at_risk())
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("at_risk_customers"),
            round_money(exact_sum(F.col("MRR"))).alias("revenue_at_risk"),
        )
        .orderBy(F.desc("revenue_at_risk"), F.asc_nulls_first(key))
    )


# Contradictions


def _text(value: Column) -> Column:
    """A figure below a thousand as text, with at least one decimal."""
    return value.cast("string")


def _whole_text(value: Column) -> Column:
    """A rounded figure as text, in exponent form only from 10^28 on."""
    whole = F.round(value.try_cast("decimal(38,9)"), 0).cast("decimal(29,0)").cast("string")
    return F.coalesce(F.concat(whole, F.lit(".0")), value.cast("string"))


def _branches(summary: DataFrame) -> dict[str, tuple[Column, str, Column, Column]]:
    """Condition, kind, description and impact of the contradictions a customer can show."""
    usage, revenue = F.col("usage_intensity_score"), F.col("effective_monthly_revenue")
    failed, escalated = F.col("payment_failure_rate"), F.col("support_escalation_rate")
    csat, health = F.col("average_csat"), F.col("customer_health_score")
    mean_usage = summary.select(exact_mean(usage)).scalar()
    mean_revenue = summary.select(exact_mean(revenue)).scalar()
    return {
        "failed_payments": (
            is_active() & (failed > 0.5),
            "Active subscription with repeated failed payments",
            F.concat(
                F.lit("Payment failure rate "),
                _text(round_half_up(failed * 100, 1)),
                F.lit("% while subscription is Active"),
            ),
            F.col("MRR"),
        ),
        "cancelled_with_usage": (
            (F.col("subscription_status_norm") == "Cancelled") & (usage > mean_usage),
            "High product usage but cancelled",
            F.concat(
                F.lit("Usage intensity "), _text(usage), F.lit(" (above company average) yet subscription Cancelled")
            ),
            revenue,
        ),
        "enterprise_low_usage": (
            (F.col("plan_name") == "Enterprise") & (usage < 25),
            "Low usage on Enterprise plan",
            F.concat(F.lit("Usage intensity only "), _text(usage), F.lit(" on an Enterprise contract")),
            revenue,
        ),
        "satisfied_but_escalating": (
            (csat >= 4) & (escalated > 0.3),
            "High CSAT despite repeated escalations",
            F.concat(
                F.lit("Average CSAT "),
                _text(round_half_up(csat, 1)),
                F.lit(" but escalation rate "),
                _text(round_half_up(escalated * 100, 1)),
                F.lit("%"),
            ),
            revenue,
        ),
        "rich_but_unhealthy": (
            (health < 30) & (revenue > mean_revenue * 1.5),
            "High revenue customer with very poor health score",
            F.concat(F.lit("Revenue "), _whole_text(revenue), F.lit(" with health score "), _text(health)),
            revenue,
        ),
    }


CUSTOMER_CONTRADICTIONS = (
    "failed_payments",
    "cancelled_with_usage",
    "enterprise_low_usage",
    "satisfied_but_escalating",
    "rich_but_unhealthy",
)


def customer_contradictions(summary: DataFrame, *names: str) -> DataFrame:
    """The named contradictions (all by default) in one pass over the customers."""
    branches = _branches(summary)
    found = [
        F.when(
            condition,
            F.struct(
                F.lit(kind).alias("contradiction_type"),
                description.alias("description"),
                impact.alias("financial_impact"),
            ),
        )
        for condition, kind, description, impact in (branches[n] for n in names or CUSTOMER_CONTRADICTIONS)
    ]
    rows = summary.select("customer_id", F.explode(F.array(*found)).alias("found"))
    return rows.where(F.col("found").isNotNull()).select("customer_id", "found.*")


def subscription_links(subscriptions: DataFrame, corrections: Corrections = STANDARD) -> DataFrame:
    """How many classified rows, INVALID ones included, tie a subscription id to a customer."""
    if corrections.trusted_links_only:
        subscriptions = trusted(subscriptions)
    linked = subscriptions.where(F.col("subscription_id").isNotNull())
    return linked.groupBy("subscription_id", "customer_id").agg(F.count(F.lit(1)).alias("copies"))


def _bad_paid_invoices(invoices: DataFrame, corrections: Corrections) -> DataFrame:
    bad = (F.col("payment_status_norm") == "Paid") & (F.col("record_status") == INVALID)
    if corrections.payment_dates_only:
        reason = F.col("status_reason")
        bad = bad & (reason.contains(PAYMENT_DATE_MISSING) | reason.contains(PAYMENT_DATE_EARLY))
    return invoices.where(bad & F.col("subscription_id").isNotNull())


def _invoice_rows(linked: DataFrame) -> DataFrame:
    """The contradictions of invoices joined to customers, each written out ``copies`` times."""
    chunk = 1000
    chunks = F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / chunk))
    rest = F.least(F.lit(chunk), F.col("copies") - F.col("_chunk") * chunk)
    return (
        linked.select("*", F.explode(chunks).alias("_chunk"))
        .select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), rest)))
        .select(
            "customer_id",
            F.lit("Paid invoice with invalid payment timeline").alias("contradiction_type"),
            F.concat(F.lit("Invoice "), "invoice_id", F.lit(": "), "status_reason").alias("description"),
            F.col("invoice_amount").alias("financial_impact"),
        )
    )


def invoice_contradictions(
    invoices: DataFrame,
    subscriptions: DataFrame,
    order: tuple[str, ...] = ("source_seq",),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """INVALID paid invoices, once per classified row of their subscription id.

    Subscription rows of one id and customer are counted before the join and written out after it.
    """
    bad = _bad_paid_invoices(invoices, corrections)
    order = load_order(bad, order)
    bad = bad.select("subscription_id", "invoice_id", "status_reason", "invoice_amount", F.xxhash64(*order).alias("_row"))
    bad, links = together(
        lambda: materialize(bad, "bad_paid_invoices"),
        lambda: measure_size(subscription_links(subscriptions, corrections), "subscription_links"),
    )
    return _invoice_rows(sized_join(bad, links, ["subscription_id"], ["_row"], "inner"))


def contradictions(
    summary: DataFrame,
    invoices: DataFrame,
    subscriptions: DataFrame,
    order: tuple[str, ...] = ("source_seq",),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """All contradictions, unordered."""
    found = invoice_contradictions(invoices, subscriptions, order, corrections)
    return customer_contradictions(summary).unionByName(found)


def top_contradictions(
    summary: DataFrame, invoices: DataFrame, subscriptions: DataFrame, corrections: Corrections = STANDARD
) -> DataFrame:
    """The twenty contradictions with the largest impact.

    Every invoice that is tied to a customer at all gives at least one row, so an invoice below the
    twentieth largest of these amounts cannot be among the first twenty rows, and of equal rows no
    more than twenty can be. Only the rest is joined to the customers.
    """
    row = ["subscription_id", "invoice_id", "status_reason", "invoice_amount"]
    bad = _bad_paid_invoices(invoices, corrections).where(F.col("invoice_amount").isNotNull())
    bad = bad.groupBy(*row).agg(F.count(F.lit(1)).alias("rows"))
    bad, links = together(
        lambda: materialize(bad, "bad_paid_invoices"),
        lambda: measure_size(subscription_links(subscriptions, corrections), "subscription_links"),
    )
    tied = sized_join(bad, links, ["subscription_id"], row, "left_semi")
    largest = tied.select("invoice_amount").orderBy(F.desc("invoice_amount")).limit(TOP)
    candidates = bad.where(F.col("invoice_amount") >= largest.agg(F.min("invoice_amount")).scalar())
    linked = sized_join(candidates, links, ["subscription_id"], row, "inner")
    linked = linked.withColumn("copies", F.least(F.col("rows") * F.col("copies"), F.lit(TOP)))
    found = customer_contradictions(summary).unionByName(_invoice_rows(linked))
    ties = [F.asc_nulls_first(c) for c in ("customer_id", "contradiction_type", "description")]
    return found.where(F.col("financial_impact").isNotNull()).orderBy(F.desc("financial_impact"), *ties).limit(TOP)
