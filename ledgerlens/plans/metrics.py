"""Customer metrics from the rows that are not INVALID.

Each function returns one row per customer it knows something about; ``customer_metrics`` puts
them together. All group on the customer with partial aggregation before the shuffle, so a
customer with a large part of the rows costs no task more than a few rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import MISSING_STATUS, clip, net_fee, round_half_even, share
from ledgerlens.functions.sums import exact_mean, exact_sum, merged_sum, partial_sums, rankable_mean
from ledgerlens.operators.last import FAR, last_rows, microseconds, packed_place
from ledgerlens.operators.ranking import percent_ranks
from ledgerlens.operators.rules import trusted
from ledgerlens.operators.shared import Measured, materialize, measure, measure_size, text_bytes
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.sources.tables import load_order

# What the risk and usage scores are made of.
ENDED = ("Cancelled", "Expired")
IMMINENT_DAYS = 30
ATTRIBUTES = ("region", "plan_name", "sales_channel", "subscription_status_norm")
INVOICE_FACTS = (
    "subscription_id", "invoice_id", "invoice_amount", "payment_status_norm", "record_status", "status_reason",
)
USAGE_COLUMNS = ("login_count", "active_minutes", "feature_clicks", "reports_created", "data_exports")
UNKNOWN_RENEWAL_RISK = 50.0


def _signup_place(subscriptions: DataFrame, order: list[str], corrections: Corrections) -> Column:
    """How late a subscription was signed and loaded.

    No date counts as later than any date; if active ones are preferred, they come after all others and a
    null date before all dates."""
    signup = microseconds(F.col("signup_date"))
    if not corrections.prefer_active:
        return packed_place(subscriptions, F.coalesce(signup, F.lit(FAR)), order)
    active = F.coalesce(F.col("subscription_status_norm") == "Active", F.lit(False))
    moment = F.coalesce(signup, F.lit(-FAR)) + F.when(active, F.lit(2 * FAR)).otherwise(F.lit(0))
    return packed_place(subscriptions, moment, order)


def _subscription_figures(
    subscriptions: DataFrame, as_of: date, corrections: Corrections = STANDARD, place: Column | None = None
) -> DataFrame:
    """``MRR`` sums the net fees of the active ones. In ``renewal_risk_score`` ended subscriptions

    weigh 60, those that do not renew by themselves 25 and a renewal due soon 15; a date in the past
    counts as due. With ``place``, also its greatest value as ``_last``."""
    status = F.col("subscription_status_norm")
    active = status == "Active"
    fee = net_fee(F.col("monthly_fee"), F.col("discount_pct"))
    days = F.datediff("renewal_date", F.lit(as_of))
    if corrections.upcoming_renewals_only:
        days = F.when(days >= 0, days)
    stats = (
        trusted(subscriptions)
        .groupBy("customer_id")
        .agg(
            F.count_if(active).alias("active"),
            exact_sum(F.when(active, fee)).alias("fees"),
            share(status.isin(*ENDED)).alias("ended"),
            share(~F.upper("auto_renew").eqNullSafe("Y")).alias("manual"),
            F.min(days).alias("days"),
            *([F.max(place).alias("_last")] if place is not None else []),
        )
    )
    imminent = F.when(F.col("days") <= IMMINENT_DAYS, 15).otherwise(0)
    risk = F.col("ended") * 60 + F.col("manual") * 25 + imminent
    return stats.select(
        "customer_id",
        F.when(F.col("active") > 0, F.coalesce("fees", F.lit(0.0))).alias("MRR"),
        clip(round_half_even(risk), 0.0, 100.0).alias("renewal_risk_score"),
        *(["_last"] if place is not None else []),
    )


def subscription_metrics(
    subscriptions: DataFrame,
    as_of: date,
    order: tuple[str, ...] = ("source_seq",),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """All that comes from the trusted subscriptions.

    The figures and the attributes of the latest signup; of equal dates the row loaded last is taken.
    The figures are written, and the rows at the greatest place of their customer are joined to them.
    """
    order = load_order(subscriptions, order)
    place = _signup_place(subscriptions, order, corrections)
    figures = _subscription_figures(subscriptions, as_of, corrections, place)
    figures = measure(figures, "subscription_figures", rows=F.count(F.lit(1)), bytes=text_bytes(figures))
    rows = trusted(subscriptions).select("customer_id", *order, *ATTRIBUTES, place.alias("_place"))
    return last_rows(rows, figures, "customer_id", "_place", "_last", order)


def recurring_revenue(subscriptions: DataFrame, as_of: date) -> DataFrame:
    revenue = _subscription_figures(subscriptions, as_of).select("customer_id", "MRR")
    return revenue.where(F.col("MRR").isNotNull())


def renewal_risk(subscriptions: DataFrame, as_of: date) -> DataFrame:
    return _subscription_figures(subscriptions, as_of).select("customer_id", "renewal_risk_score")


def latest_attributes(subscriptions: DataFrame, as_of: date, order: tuple[str, ...] = ("source_seq",)) -> DataFrame:
    return subscription_metrics(subscriptions, as_of, order).select("customer_id", *ATTRIBUTES)


def _has_status(column: str, corrections: Corrections) -> Column:
    """Whether a row counts in the rates of its status column."""
    return F.col(column) != MISSING_STATUS if corrections.ignore_missing_status else F.lit(True)


def invoice_sums(invoices: DataFrame, corrections: Corrections = STANDARD) -> Measured:
    """What customers need of the trusted invoices: sums and counts per subscription, written.

    The invoices are classified and shuffled once for all figures. Those without a subscription are no one's.
    """
    paid = F.col("payment_status_norm") == "Paid"
    amount = F.when(paid, F.col("invoice_amount"))
    sums = (
        trusted(invoices)
        .where(F.col("subscription_id").isNotNull())
        .groupBy("subscription_id")
        .agg(
            *partial_sums(amount, "paid"),
            F.count(amount).alias("paid_count"),
            F.count_if(_has_status("payment_status_norm", corrections)).alias("invoices"),
            F.count_if(F.col("payment_status_norm") == "Failed").alias("failed"),
            exact_sum(F.col("invoice_amount")).alias("amount"),
        )
    )
    return measure_size(sums, "invoice_sums")


def _invoices_per_customer(sums: Measured, subscriptions: DataFrame) -> DataFrame:
    """Invoice sums and counts per customer, of ``invoice_sums``.

    What is joined has one row per subscription on either side.
    """
    owners = trusted(subscriptions).select("subscription_id", "customer_id")
    return (
        sums.table.drop("amount").join(owners, "subscription_id")
        .groupBy("customer_id")
        .agg(
            merged_sum("paid").alias("paid_sum"),
            *[F.sum(c).alias(c) for c in ("paid_count", "invoices", "failed")],
        )
    )


def payments(invoices: DataFrame, subscriptions: DataFrame, corrections: Corrections = STANDARD) -> DataFrame:
    """Mean paid invoice, and the part of all invoices whose payment failed."""
    return payments_of_sums(invoice_sums(invoices, corrections), subscriptions)


def payments_of_sums(sums: Measured, subscriptions: DataFrame) -> DataFrame:
    return _invoices_per_customer(sums, subscriptions).select(
        "customer_id",
        F.try_divide("paid_sum", "paid_count").alias("effective_monthly_revenue"),
        F.try_divide("failed", "invoices").alias("payment_failure_rate"),
    )


def effective_revenue(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    revenue = payments(invoices, subscriptions).select("customer_id", "effective_monthly_revenue")
    return revenue.where(F.col("effective_monthly_revenue").isNotNull())


def payment_failure(invoices: DataFrame, subscriptions: DataFrame) -> DataFrame:
    return payments(invoices, subscriptions).select("customer_id", "payment_failure_rate")


def usage_intensity(usage: DataFrame) -> DataFrame:
    """Mean percentile rank, among all customers with usage, of five average usage figures; 0 to 100."""
    means = (
        trusted(usage)
        .groupBy("customer_id")
        .agg(*[rankable_mean(F.col(c).cast("double")).alias(c) for c in USAGE_COLUMNS])
    )
    ranks = percent_ranks(materialize(means, "usage_means"), "customer_id", USAGE_COLUMNS)
    known = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in USAGE_COLUMNS), F.lit(0))
    total = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in USAGE_COLUMNS), F.lit(0.0))
    score = round_half_even(F.try_divide(total, known) * 100)
    return ranks.select("customer_id", score.alias("usage_intensity_score"))


def support(cases: DataFrame, corrections: Corrections = STANDARD) -> DataFrame:
    """The part of the customer's cases that were escalated, and the mean CSAT score."""
    return (
        trusted(cases)
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.try_divide(
                F.count_if(F.col("case_status_norm") == "Escalated"),
                F.count_if(_has_status("case_status_norm", corrections)),
            ).alias("support_escalation_rate"),
            exact_mean(F.col("csat_score")).alias("average_csat"),
        )
    )


def escalation(cases: DataFrame) -> DataFrame:
    return support(cases).select("customer_id", "support_escalation_rate")


def satisfaction(cases: DataFrame) -> DataFrame:
    return support(cases).select("customer_id", "average_csat")


def customer_metrics(
    subscriptions: DataFrame,
    invoices: Measured,
    usage_scores: DataFrame,
    cases: DataFrame,
    as_of: date,
    order: tuple[str, ...] = ("source_seq",),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    """One row per customer with all metrics and attributes; ``usage_scores`` as of ``usage_intensity``,
    ``invoices`` as of ``invoice_sums``.

    Usage and cases of customers without a trusted subscription are INVALID, so the customers of
    the trusted subscriptions are all there are. Missing figures become 0, a missing CSAT the mean
    over the customers that have one.
    """
    found = (
        subscription_metrics(subscriptions, as_of, order, corrections)
        .join(payments_of_sums(invoices, subscriptions), "customer_id", "left")
        .join(usage_scores, "customer_id", "left")
        .join(support(cases, corrections), "customer_id", "left")
    )
    found = materialize(found, "metrics")
    flags = []
    if corrections.activity_flags:
        flags.append(F.col("usage_intensity_score").isNotNull().alias("has_usage"))
        flags.append(F.col("payment_failure_rate").isNotNull().alias("has_invoices"))
    mean_csat = found.select(exact_mean(F.col("average_csat"))).scalar()

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0.0)).alias(name)

    return found.select(
        "customer_id",
        or_zero("MRR"),
        or_zero("effective_monthly_revenue"),
        or_zero("payment_failure_rate"),
        or_zero("usage_intensity_score"),
        or_zero("support_escalation_rate"),
        F.coalesce("average_csat", mean_csat).alias("average_csat"),
        F.coalesce("renewal_risk_score", F.lit(UNKNOWN_RENEWAL_RISK)).alias("renewal_risk_score"),
        *ATTRIBUTES,
        *flags,
    )
