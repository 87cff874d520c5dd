"""Customer health score and risk category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import clip, round_half_even
from ledgerlens.operators.ranking import add_percent_ranks

# Weight of each of the four parts, and the categories.
WEIGHT = 0.25
HIGH_RISK, WATCHLIST, HEALTHY = "High Risk", "Watchlist", "Healthy"


def risk_category(score: Column) -> Column:
    """Up to 40 is high risk, up to 70 watchlist, up to 100 healthy; anything else has no category."""
    return (
        F.when(score <= -0.01, F.lit(None))
        .when(score <= 40, HIGH_RISK)
        .when(score <= 70, WATCHLIST)
        .when(score <= 100, HEALTHY)
    )


def with_health(metrics: DataFrame) -> DataFrame:
    """Add ``customer_health_score``, usage, payment, support and renewal in equal parts, and

    ``risk_category``."""
    ranked = add_percent_ranks(metrics, "customer_id", ["average_csat"], ["_csat_rank"])
    usage = clip(F.col("usage_intensity_score"), 0.0, 100.0)
    payment = (1 - clip(F.col("payment_failure_rate"), 0.0, 1.0)) * 100
    escalation = (1 - clip(F.col("support_escalation_rate"), 0.0, 1.0)) * 100
    support = (F.col("_csat_rank") * 100 + escalation) / 2
    renewal = 100 - clip(F.col("renewal_risk_score"), 0.0, 100.0)
    score = usage * WEIGHT + payment * WEIGHT + support * WEIGHT + renewal * WEIGHT
    return (
        ranked.withColumn("customer_health_score", round_half_even(score))
        .withColumn("risk_category", risk_category(F.col("customer_health_score")))
        .drop("_csat_rank")
    )
