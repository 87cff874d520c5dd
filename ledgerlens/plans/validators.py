"""Classification of the four tables, one function each.

Every function keeps all rows, turns text columns into dates and numbers (null where that fails),
and adds ``record_status``, ``status_reason`` and, where the table has one, a normalised status. The
reason texts, severities and limits of the rules are fixed values, as results show them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import normalise_status, parse_number, parse_timestamp
from ledgerlens.operators.marks import mark_repeats, mark_unknown, repeated_keys, unknown_keys
from ledgerlens.operators.rules import INVALID, Rule, classify, decided, invalid, suspicious, trusted
from ledgerlens.operators.selection import percentile
from ledgerlens.operators.shared import together
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.sources.schemas import TABLES, TableSpec
from ledgerlens.sources.tables import load_order

LONGEST_RENEWAL_LAG = timedelta(days=3 * 365)
SEAT_PERCENTILE = 99
SEAT_MIN_VALUES = 10

MARKS = ("_repeated", "_unknown_ref", "_seat_cap", "_sound", "_held", "_deal")
# Rows are dealt out to tasks by as many numbers.
DEALS = 1 << 12


# Date patterns beside ISO: for all date columns alike, or by column.
Formats = Sequence[str] | Mapping[str, Sequence[str]]


def parsed(raw: DataFrame, spec: TableSpec, formats: Formats = ()) -> DataFrame:
    by_column = formats if isinstance(formats, Mapping) else dict.fromkeys(spec.timestamps, formats)
    columns = {c: parse_timestamp(raw, c, by_column.get(c, ())) for c in spec.timestamps}
    columns |= {c: parse_number(raw, c) for c in spec.numbers}
    if spec.status:
        columns[f"{spec.status}_norm"] = normalise_status(F.col(spec.status))
    return raw.withColumns(columns)


def _with_unknown(df: DataFrame, reference: str, subscriptions: DataFrame, order: list[str]) -> DataFrame:
    """Flag references to nothing among the trusted subscriptions."""
    unknown = unknown_keys(df, reference, trusted(subscriptions).select(reference))
    return mark_unknown(df, unknown, reference, order, "_unknown_ref")


def _with_repeats(
    df: DataFrame, spec: TableSpec, order: list[str], rules: list[Rule], corrections: Corrections
) -> DataFrame:
    """Flag all but the first row of an id; on demand only among rows that break no other rule."""
    if not corrections.first_sound_row:
        return mark_repeats(df, repeated_keys(df, spec.id, order), spec.id, order, "_repeated")
    sound = classify(df, [r for r in rules if r.severity == INVALID and not r.reason.startswith("Duplicate")])
    sound = sound.withColumn("_sound", F.col("record_status") != INVALID).drop("record_status", "status_reason")
    repeated = repeated_keys(sound.where("_sound"), spec.id, order)
    marked = mark_repeats(sound, repeated, spec.id, order, "_repeated", F.col("_sound"))
    return marked.withColumn("_repeated", F.col("_repeated") & F.col("_sound"))


def _marked(
    df: DataFrame,
    spec: TableSpec,
    order: Sequence[str],
    rules: list[Rule],
    corrections: Corrections,
    reference: str | None = None,
    subscriptions: DataFrame | None = None,
) -> DataFrame:
    """Set the marks the rules ask for: repeated ids and, given a reference column, unknown references."""
    order = load_order(df, tuple(order))
    if not reference:
        return _with_repeats(df, spec, order, rules, corrections)
    if corrections.first_sound_row:
        return _with_repeats(_with_unknown(df, reference, subscriptions, order), spec, order, rules, corrections)
    known = trusted(subscriptions).select(reference)
    repeated, unknown = together(
        lambda: repeated_keys(df, spec.id, order), lambda: unknown_keys(df, reference, known)
    )
    # With this number the second join needs no more of the load order.
    df = df.withColumn("_deal", F.pmod(F.xxhash64(*order), F.lit(DEALS)).cast("int"))
    marked = mark_repeats(df, repeated, spec.id, order, "_repeated")
    return mark_unknown(marked, unknown, reference, ["_deal"], "_unknown_ref", counted=df)


def _classified(df: DataFrame, rules: list[Rule]) -> DataFrame:
    return classify(df, rules).drop(*MARKS)


def clean_subscriptions(
    raw: DataFrame,
    as_of: date,
    order: Sequence[str] = TABLES["subscriptions"].order,
    formats: Formats = (),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    spec = TABLES["subscriptions"]
    df = parsed(raw, spec, formats)
    signup, renewal = F.col("signup_date"), F.col("renewal_date")
    fee, discount = F.col("monthly_fee"), F.col("discount_pct")
    active = F.col("subscription_status_norm") == "Active"
    rules = [
        invalid(F.col("subscription_id").isNull(), "Missing subscription_id"),
        invalid(F.col("_repeated"), "Duplicate subscription_id", marked=True),
        invalid(F.col("customer_id").isNull(), "Missing customer_id"),
        suspicious(signup.isNull(), "Missing/invalid signup_date"),
        invalid(renewal < signup, "Renewal date earlier than signup date"),
        suspicious(fee.isNull(), "Missing monthly_fee"),
        invalid(fee < 0, "Negative monthly_fee"),
        invalid((discount < 0) | (discount > 100), "Discount_pct outside 0-100 range"),
        suspicious(
            active & (renewal.isNull() | (renewal < F.lit(as_of - LONGEST_RENEWAL_LAG))),
            "Active subscription with missing/implausible renewal date",
        ),
        suspicious(F.col("subscription_status").isNull(), "Missing subscription_status"),
    ]
    df, rules = decided(df, rules, "_held")
    # The rules see a missing discount, later readers a discount of nothing.
    clean = _classified(_marked(df, spec, order, rules, corrections), rules)
    return clean.withColumn("discount_pct", F.coalesce(discount, F.lit(0.0)))


def clean_invoices(
    raw: DataFrame,
    subscriptions: DataFrame,
    order: Sequence[str] = TABLES["invoices"].order,
    formats: Formats = (),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    spec = TABLES["invoices"]
    df = parsed(raw, spec, formats)
    amount, paid_on = F.col("invoice_amount"), F.col("payment_date")
    rules = [
        invalid(F.col("invoice_id").isNull(), "Missing invoice_id"),
        invalid(F.col("_repeated"), "Duplicate invoice_id", marked=True),
        invalid(F.col("_unknown_ref"), "Invoice references non-existent/invalid subscription", marked=True),
        invalid(F.col("subscription_id").isNull(), "Missing subscription_id on invoice"),
        invalid(amount < 0, "Negative invoice_amount"),
        invalid(F.col("tax_amount") < 0, "Negative tax_amount"),
        suspicious(amount.isNull(), "Missing invoice_amount"),
        suspicious(F.col("payment_status").isNull(), "Missing payment_status"),
        invalid(
            (F.col("payment_status_norm") == "Paid") & paid_on.isNull(),
            "Paid invoice missing valid payment_date",
        ),
        invalid(paid_on < F.col("invoice_date"), "Payment date earlier than invoice date"),
    ]
    df, rules = decided(df, rules, "_held")
    return _classified(_marked(df, spec, order, rules, corrections, "subscription_id", subscriptions), rules)


def clean_product_usage(
    raw: DataFrame,
    subscriptions: DataFrame,
    order: Sequence[str] = TABLES["product_usage"].order,
    formats: Formats = (),
    corrections: Corrections = STANDARD,
) -> DataFrame:
    spec = TABLES["product_usage"]
    df = parsed(raw, spec, formats)
    rules = [
        invalid(F.col("usage_id").isNull(), "Missing usage_id"),
        invalid(F.col("_repeated"), "Duplicate usage_id", marked=True),
        invalid(F.col("_unknown_ref"), "Usage record references customer not in subscriptions", marked=True),
        invalid(F.col("customer_id").isNull(), "Missing customer_id on usage record"),
        invalid(F.col("login_count") < 0, "Negative login_count"),
        invalid(F.col("active_minutes") < 0, "Negative active_minutes"),
        suspicious(
            F.col("seat_count") > F.col("_seat_cap"), "Seat_count is a statistical outlier (>99th pct)", marked=True
        ),
    ]
    df, rules = decided(df, rules, "_held")
    marked, (cap, seats) = together(
        lambda: _marked(df, spec, order, rules, corrections, "customer_id", subscriptions),
        lambda: percentile(df, "seat_count", SEAT_PERCENTILE),
    )
    seat_cap = F.lit(cap if seats > SEAT_MIN_VALUES else None).cast("double")
    return _classified(marked.withColumn("_seat_cap", seat_cap), rules)


def clean_support_cases(
    raw: DataFrame,
    subscriptions: DataFrame,
    order: Sequence[str] = TABLES["support_cases"].order,
    formats: Formats = (),
    corrections: Corrections = STANDARD,
    require_customer: bool = False,
) -> DataFrame:
    """``require_customer`` adds a rule against cases without a customer."""
    spec = TABLES["support_cases"]
    df = parsed(raw, spec, formats)
    closed, hours, csat = F.col("closed_date"), F.col("resolution_hours"), F.col("csat_score")
    rules = [
        invalid(F.col("case_id").isNull(), "Missing case_id"),
        invalid(F.col("_repeated"), "Duplicate case_id", marked=True),
        invalid(F.col("_unknown_ref"), "Support case references customer not in subscriptions", marked=True),
    ]
    if require_customer:
        rules.append(invalid(F.col("customer_id").isNull(), "Missing customer_id on support case"))
    rules += [
        invalid(closed < F.col("opened_date"), "Closed date earlier than opened date"),
        invalid(hours < 0, "Negative resolution_hours"),
        invalid((csat < 1) | (csat > 5), "CSAT score outside 1-5 range"),
        invalid(
            F.col("case_status_norm").isin("Closed", "Resolved") & (closed.isNull() | hours.isNull()),
            "Closed case missing closure date/resolution hours",
        ),
        suspicious(F.col("case_status").isNull(), "Missing case_status"),
    ]
    df, rules = decided(df, rules, "_held")
    return _classified(_marked(df, spec, order, rules, corrections, "customer_id", subscriptions), rules)
