"""Every registered query once more as plain SQL over the same tables.

Written the direct way, with whole-table windows and joins, as a check on the distributed plans.
"""

from __future__ import annotations

from ledgerlens.sources.fixtures import ABSURD_AMOUNTS, ABSURD_FEES, AS_OF, AS_TEXT, INVOICE_ORDER, POOR_HEALTH, REGIONAL_DATES, TEXTS, plain_sql
from ledgerlens.sources.schemas import TABLES

DAY = f"timestamp '{AS_OF.isoformat()} 00:00:00'"

# (condition, is invalid, reason) per table, in order.
RULES = {
    "subscriptions": [
        ("subscription_id is null", 1, "Missing subscription_id"),
        ("repeated", 1, "Duplicate subscription_id"),
        ("customer_id is null", 1, "Missing customer_id"),
        ("signup_date is null", 0, "Missing/invalid signup_date"),
        ("renewal_date < signup_date", 1, "Renewal date earlier than signup date"),
        ("monthly_fee is null", 0, "Missing monthly_fee"),
        ("monthly_fee < 0", 1, "Negative monthly_fee"),
        ("discount_pct < 0 or discount_pct > 100", 1, "Discount_pct outside 0-100 range"),
        (
            f"subscription_status_norm = 'Active' and (renewal_date is null or renewal_date < {DAY} - interval '1095' day)",
            0,
            "Active subscription with missing/implausible renewal date",
        ),
        ("subscription_status is null", 0, "Missing subscription_status"),
    ],
    "invoices": [
        ("invoice_id is null", 1, "Missing invoice_id"),
        ("repeated", 1, "Duplicate invoice_id"),
        (
            "subscription_id is not null and subscription_id not in (select subscription_id from subs_ok)",
            1,
            "Invoice references non-existent/invalid subscription",
        ),
        ("subscription_id is null", 1, "Missing subscription_id on invoice"),
        ("invoice_amount < 0", 1, "Negative invoice_amount"),
        ("tax_amount < 0", 1, "Negative tax_amount"),
        ("invoice_amount is null", 0, "Missing invoice_amount"),
        ("payment_status is null", 0, "Missing payment_status"),
        ("payment_status_norm = 'Paid' and payment_date is null", 1, "Paid invoice missing valid payment_date"),
        ("payment_date < invoice_date", 1, "Payment date earlier than invoice date"),
    ],
    "product_usage": [
        ("usage_id is null", 1, "Missing usage_id"),
        ("repeated", 1, "Duplicate usage_id"),
        (
            "customer_id is not null and customer_id not in (select customer_id from subs_ok)",
            1,
            "Usage record references customer not in subscriptions",
        ),
        ("customer_id is null", 1, "Missing customer_id on usage record"),
        ("login_count < 0", 1, "Negative login_count"),
        ("active_minutes < 0", 1, "Negative active_minutes"),
        (
            "(select count(seat_count) from product_usage) > 10 and "
            "seat_count > (select quantile_cont(seat_count, 0.99) from product_usage)",
            0,
            "Seat_count is a statistical outlier (>99th pct)",
        ),
    ],
    "support_cases": [
        ("case_id is null", 1, "Missing case_id"),
        ("repeated", 1, "Duplicate case_id"),
        (
            "customer_id is not null and customer_id not in (select customer_id from subs_ok)",
            1,
            "Support case references customer not in subscriptions",
        ),
        ("closed_date < opened_date", 1, "Closed date earlier than opened date"),
        ("resolution_hours < 0", 1, "Negative resolution_hours"),
        ("csat_score < 1 or csat_score > 5", 1, "CSAT score outside 1-5 range"),
        (
            "case_status_norm in ('Closed', 'Resolved') and (closed_date is null or resolution_hours is null)",
            1,
            "Closed case missing closure date/resolution hours",
        ),
        ("case_status is null", 0, "Missing case_status"),
    ],
}


def typed(name: str) -> str:
    spec = TABLES[name]
    order = ", ".join(INVOICE_ORDER if name == "invoices" else spec.order)
    columns = [
        f"{spec.id} is not null and row_number() over (partition by {spec.id} order by {order}) > 1 as repeated",
    ]
    if spec.status:
        text = f"trim({spec.status})"
        titled = "list_transform(string_split({}, '-'), lambda w: upper(left(w, 1)) || lower(substr(w, 2)))".format(text)
        columns.append(f"coalesce(array_to_string({titled}, '-'), 'Nan') as {spec.status}_norm")
    replaced = ", ".join(f"cast({c} as double) as {c}" for c in spec.numbers)
    return f"select * replace ({replaced}), {', '.join(columns)} from {name}"


def classified(name: str, rules: list | None = None) -> str:
    rules = rules or RULES[name]
    invalid = " or ".join(f"coalesce({c}, false)" for c, bad, _ in rules if bad)
    suspicious = " or ".join(f"coalesce({c}, false)" for c, bad, _ in rules if not bad)
    reasons = ", ".join(f"case when {c} then '{r}' end" for c, _, r in rules)
    fill = " replace (coalesce(discount_pct, 0.0) as discount_pct)" if name == "subscriptions" else ""
    return (
        f"select *{fill}, case when {invalid} then 'INVALID' when {suspicious} then 'SUSPICIOUS' else 'VALID' end"
        f" as record_status, coalesce(nullif(concat_ws('; ', {reasons}), ''), 'No issues detected') as status_reason"
        f" from typed_{name}"
    )


def half_even(expression: str) -> str:
    return f"round_even(({expression}) * 100, 0) / 100"


USAGE = ("login_count", "active_minutes", "feature_clicks", "reports_created", "data_exports")


def rank(column: str, source: str) -> str:
    """Rank among non-null values with ties averaged, as a part of their number."""
    return (
        f"select customer_id, ((rank() over (order by {column}) - 1) + (count(*) over (partition by {column}) + 1) / 2)"
        f" / count(*) over () as r from {source} where {column} is not null"
    )


def total(value: str, condition: str | None = None) -> str:
    """The sum as a double: of the decimal digits that a value prints as, and apart of values too large for that."""
    value = f"case when {condition} then {value} end" if condition else value
    digits = f"cast(cast(case when abs({value}) < 1e11 then {value} end as varchar) as decimal(38,16))"
    large = f"sum(case when abs({value}) >= 1e11 then {value} end)"
    return f"(coalesce(cast(cast(sum({digits}) as varchar) as double), 0.0) + coalesce({large}, 0.0))"


def mean(value: str) -> str:
    return f"{total(value)} / nullif(count({value}), 0)"


def rounded(value: str, digits: int = 2) -> str:
    """Half up on the digits that a double prints as; values beyond 10^15 have none to round."""
    small = f"case when abs({value}) < 1e15 then {value} end"
    text = f"cast(round(cast(cast({small} as varchar) as decimal(38,9)), {digits}) as double)"
    return f"coalesce({text}, {value})"


NET = "(monthly_fee * (1 - discount_pct / 100.0))"
ACTIVE = "subscription_status_norm = 'Active'"
AT_RISK = "subscription_status_norm = 'Active' and risk_category = 'High Risk' and MRR > 0"

# The same two sums by region and plan, by region, and over all.
SIDES = (
    ("", "region, plan_name, ", "group by region, plan_name"),
    ("_by_region", "region, ", "group by region"),
    ("_in_all", "", ""),
)

CTES: dict[str, str] = {name: plain_sql(name) for name in TEXTS}
CTES["typed_subscriptions"] = typed("subscriptions")
CTES["clean_subscriptions"] = classified("subscriptions")
CTES["subs_ok"] = "select * from clean_subscriptions where record_status <> 'INVALID'"
for _name in ("invoices", "product_usage", "support_cases"):
    CTES[f"typed_{_name}"] = typed(_name)
    CTES[f"clean_{_name}"] = classified(_name)
CTES |= {
    "inv_ok": "select * from clean_invoices where record_status <> 'INVALID'",
    "usage_ok": "select * from clean_product_usage where record_status <> 'INVALID'",
    "cases_ok": "select * from clean_support_cases where record_status <> 'INVALID' and customer_id is not null",
    "mrr": f"""select customer_id, {total(NET)} as MRR
        from subs_ok where subscription_status_norm = 'Active' group by customer_id""",
    "revenue": f"""select customer_id, {mean('invoice_amount')} as effective_monthly_revenue
        from inv_ok join (select subscription_id, customer_id from subs_ok) using (subscription_id)
        where payment_status_norm = 'Paid' and invoice_amount is not null group by customer_id""",
    "failure": """select customer_id,
            cast(count(*) filter (where payment_status_norm = 'Failed') as double) / count(*) as payment_failure_rate
        from inv_ok join (select subscription_id, customer_id from subs_ok) using (subscription_id) group by customer_id""",
    "usage_means": "select customer_id, "
    + ", ".join(
        f"round({mean(c)}, 9) as {c}" for c in USAGE
    )
    + " from usage_ok group by customer_id",
    **{f"rank_{c}": rank(c, "usage_means") for c in USAGE},
    "usage_score": "select customer_id, "
    + half_even(
        "("
        + " + ".join(f"coalesce(rank_{c}.r, 0.0)" for c in USAGE)
        + ") / ("
        + " + ".join(f"(case when rank_{c}.r is null then 0 else 1 end)" for c in USAGE)
        + ") * 100"
    )
    + " as usage_intensity_score from usage_means "
    + " ".join(f"left join rank_{c} using (customer_id)" for c in USAGE),
    "support": f"""select customer_id,
            cast(count(*) filter (where case_status_norm = 'Escalated') as double) / count(*) as support_escalation_rate,
            {mean('csat_score')} as average_csat
        from cases_ok group by customer_id""",
    "renewal": "select customer_id, least(100.0, greatest(0.0, "
    + half_even("ended * 60 + manual * 25 + case when days <= 30 then 15 else 0 end")
    + f""")) as renewal_risk_score from (
            select customer_id,
                cast(count(*) filter (where subscription_status_norm in ('Cancelled', 'Expired')) as double) / count(*) as ended,
                cast(count(*) filter (where coalesce(upper(auto_renew), '') <> 'Y') as double) / count(*) as manual,
                min(date_diff('day', {DAY}, renewal_date)) as days
            from subs_ok group by customer_id)""",
    "latest": """select customer_id, region, plan_name, sales_channel, subscription_status_norm from (
            select *, row_number() over (partition by customer_id
                order by signup_date desc nulls first, source_seq desc) as place from subs_ok)
        where place = 1""",
    "filled": f"""select customer_id, coalesce(MRR, 0.0) as MRR,
            coalesce(effective_monthly_revenue, 0.0) as effective_monthly_revenue,
            coalesce(payment_failure_rate, 0.0) as payment_failure_rate,
            coalesce(usage_intensity_score, 0.0) as usage_intensity_score,
            coalesce(support_escalation_rate, 0.0) as support_escalation_rate,
            coalesce(average_csat, (select {mean('average_csat')} from support)) as average_csat,
            coalesce(renewal_risk_score, 50.0) as renewal_risk_score,
            region, plan_name, sales_channel, subscription_status_norm
        from latest left join renewal using (customer_id) left join mrr using (customer_id)
            left join revenue using (customer_id) left join failure using (customer_id)
            left join usage_score using (customer_id) left join support using (customer_id)""",
    "rank_csat": rank("average_csat", "filled"),
    "scored": "select filled.*, "
    + half_even(
        "0.25::double * usage_intensity_score + 0.25::double * ((1 - payment_failure_rate) * 100)"
        " + 0.25::double * ((rank_csat.r * 100 + (1 - support_escalation_rate) * 100) / 2)"
        " + 0.25::double * (100 - renewal_risk_score)"
    )
    + " as customer_health_score from filled left join rank_csat using (customer_id)",
    "customer_summary": """select *, case when customer_health_score <= 40 then 'High Risk'
            when customer_health_score <= 70 then 'Watchlist' when customer_health_score <= 100 then 'Healthy' end
            as risk_category from scored""",
    **{
        f"reported{name}": f"select {keys}{total('monthly_fee')} as reported from (select * replace (cast(monthly_fee as double)"
        f" as monthly_fee) from subscriptions) where subscription_status = 'Active' {grouping}"
        for name, keys, grouping in SIDES
    },
    **{
        f"trusted{name}": f"select {keys}{total(NET)} as trusted from subs_ok where subscription_status_norm = 'Active' {grouping}"
        for name, keys, grouping in SIDES
    },
    "escalations": """select customer_id, count(*) as escalation_count
        from cases_ok where case_status_norm = 'Escalated' group by customer_id""",
    "counted": """select s.*, coalesce(e.escalation_count, 0) as escalation_count,
            ntile(5) over (order by effective_monthly_revenue, customer_id) as revenue_tile,
            ntile(10) over (order by usage_intensity_score, customer_id) as usage_tile
        from customer_summary s left join escalations e using (customer_id)""",
    "plans": f"""select plan_name, {mean('discount_pct')} as discount,
            cast(count(*) filter (where subscription_status_norm = 'Active') as double) / count(*) as renewal,
            cast(count(*) filter (where subscription_status_norm = 'Cancelled') as double) / count(*) as cancellation,
            {total(NET, "subscription_status_norm = 'Active'")} as fees
        from subs_ok where plan_name is not null group by plan_name""",
    "plan_health": f"""select plan_name, {mean('customer_health_score')} as health
        from customer_summary where plan_name is not null group by plan_name""",
    "means": f"""select {mean('usage_intensity_score')} as usage,
            {mean('effective_monthly_revenue')} as revenue, {mean('MRR')} as mrr
        from customer_summary""",
    "q5a": f"""select customer_id, 'Active subscription with repeated failed payments' as contradiction_type,
            'Payment failure rate ' || {rounded('payment_failure_rate * 100', 1)} || '% while subscription is Active' as description,
            MRR as financial_impact
        from customer_summary where subscription_status_norm = 'Active' and payment_failure_rate > 0.5""",
    "q5b": """select customer_id, 'High product usage but cancelled' as contradiction_type,
            'Usage intensity ' || usage_intensity_score || ' (above company average) yet subscription Cancelled' as description,
            effective_monthly_revenue as financial_impact
        from customer_summary where subscription_status_norm = 'Cancelled' and usage_intensity_score > (select usage from means)""",
    "q5c": """select customer_id, 'Low usage on Enterprise plan' as contradiction_type,
            'Usage intensity only ' || usage_intensity_score || ' on an Enterprise contract' as description,
            effective_monthly_revenue as financial_impact
        from customer_summary where plan_name = 'Enterprise' and usage_intensity_score < 25""",
    "q5d": f"""select customer_id, 'High CSAT despite repeated escalations' as contradiction_type,
            'Average CSAT ' || {rounded('average_csat', 1)} || ' but escalation rate ' || {rounded('support_escalation_rate * 100', 1)} || '%'
            as description, effective_monthly_revenue as financial_impact
        from customer_summary where average_csat >= 4 and support_escalation_rate > 0.3""",
    "q5e": """select s.customer_id, 'Paid invoice with invalid payment timeline' as contradiction_type,
            'Invoice ' || i.invoice_id || ': ' || i.status_reason as description, i.invoice_amount as financial_impact
        from clean_invoices i join clean_subscriptions s on s.subscription_id = i.subscription_id
        where i.payment_status_norm = 'Paid' and i.record_status = 'INVALID'""",
    "q5f": """select customer_id, 'High revenue customer with very poor health score' as contradiction_type,
            'Revenue ' || cast(cast(round(effective_monthly_revenue, 0) as decimal(18,0)) as varchar) || '.0 with health score '
            || customer_health_score as description, effective_monthly_revenue as financial_impact
        from customer_summary
        where customer_health_score < 30 and effective_monthly_revenue > (select revenue from means) * 1.5""",
    "invoice_totals": f"""select s.customer_id, count(i.invoice_amount) as amounts, {total('i.invoice_amount')} as total
        from inv_ok i join clean_subscriptions s on s.subscription_id = i.subscription_id group by s.customer_id""",
    "case_totals": """select customer_id, count(*) as support_case_count,
            count(*) filter (where case_status_norm = 'Escalated') as escalation_count
        from cases_ok group by customer_id""",
    "executive": f"""select cs.customer_id, cs.region, cs.plan_name, cs.sales_channel,
            {rounded('rs.reported')} as reported_mrr, {rounded('cs.MRR')} as trusted_mrr,
            coalesce({rounded('ia.total')}, 0.0) as total_invoice_value,
            {rounded('cs.payment_failure_rate', 4)} as payment_failure_rate, cs.usage_intensity_score,
            coalesce(ca.support_case_count, 0) as support_case_count, coalesce(ca.escalation_count, 0) as escalation_count,
            {rounded('cs.average_csat', 2)} as average_csat, cs.customer_health_score, cs.risk_category,
            case when {AT_RISK} then {rounded('cs.MRR')} else 0.0 end as revenue_at_risk,
            case when {AT_RISK} then 'Immediate Action'
                when risk_category = 'High Risk' then 'Investigate'
                when risk_category = 'Watchlist' and MRR > (select mrr from means) then 'Monitor Closely'
                when risk_category = 'Watchlist' then 'Monitor' else 'Low Priority' end as recommended_priority
        from customer_summary cs left join reported rs on rs.region = cs.region and rs.plan_name = cs.plan_name
            left join invoice_totals ia on ia.customer_id = cs.customer_id
            left join case_totals ca on ca.customer_id = cs.customer_id""",
}

OVERSTATED = f"""case when coalesce(reported, 0) = 0 then 0.0
    else {rounded('((reported - coalesce(trusted, 0.0)) / reported * 100)')} end as revenue_overstatement_pct"""
MONEY_PAIR = f"""coalesce({rounded('reported')}, 0.0) as reported_mrr,
    coalesce({rounded('trusted')}, 0.0) as trusted_mrr"""


def _at_risk_by(key: str) -> str:
    return (
        f"select {key}, count(*) as at_risk_customers, {rounded(total('MRR'))}"
        f" as revenue_at_risk from customer_summary where {AT_RISK} group by {key}"
    )


def _counts(name: str) -> dict[str, str]:
    return {
        "status": f"select record_status, count(*) as row_count from clean_{name} group by record_status",
        "rule_counts": "select reason, count(*) as row_count from (select unnest(string_split(status_reason, '; ')) as reason"
        f" from clean_{name}) group by reason",
    }


def _clean(name: str) -> str:
    spec = TABLES[name]
    norm = [f"{spec.status}_norm"] if spec.status else []
    return f"select {', '.join([*spec.columns, *norm, 'record_status', 'status_reason'])} from clean_{name}"


RISK_SUM = (
    f"{rounded(total('MRR', AT_RISK))} as revenue_at_risk"
)

QUERIES: dict[str, str] = {
    **{
        f"{short}_{kind}": sql
        for short, name in (
            ("subs", "subscriptions"),
            ("inv", "invoices"),
            ("usage", "product_usage"),
            ("cases", "support_cases"),
        )
        for kind, sql in _counts(name).items()
    },
    **{f"clean_{name}": _clean(name) for name in TABLES},
    "cust_mrr": "select * from mrr",
    "cust_effective_revenue": "select * from revenue",
    "cust_payment_failure": "select * from failure",
    "cust_usage_intensity": "select * from usage_score",
    "cust_escalation": "select customer_id, support_escalation_rate from support",
    "cust_csat": "select customer_id, average_csat from support",
    "cust_renewal_risk": "select * from renewal",
    "cust_latest_attrs": "select * from latest",
    "customer_summary": "select * from filled",
    "customer_health": "select * from customer_summary",
    "q1_trusted_vs_reported": f"""select coalesce(r.region, t.region) as region, coalesce(r.plan_name, t.plan_name) as plan_name,
        {MONEY_PAIR}, {OVERSTATED}
        from reported r full join trusted t on r.region = t.region and r.plan_name = t.plan_name""",
    "q2_high_rev_low_usage": f"""select customer_id, {rounded('effective_monthly_revenue', 2)} as revenue, plan_name,
            usage_intensity_score as usage_score, escalation_count, {rounded('average_csat', 2)} as csat,
            customer_health_score as health_score
        from counted where revenue_tile = 5 and usage_tile <= 3
            and escalation_count > (select avg(escalation_count) from counted)""",
    "q3_discount_vs_retention": f"""select plan_name, {rounded('discount', 2)} as avg_discount_pct,
            {rounded('renewal * 100', 2)} as renewal_rate_pct, {rounded('cancellation * 100', 2)} as cancellation_rate_pct,
            {rounded('health', 2)} as avg_health_score, {rounded('fees')} as trusted_mrr
        from plans join plan_health using (plan_name)
        where discount > (select avg(discount) from plans) and renewal < (select avg(renewal) from plans)""",
    "q4a_region": _at_risk_by("region"),
    "q4b_plan": _at_risk_by("plan_name"),
    "q4c_channel": _at_risk_by("sales_channel"),
    **{f"q5{x}": f"select * from q5{x}" for x in "abcdef"},
    "q5_top20": "select * from ("
    + " union all ".join(f"select * from q5{x}" for x in "abcdef")
    + """) where financial_impact is not null order by financial_impact desc, customer_id nulls first, contradiction_type,
        description nulls first limit 20""",
    "q6_executive": "select * from executive",
    "q6_top20": "select * from executive order by revenue_at_risk desc, customer_id limit 20",
    "b1_region_rank": f"""select region, {MONEY_PAIR}, {OVERSTATED},
            rank() over (order by revenue_overstatement_pct desc) as overstatement_rank
        from reported_by_region r full join (select region as region_t, trusted from trusted_by_region) t on r.region is not distinct from t.region_t""",
    "b2_kpis": f"""select {MONEY_PAIR}, {OVERSTATED}, revenue_at_risk, high_risk_customers_pct, renewal_rate_pct
        from reported_in_all, trusted_in_all,
            (select {RISK_SUM}, {rounded("cast(count(*) filter (where risk_category = 'High Risk') as double) / count(*) * 100", 2)}
                as high_risk_customers_pct from customer_summary),
            (select {rounded("cast(count(*) filter (where subscription_status_norm = 'Active') as double) / count(*) * 100", 2)}
                as renewal_rate_pct from subs_ok)""",
    "b3_points": """select customer_id, trusted_mrr, customer_health_score, support_case_count, risk_category
        from executive""",
    "b4_matrix": f"""select s.region, s.plan_name, s.level, trusted_mrr, renewal_rate_pct, cancellation_rate_pct,
            avg_health_score, coalesce(revenue_at_risk, 0.0) as revenue_at_risk
        from (select region, plan_name, cast(grouping(region, plan_name) as integer) as level,
                {rounded(total(NET, ACTIVE))} as trusted_mrr,
                {rounded("cast(count(*) filter (where subscription_status_norm = 'Active') as double) / count(*) * 100", 2)}
                    as renewal_rate_pct,
                {rounded("cast(count(*) filter (where subscription_status_norm = 'Cancelled') as double) / count(*) * 100", 2)}
                    as cancellation_rate_pct
            from subs_ok group by rollup (region, plan_name)) s
        left join (select region, plan_name, cast(grouping(region, plan_name) as integer) as level,
                {rounded('(' + mean('customer_health_score') + ')')} as avg_health_score,
                {RISK_SUM}
            from customer_summary group by rollup (region, plan_name)) c
        on s.region is not distinct from c.region and s.plan_name is not distinct from c.plan_name and s.level = c.level""",
    "b5_monthly_trend": f"""select cast(date_trunc('month', invoice_date) as date) as month,
            {rounded(total('invoice_amount'))} as reported_revenue,
            {rounded(total('invoice_amount', "record_status <> 'INVALID'"))} as trusted_revenue
        from clean_invoices where invoice_date is not null group by 1""",
    "b6_top20_intervention": f"""select e.customer_id, e.plan_name, {rounded('s.effective_monthly_revenue', 2)} as revenue,
            e.usage_intensity_score as usage_score, e.escalation_count, e.average_csat as csat,
            e.customer_health_score as health_score, e.revenue_at_risk
        from executive e join customer_summary s using (customer_id)
        order by e.revenue_at_risk desc, e.customer_health_score nulls first, e.customer_id limit 20""",
    "b7_drill": f"""select region, plan_name, customer_id, cast(grouping(region, plan_name, customer_id) as integer) as level,
            count(*) as customers, {rounded(total('trusted_mrr'))} as trusted_mrr,
            {rounded('(' + mean('customer_health_score') + ')')} as avg_health_score,
            cast(sum(escalation_count) as bigint) as escalation_count,
            {rounded(total('revenue_at_risk'))} as revenue_at_risk
        from executive group by rollup (region, plan_name, customer_id)""",
}


def _replacing(columns: dict[str, str], source: str) -> str:
    return f"select * replace ({', '.join(f'{text} as {name}' for name, text in columns.items())}) from {source}"


def _as_read() -> str:
    """The text variant's columns as a table reader takes them."""
    spec, columns = TABLES["subscriptions"], {}
    for c in spec.columns:
        given = f"case when {c} not in ('N/A', 'NA', 'n/a', 'null', '') then trim({c}) end"
        if c in spec.timestamps:
            columns[c] = f"case when regexp_full_match({given}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') then try_cast({c} as timestamp) end"
        elif c in spec.numbers:
            columns[c] = f"case when regexp_full_match({given}, '[+-]?[0-9.]+(E-?[0-9]+)?') then try_cast(trim({c}) as double) end"
        elif c in AS_TEXT:
            columns[c] = f"case when {given} is not null then {c} end"
    return _replacing(columns, f"({_replacing(AS_TEXT, 'original_subscriptions')})")


# What the columns of the regional variant are written in, and what reads them elsewhere.
REGIONAL_FORMATS = {"signup_date": ("d/M/yyyy[ H:m[:s]]", "%d/%m/%Y"), "renewal_date": ("M/d/yyyy[ H:m[:s]]", "%m/%d/%Y")}


def _regional() -> str:
    """The variant with regional dates, each column by its format or as ISO text."""
    columns = {
        c: f"coalesce(try_strptime({c}, '{pattern}'), try_strptime({c}, '%Y-%m-%d'))" for c, (_, pattern) in REGIONAL_FORMATS.items()
    }
    return _replacing(columns, f"({_replacing(REGIONAL_DATES, 'original_subscriptions')})")


def _format_votes() -> str:
    """How many values each regional column's own format reads."""
    source = f"({_replacing(REGIONAL_DATES, 'original_subscriptions')})"
    parts = [
        f"select 'subscriptions' as table_name, '{c}' as column_name, '{name}' as date_format, "
        f"count(try_strptime({c}, '{pattern}')) as votes, count({c}) as date_values, false as ambiguous from {source}"
        for c, (name, pattern) in REGIONAL_FORMATS.items()
    ]
    return " union all ".join(parts)


def _variants() -> dict[str, str]:
    """The queries on tables of which some columns are replaced: the same text over other definitions."""
    cases = RULES["support_cases"]
    cases = [*cases[:3], ("customer_id is null", 1, "Missing customer_id on support case"), *cases[3:]]
    absurd = {
        "subscriptions": _replacing(ABSURD_FEES, "original_subscriptions"),
        "invoices": _replacing(ABSURD_AMOUNTS, "original_invoices"),
    }
    changes = {
        "d1_case_without_customer": ({"clean_support_cases": classified("support_cases", cases)}, "clean_support_cases"),
        "text_subscriptions": ({"subscriptions": _as_read()}, "clean_subscriptions"),
        "regional_dates": ({"subscriptions": _regional()}, "clean_subscriptions"),
        "regional_formats": ({"format_votes": _format_votes()}, "regional_formats"),
        "absurd_q1": (absurd, "q1_trusted_vs_reported"),
        "absurd_effective_revenue": (absurd, "cust_effective_revenue"),
        "q5f_poor_health": ({"customer_summary": _replacing(POOR_HEALTH, f"({CTES['customer_summary']})")}, "q5f"),
    }
    found = {}
    for name, (changed, query) in changes.items():
        tables = {f"original_{t}": CTES[t] for t in ("subscriptions", "invoices")}
        text = ",\n".join(f"{t} as ({sql})" for t, sql in (tables | CTES | changed).items())
        found[name] = f"with {text}\n{QUERIES.get(query, 'select * from format_votes')}"
    return found


def oracle_sql() -> dict[str, str]:
    prefix = "with " + ",\n".join(f"{name} as ({text})" for name, text in CTES.items())
    return {name: f"{prefix}\n{sql}" for name, sql in QUERIES.items()} | _variants()
