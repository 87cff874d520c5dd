"""The four audited tables, derived from order, customer, line item and event tables.

Problems are put in by arithmetic on the keys, so every scale has them. The text is plain SQL that
other engines understand too; ``{position}`` takes extra columns to hand through.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.joins import sized_join
from ledgerlens.operators.shared import Measured, text_bytes

AS_OF = date(2001, 8, 2)

SUBSCRIPTIONS = """
select o_orderkey as source_seq,
 case when o_orderkey % 47 = 0 then null when o_orderkey % 23 = 0 then o_orderkey - 1 else o_orderkey end as subscription_id,
 case when o_orderkey % 31 = 0 then null else 'C' || lpad(cast(o_custkey as string), 6, '0') end as customer_id,
 case when o_orderkey % 67 = 0 then null else o_orderdate end as signup_date,
 case when o_orderkey % 13 = 0 then null when o_orderkey % 19 = 0 then o_orderdate - interval '30' day else o_orderdate + interval '365' day end as renewal_date,
 case when o_orderkey % 41 = 0 then null when o_orderkey % 37 = 0 then -o_totalprice else o_totalprice end as monthly_fee,
 case when o_orderkey % 17 = 0 then null when o_orderkey % 43 = 0 then 105.0 when o_orderkey % 59 = 0 then -5.0 else cast((o_orderkey * 7) % 41 as double) end as discount_pct,
 case when o_orderkey % 29 = 0 then null when o_orderstatus = 'O' and o_orderkey % 5 = 0 then ' active ' when o_orderstatus = 'O' then 'Active' when o_orderstatus = 'F' then 'Cancelled' when o_orderkey % 2 = 0 then 'Expired' else 'Trial' end as subscription_status,
 case when o_orderkey % 71 = 0 then null when o_orderkey % 3 = 0 then 'Y' when o_orderkey % 3 = 1 then 'N' else 'y' end as auto_renew,
 case when c_custkey % 11 = 0 then null else r_name end as region,
 case o_orderpriority when '1-URGENT' then 'Enterprise' when '2-HIGH' then 'Pro' when '3-MEDIUM' then 'Growth' when '5-LOW' then 'Basic' end as plan_name,
 case c_mktsegment when 'BUILDING' then 'Partner' when 'AUTOMOBILE' then 'Website' when 'FURNITURE' then 'Marketplace' when 'HOUSEHOLD' then 'Inside Sales' end as sales_channel{position}
from {customer_orders}
"""

INVOICES = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate,
 case when l_partkey % 97 = 0 then null else 'I' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end as invoice_id,
 case when l_partkey % 89 = 0 then null when l_suppkey % 33 = 7 then l_orderkey + 1000000000 else l_orderkey end as subscription_id,
 case when l_partkey % 79 = 0 then null when l_partkey % 83 = 0 then -l_extendedprice else l_extendedprice end as invoice_amount,
 case when l_partkey % 73 = 0 then -1.0 else l_tax * 100 end as tax_amount,
 l_shipdate as invoice_date, l_shipdate + interval '30' day as due_date,
 case when l_returnflag <> 'A' then null when l_partkey % 71 = 0 then null when l_partkey % 67 = 0 then l_shipdate - interval '5' day else l_shipdate + interval '12' day end as payment_date,
 case when l_partkey % 61 = 0 then null when l_returnflag = 'A' and l_linestatus = 'F' then 'paid ' when l_returnflag = 'A' then 'Paid' when l_returnflag = 'N' then 'Failed' else 'Pending' end as payment_status{position}
from {lineitem}
"""

PRODUCT_USAGE = """
select event_id as source_seq,
 case when event_id % 47 = 0 then null when event_id % 23 = 0 then event_id - 1 else event_id end as usage_id,
 case when event_id % 59 = 0 then null when event_id % 61 = 0 then 'X' || cast(event_id as string) else 'C' || lpad(cast(user_id * 10 + event_id % 10 as string), 6, '0') end as customer_id, ts as usage_date,
 case when event_id % 101 = 0 then -1 else event_id % 30 end as login_count,
 case when event_id % 103 = 0 then -value else value end as active_minutes,
 event_id % 17 as feature_clicks, event_id % 7 as reports_created, event_id % 5 as data_exports,
 case when event_id % 211 = 0 then 5000 else event_id % 50 + 1 end as seat_count{position}
from {events}
"""

SUPPORT_CASES = """
select event_id as source_seq,
 case when event_id % 47 = 0 then null when event_id % 23 = 0 then event_id - event_id % 3 else event_id end as case_id,
 case when event_id % 59 = 0 then null when event_id % 61 = 0 then 'X' || cast(event_id as string) else 'C' || lpad(cast(user_id * 10 + event_id % 10 as string), 6, '0') end as customer_id, ts as opened_date,
 case when event_id % 4 > 1 then null when event_id % 13 = 0 then null when event_id % 17 = 0 then ts - interval '1' day else ts + (event_id % 10) * interval '1' day end as closed_date,
 case when event_id % 4 > 1 then null when event_id % 29 = 0 then null when event_id % 19 = 0 then -value else value end as resolution_hours,
 case when event_id % 7 = 0 then null when event_id % 31 = 0 then 9 else event_id % 5 + 1 end as csat_score,
 case when event_id % 37 = 0 then null when event_id % 4 = 0 then 'Closed' when event_id % 4 = 1 then ' resolved' when event_id % 4 = 2 then 'Escalated' else 'Open' end as case_status{position}
from {events} where event_type in ('error','click')
"""

TEXTS = {
    "subscriptions": SUBSCRIPTIONS,
    "invoices": INVOICES,
    "product_usage": PRODUCT_USAGE,
    "support_cases": SUPPORT_CASES,
}
# Columns the queries above read, with their types, so that no file is opened to infer them.
INPUTS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}
POSITIONED = ("orders", "lineitem", "events")

CUSTOMER_ORDERS = (
    "orders join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey "
    "join region on r_regionkey = n_regionkey"
)

INVOICE_ORDER = ("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey")
ORDERS = {"invoices": INVOICE_ORDER}


def derive_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four tables over the Parquet files in ``folder``.

    The file position of each row is the last part of the load order, so that rows that agree in
    everything else still have a first.
    """
    inputs = {}
    for name, schema in INPUTS.items():
        df = spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
        if name in POSITIONED:
            file = F.xxhash64("_metadata.file_path").alias("source_file")
            df = df.select("*", file, F.col("_metadata.row_index").alias("source_row"))
        inputs[name] = df
    inputs["customer_orders"] = _customer_orders(inputs)
    handed_through = ", source_file, source_row"
    return {
        name: spark.sql(text.replace("{position}", handed_through), **{k: v for k, v in inputs.items() if f"{{{k}}}" in text})
        for name, text in TEXTS.items()
    }


def _customer_orders(inputs: dict[str, DataFrame]) -> DataFrame:
    """Orders with their customer's attributes, also when one customer placed most of them."""
    customers = (
        inputs["customer"]
        .join(inputs["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
        .join(inputs["region"], F.col("r_regionkey") == F.col("n_regionkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "c_custkey", "c_mktsegment", "r_name")
    )
    size = customers.agg(F.coalesce(text_bytes(customers), F.lit(0))).first()[0]
    return sized_join(
        inputs["orders"], Measured(customers, {"bytes": size}), ["o_custkey"], ["source_file", "source_row"], "inner"
    )


# Variants of the tables: columns replaced, in SQL that other engines understand too.
# Everything as text, as spreadsheets and CSV files bring it, with missing markers and unreadable values.
AS_TEXT = {
    "subscription_id": "case when source_seq % 53 = 5 then 'N/A' else cast(subscription_id as string) end",
    "customer_id": "case when source_seq % 59 = 7 then 'null' else customer_id end",
    "signup_date": "case when source_seq % 61 = 3 then '45292' when source_seq % 61 = 4 then '2024-02-30' else cast(cast(signup_date as date) as string) end",
    "renewal_date": "case when source_seq % 67 = 3 then '12/31/2024' else cast(cast(renewal_date as date) as string) end",
    "monthly_fee": "case when source_seq % 53 = 8 then '1,000' when source_seq % 53 = 9 then ' 12.5 ' else cast(monthly_fee as string) end",
    "discount_pct": "case when source_seq % 59 = 8 then 'NA' else cast(discount_pct as string) end",
    "subscription_status": "case when source_seq % 37 = 3 then 'past-due' when source_seq % 37 = 4 then 'n/a' else subscription_status end",
}
# Dates as two regions write them, the day first in one column and the month first in the other, some as ISO text.
REGIONAL_DATES = {
    "signup_date": "case when source_seq % 61 = 3 then 'unknown' when source_seq % 61 = 4 then '31/02/2024' "
    "when source_seq % 61 = 5 then cast(cast(signup_date as date) as string) "
    "else substr(cast(cast(signup_date as date) as string), 9, 2) || '/' || substr(cast(cast(signup_date as date) as string), 6, 2) "
    "|| '/' || substr(cast(cast(signup_date as date) as string), 1, 4) end",
    "renewal_date": "case when source_seq % 67 = 3 then '13/13/2001' "
    "else substr(cast(cast(renewal_date as date) as string), 6, 2) || '/' || substr(cast(cast(renewal_date as date) as string), 9, 2) "
    "|| '/' || substr(cast(cast(renewal_date as date) as string), 1, 4) end",
}
# Amounts no business has, and some with many decimals.
ABSURD_FEES = {"monthly_fee": "case when source_seq % 509 = 0 then 1e30 else monthly_fee end"}
ABSURD_AMOUNTS = {
    "invoice_amount": "case when l_partkey % 503 = 0 then 1e30 when l_partkey % 7 = 1 then invoice_amount + 0.0000001 else invoice_amount end"
}
# Health far enough down that rich customers are among the unhealthy.
POOR_HEALTH = {"customer_health_score": "customer_health_score * 0.25"}


def replaced(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def plain_sql(name: str) -> str:
    """The defining query of a table over plain table names, for other engines."""
    return TEXTS[name].format(position="", customer_orders=CUSTOMER_ORDERS, **{t: t for t in INPUTS}).strip()
