"""Formats of text dates by vote, and what they make of the dates."""

from datetime import datetime

import pandas as pd
import pytest

from frames import AS_OF, frame
from ledgerlens import RevenueAudit
from ledgerlens.functions.columns import parse_timestamp
from ledgerlens.functions.dates import ISO, inferred_formats, patterns


def infer(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    found = inferred_formats(df, ["x"])["x"]
    read = parse_timestamp(df, "x", patterns({"x": found})["x"])
    return found, [r[0] for r in df.orderBy("i").select(read).collect()]


@pytest.mark.parametrize(
    "texts",
    [
        ["12/31/2024", "01/02/2024", "2/3/2024", "soon", None, "13/13/2024"],
        ["31/12/2024", "01/02/2024", "02/03/2024"],
        ["2024/12/31", "2024/01/02"],
        ["31.12.2024", "01.02.2024"],
        ["12-31-2024", "01-02-2024"],
        ["20241231", "20240102"],
        ["Jan 5, 2024", "Dec 31, 2024"],
        ["5 Jan 2024", "31 Dec 2024", "x"],
        ["12/31/2024 10:11:12", "01/02/2024 00:00:01"],
    ],
)
def test_like_pandas_told_the_format(spark, texts):
    found, read = infer(spark, texts)
    assert not found.rivals and found.votes == sum(r is not None for r in read)
    day_first = texts[0].startswith("31")
    expected = pd.to_datetime(pd.Series(texts), errors="coerce", dayfirst=day_first)
    assert [r and r.replace(tzinfo=None) for r in read] == [None if pd.isna(e) else e.to_pydatetime() for e in expected]


def test_iso_stays(spark):
    found, read = infer(spark, ["2024-01-02", "2024-01-03 04:05:06", "12/31/2024", "2024-1-4", None, "45292"])
    assert found.format == ISO and found.votes == 3 and found.values == 5
    assert read == [datetime(2024, 1, 2), datetime(2024, 1, 3, 4, 5, 6), None, datetime(2024, 1, 4), None, None]


def test_draws_are_told(spark):
    """The month first, as most readers take it; the report says that it could be otherwise."""
    found, read = infer(spark, ["01/02/2024", "03/04/2024"])
    assert found.format.startswith("M/d/yyyy") and [r[:8] for r in found.rivals] == ["d/M/yyyy"]
    assert read == [datetime(2024, 1, 2), datetime(2024, 3, 4)]
    found, _ = infer(spark, ["01/01/2024", "04/04/2024"])
    assert not found.rivals
    assert infer(spark, ["none of", "these"])[0].format == ISO
    assert infer(spark, [])[0] == (ISO, 0, 0, ())


def test_audit_infers_unless_told(spark):
    rows = [dict(subscription_id=f"S{i}", signup_date=d) for i, d in enumerate(["13/01/2023", "14/02/2023", "03/04/2023"])]
    typed = frame(spark, "subscriptions", *[dict(subscription_id=r["subscription_id"]) for r in rows])
    text = spark.createDataFrame([(r["subscription_id"], r["signup_date"]) for r in rows], "subscription_id string, signup_date string")
    subscriptions = typed.drop("signup_date").join(text, "subscription_id")
    others = {name: frame(spark, name) for name in ("invoices", "product_usage", "support_cases")}

    def signups(**options):
        audit = RevenueAudit({"subscriptions": subscriptions, **others}, AS_OF, **options)
        clean = audit.clean_subscriptions.orderBy("subscription_id").select("signup_date").collect()
        return audit, [r[0] for r in clean]

    days = [datetime(2023, 1, 13), datetime(2023, 2, 14), datetime(2023, 4, 3)]
    audit, inferred = signups()
    assert inferred == days
    report = audit.date_format_report().collect()
    assert [(r.table_name, r.column_name, r.votes, r.ambiguous) for r in report] == [("subscriptions", "signup_date", 3, False)]
    assert signups(formats=["dd/MM/yyyy"])[1] == days
    assert signups(formats=[])[1] == [None] * 3
