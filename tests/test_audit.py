import math

import pytest

from frames import AS_OF, frame
from ledgerlens import RevenueAudit
from ledgerlens.operators import joins, shared
from ledgerlens.sources.fixtures import AS_OF as DERIVED_AS_OF
from ledgerlens.sources.fixtures import ORDERS, derive_tables
from ledgerlens.sources.schemas import TABLES
from ledgerlens.sources.tables import load_tables, register_views, save_table, write_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return derive_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def audit(tables):
    return RevenueAudit(tables, DERIVED_AS_OF, ORDERS).run_all()


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_cleaning_keeps_every_row(audit):
    for name in TABLES:
        assert audit.clean[name].count() == audit.raw[name].count()
        assert {r[0] for r in audit.status_counts(name).select("record_status").collect()} <= {
            "VALID",
            "SUSPICIOUS",
            "INVALID",
        }
        fine = dict(map(tuple, audit.rule_counts(name).collect()))["No issues detected"]
        assert fine == audit.clean[name].where("record_status = 'VALID'").count()


def test_summary_invariants(audit):
    summary = audit.customer_summary.collect()
    assert len({r.customer_id for r in summary}) == len(summary)
    for r in summary:
        assert 0 <= r.customer_health_score <= 100
        expected = "High Risk" if r.customer_health_score <= 40 else "Watchlist" if r.customer_health_score <= 70 else "Healthy"
        assert r.risk_category == expected


def test_at_risk_totals_agree(audit):
    reports = audit.reports
    totals = [
        sum(r.revenue_at_risk for r in reports[f"revenue_at_risk_by_{k}"]().collect()) for k in ("region", "plan", "channel")
    ]
    totals.append(sum(r.revenue_at_risk for r in audit.executive_summary.select("revenue_at_risk").collect()))
    totals.append(reports["kpis"]().first().revenue_at_risk)
    assert all(math.isclose(t, totals[0], abs_tol=0.02) for t in totals)


def test_same_results_when_nothing_fits_a_broadcast(tables, audit, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "LEAST_HOT_ROWS", 3)
    other = RevenueAudit(tables, DERIVED_AS_OF, ORDERS)
    assert rows(other.customer_summary) == rows(audit.customer_summary)
    assert rows(other.executive_summary) == rows(audit.executive_summary)
    assert rows(other.reports["contradictions"]()) == rows(audit.reports["contradictions"]())


def test_load_export_and_views(spark, tables, audit, tmp_path):
    for name, df in tables.items():
        df.drop("source_file", "source_row").write.parquet(f"{tmp_path}/in/{name}")
    columns = ["customer_id", "customer_health_score", "risk_category", "MRR"]
    loaded = RevenueAudit.from_folder(spark, f"{tmp_path}/in", DERIVED_AS_OF, orders=ORDERS).run_all(f"{tmp_path}/out")
    exported = spark.read.parquet(f"{tmp_path}/out/customer_summary")
    assert rows(exported.select(columns)) == rows(audit.customer_summary.select(columns))
    for name in TABLES:
        assert spark.read.parquet(f"{tmp_path}/out/clean_{name}").count() == tables[name].count()

    loaded.register_views()
    counted = spark.sql("select count(*) from clean_invoices where record_status = 'INVALID'").first()[0]
    assert counted == audit.clean_invoices.where("record_status = 'INVALID'").count()
    assert spark.sql("select count(*) from raw_subscriptions").first()[0] == tables["subscriptions"].count()

    loaded.write_reports(f"{tmp_path}/reports", "csv")
    assert {p.name for p in (tmp_path / "reports").iterdir()} == set(loaded.reports)
    loaded.write_reports(f"{tmp_path}/again", names=["kpis", "monthly_revenue", "kpis"])
    assert {p.name for p in (tmp_path / "again").iterdir()} == {"kpis", "monthly_revenue", "kpis_2"}
    back = spark.read.option("header", True).csv(f"{tmp_path}/reports/executive_summary")
    assert back.count() == 20


def test_executive_table_is_replaced(spark, audit):
    for _ in range(2):
        audit.save_executive_table("executive_test")
    assert spark.table("executive_test").count() == audit.customer_summary.count()
    spark.sql("drop table executive_test")


def test_missing_table(spark, tables, audit, tmp_path):
    with pytest.raises(ValueError, match="Required table 'subscriptions' not found"):
        load_tables(spark, str(tmp_path))
    with pytest.raises(ValueError, match="'invoices'"):
        RevenueAudit({"subscriptions": tables["subscriptions"]}, AS_OF)
    with pytest.raises(ValueError, match="clean_support_cases"):
        clean = {k: v for k, v in audit.clean.items() if k != "support_cases"}
        register_views(audit.raw, clean, audit.customer_summary)


def test_csv_in_load_order(spark, tmp_path):
    lines = {
        "subscriptions": [
            "subscription_id,customer_id,signup_date,renewal_date,monthly_fee,discount_pct,subscription_status,auto_renew,region,plan_name,sales_channel",
            "S1,C1,2023-01-01,2025-01-01,100,10,Active,Y,North,Pro,Partner",
            "S1,C1,2023-01-01,2025-01-01,200,10,Active,Y,North,Pro,Partner",
            "S2,C2,not a date,2025-01-01,oops,,active ,n,,Pro,Partner",
        ],
        "invoices": [
            "invoice_id,subscription_id,invoice_amount,tax_amount,invoice_date,due_date,payment_date,payment_status",
            "I1,S1,50,5,2024-01-01,2024-01-31,2024-01-15,Paid",
        ],
        "product_usage": [
            "usage_id,customer_id,usage_date,login_count,active_minutes,feature_clicks,reports_created,data_exports,seat_count",
            "U1,C1,2024-01-01,3,30,5,1,1,4",
        ],
        "support_cases": ["case_id,customer_id,opened_date,closed_date,resolution_hours,csat_score,case_status"],
    }
    for name, text in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(text) + "\n")
    audit = RevenueAudit.from_folder(spark, str(tmp_path), AS_OF, fmt="csv")
    got = audit.clean_subscriptions.orderBy("source_row").select("record_status", "status_reason", "monthly_fee").collect()
    assert [tuple(r) for r in got] == [
        ("VALID", "No issues detected", 100.0),
        ("INVALID", "Duplicate subscription_id", 200.0),
        ("SUSPICIOUS", "Missing/invalid signup_date; Missing monthly_fee", None),
    ]
    summary = {r.customer_id: r for r in audit.customer_summary.collect()}
    assert summary["C1"].MRR == 90.0 and summary["C2"].MRR == 0.0
    # Nobody has rated anything, so there is no mean to fill in and no score.
    assert summary["C1"].average_csat is None and summary["C1"].risk_category is None


def test_shared_folder(spark, monkeypatch):
    assert shared.shared_folder(spark)

    class Conf:
        def __init__(self, **settings):
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    class Session:
        conf = Conf(**{"spark.sql.warehouse.dir": "hdfs:///warehouse/"})

    assert shared.shared_folder(Session) == "hdfs:///warehouse/_ledgerlens"
    Session.conf = Conf(**{"spark.checkpoint.dir": "hdfs:///scratch/"})
    assert shared.shared_folder(Session) == "hdfs:///scratch"


def test_closing_removes_intermediate_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(shared, "shared_folder", lambda _: str(tmp_path))
    shared.materialize(spark.range(3), "some")
    assert any(tmp_path.rglob("*.parquet"))
    shared.remove_intermediates(spark)
    assert not any(tmp_path.rglob("*.parquet"))


def test_measure_of_nothing(spark):
    written = shared.measure_size(spark.range(5).where("id > 9"), "nothing")
    assert (written.table.count(), written.measures["bytes"]) == (0, 0)
    written = shared.measure_size(frame(spark, "invoices", {}, {}).limit(0), "nothing")
    assert (written.table.count(), written.measures["bytes"]) == (0, 0)


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    """A result is replaced only once the new one is whole."""
    five, seven = spark.range(5).toDF("x"), spark.range(7).toDF("x")
    midway = spark.range(5).selectExpr("if(id = 3, cast(raise_error('midway') as bigint), id) as x")
    write_tables({"t": five}, str(tmp_path))
    with pytest.raises(Exception, match="midway"):
        write_tables({"t": midway}, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and spark.read.parquet(f"{tmp_path}/t").count() == 5
    write_tables({"t": seven}, str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["t"] and spark.read.parquet(f"{tmp_path}/t").count() == 7
    save_table(five, "kept_table")
    try:
        with pytest.raises(Exception, match="midway"):
            save_table(midway, "kept_table")
        assert spark.table("kept_table").count() == 5
        save_table(seven, "kept_table")
        assert spark.table("kept_table").count() == 7
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("kept_table")] == ["kept_table"]
    finally:
        spark.sql("drop table if exists kept_table")
