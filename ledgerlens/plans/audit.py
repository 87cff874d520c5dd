"""The whole audit of one set of tables."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.functions.dates import Inferred, format_report, inferred_formats, patterns
from ledgerlens.operators.rules import rule_counts, status_counts
from ledgerlens.operators.shared import Measured, materialize, remove_intermediates, together
from ledgerlens.plans import dashboard, executive, health, metrics, reports, validators
from ledgerlens.plans.corrections import STANDARD, Corrections
from ledgerlens.plans.validators import Formats
from ledgerlens.sources.schemas import TABLES
from ledgerlens.sources.tables import load_tables, register_views, save_table, without_missing_texts, write_tables


class RevenueAudit:
    """Classified tables, customer summary and reports for one set of input tables.

    Everything is built when first asked for. The customer summary, which most reports read, is
    written to the shared folder once, and so are the classified subscriptions, of which it is made
    in several ways.

    ``tables`` holds the four inputs by name. ``as_of`` is the day on which renewals are judged.
    ``orders`` replaces the columns that give a table its load order, ``formats`` are date
    patterns for text columns beyond ISO; not given, each column's is inferred (``date_formats``), and an
    empty list leaves ISO alone. ``require_case_customer`` turns on the rule against
    support cases without a customer, and ``corrections`` replaces conventions of the results.
    """

    def __init__(
        self,
        tables: Mapping[str, DataFrame],
        as_of: date,
        orders: Mapping[str, Sequence[str]] | None = None,
        formats: Sequence[str] | None = None,
        require_case_customer: bool = False,
        corrections: Corrections = STANDARD,
    ):
        for name in TABLES:
            if name not in tables:
                raise ValueError(f"Required table '{name}' not given.")
        self.raw = {name: without_missing_texts(tables[name], spec.columns) for name, spec in TABLES.items()}
        self.as_of = as_of
        self.orders = {name: tuple((orders or {}).get(name, spec.order)) for name, spec in TABLES.items()}
        self.given_formats = None if formats is None else tuple(formats)
        self.require_case_customer = require_case_customer
        self.corrections = corrections
        self._written: set[str] = set()

    @classmethod
    def from_folder(cls, spark: SparkSession, folder: str, as_of: date, fmt: str = "parquet", **options) -> RevenueAudit:
        return cls(load_tables(spark, folder, fmt), as_of, **options)

    @cached_property
    def date_formats(self) -> dict[str, dict[str, Inferred]]:
        """The inferred format of every date column that holds text, by table; a draw between formats names its ``rivals``."""
        builds = [lambda n=name, s=spec: inferred_formats(self.raw[n], s.timestamps) for name, spec in TABLES.items()]
        return dict(zip(TABLES, together(*builds)))

    def date_format_report(self) -> DataFrame:
        return format_report(self.raw["subscriptions"].sparkSession, self.date_formats)

    def _formats(self, name: str) -> Formats:
        return patterns(self.date_formats[name]) if self.given_formats is None else self.given_formats

    # Classified tables

    @cached_property
    def clean_subscriptions(self) -> DataFrame:
        name = "subscriptions"
        options = self.orders[name], self._formats(name), self.corrections
        return validators.clean_subscriptions(self.raw[name], self.as_of, *options)

    @cached_property
    def written_subscriptions(self) -> DataFrame:
        """The classified subscriptions in the shared folder; from then on all results read these."""
        self._write_clean("subscriptions")
        return self.clean_subscriptions

    @cached_property
    def clean_invoices(self) -> DataFrame:
        name = "invoices"
        options = self.orders[name], self._formats(name), self.corrections
        return validators.clean_invoices(self.raw[name], self.clean_subscriptions, *options)

    @cached_property
    def clean_product_usage(self) -> DataFrame:
        name = "product_usage"
        options = self.orders[name], self._formats(name), self.corrections
        return validators.clean_product_usage(self.raw[name], self.clean_subscriptions, *options)

    @cached_property
    def clean_support_cases(self) -> DataFrame:
        name = "support_cases"
        options = self.orders[name], self._formats(name), self.corrections, self.require_case_customer
        return validators.clean_support_cases(self.raw[name], self.clean_subscriptions, *options)

    @property
    def clean(self) -> dict[str, DataFrame]:
        self.written_subscriptions  # noqa: B018 - the other three need it
        found = together(*[lambda n=name: getattr(self, f"clean_{n}") for name in TABLES])
        return dict(zip(TABLES, found))

    def _write_clean(self, name: str) -> None:
        self._written.add(name)
        setattr(self, f"clean_{name}", materialize(getattr(self, f"clean_{name}"), f"clean_{name}"))

    # Customer level

    @cached_property
    def usage_scores(self) -> DataFrame:
        return metrics.usage_intensity(self.clean_product_usage)

    @cached_property
    def invoice_sums(self) -> Measured:
        """Of the classified invoices, what all figures of customers are made of; written once."""
        invoices = self.__dict__.get("invoice_facts", self.clean_invoices)
        return metrics.invoice_sums(invoices, self.corrections)

    @cached_property
    def invoice_facts(self) -> DataFrame:
        """Of the classified invoices, what sums and contradictions read; written, for reports that ask for both."""
        self.written_subscriptions  # noqa: B018 - the invoices need it
        if "invoices" in self._written:
            return self.clean_invoices
        return materialize(self.clean_invoices.select(*metrics.INVOICE_FACTS), "invoice_facts")

    @cached_property
    def customer_metrics(self) -> DataFrame:
        self.written_subscriptions  # noqa: B018 - read by all that follows
        together(lambda: self.invoice_sums, lambda: self.usage_scores, lambda: self.clean_support_cases)
        return metrics.customer_metrics(
            self.clean_subscriptions,
            self.invoice_sums,
            self.usage_scores,
            self.clean_support_cases,
            self.as_of,
            self.orders["subscriptions"],
            self.corrections,
        )

    @cached_property
    def customers(self) -> DataFrame:
        """The customer summary and the totals that the reports show beside it, a row per customer, written once.

        What the reports ask of a customer is here, so none of them joins tables by customer again.
        """
        scored = health.with_health(self.customer_metrics)
        tables = self.clean_subscriptions, self.invoice_sums, self.clean_support_cases
        return materialize(executive.with_totals(scored, *tables, self.corrections), "customers")

    @cached_property
    def customer_summary(self) -> DataFrame:
        return self.customers.drop(*executive.TOTALS)

    @cached_property
    def executive_summary(self) -> DataFrame:
        """Written once: five data sets and the saved table read it."""
        table = executive.executive_summary(self.customers, self.raw["subscriptions"], self.corrections)
        return materialize(table, "executive_summary")

    # Reports

    def invoice_contradictions(self) -> DataFrame:
        """The contradictions that invoices show, of written subscriptions."""
        subscriptions = self.written_subscriptions  # before the invoices, which read it
        return reports.invoice_contradictions(
            self.clean_invoices, subscriptions, self.orders["invoices"], self.corrections
        )

    @property
    def reports(self) -> dict[str, Callable[[], DataFrame]]:
        """The reports by name; each call builds one."""
        raw, corrections = self.raw["subscriptions"], self.corrections

        def with_summary(report: Callable[..., DataFrame], *arguments: str) -> Callable[[], DataFrame]:
            # The summary comes first: building it writes the classified subscriptions.
            return lambda: report(*[getattr(self, a) for a in ("customer_summary", *arguments)])

        def contradictions() -> DataFrame:
            invoices = self.invoice_facts  # before the summary, which then reads these
            return reports.top_contradictions(self.customer_summary, invoices, self.clean_subscriptions, corrections)

        return {
            "trusted_vs_reported_mrr": lambda: reports.trusted_vs_reported(
                raw, self.clean_subscriptions, corrections
            ),
            "high_revenue_low_usage": lambda: reports.high_revenue_low_usage(self.customers),
            "discount_vs_retention": with_summary(
                lambda summary, s: reports.discount_vs_retention(s, summary, corrections), "clean_subscriptions"
            ),
            "revenue_at_risk_by_region": with_summary(lambda summary: reports.revenue_at_risk(summary, "region")),
            "revenue_at_risk_by_plan": with_summary(lambda summary: reports.revenue_at_risk(summary, "plan_name")),
            "revenue_at_risk_by_channel": with_summary(
                lambda summary: reports.revenue_at_risk(summary, "sales_channel")
            ),
            "contradictions": contradictions,
            "executive_summary": lambda: executive.top_at_risk(self.executive_summary),
            "region_ranking": lambda: dashboard.region_ranking(raw, self.clean_subscriptions, corrections),
            "kpis": with_summary(
                lambda summary, s: dashboard.kpis(raw, s, summary, corrections), "clean_subscriptions"
            ),
            "customer_points": lambda: dashboard.customer_points(self.executive_summary),
            "region_plan_matrix": with_summary(
                lambda summary, s: dashboard.region_plan_matrix(s, summary, corrections), "clean_subscriptions"
            ),
            "monthly_revenue": lambda: dashboard.monthly_revenue(self.clean_invoices),
            "customers_to_act_on": lambda: dashboard.customers_to_act_on(
                self.executive_summary, self.customer_summary
            ),
            "region_plan_customer": lambda: dashboard.region_plan_customer(self.executive_summary),
        }

    # Output

    def __enter__(self) -> RevenueAudit:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Delete the intermediate tables of this Spark application, once no result is needed any more."""
        remove_intermediates(self.raw["subscriptions"].sparkSession)

    def status_counts(self, name: str) -> DataFrame:
        return status_counts(getattr(self, f"clean_{name}"))

    def rule_counts(self, name: str) -> DataFrame:
        return rule_counts(getattr(self, f"clean_{name}"))

    def write_clean(self) -> None:
        """Write the classified tables to the shared folder; from then on all results read these."""
        self.written_subscriptions  # noqa: B018 - the other three need it
        missing = [name for name in TABLES if name not in self._written]
        together(*[lambda n=name: self._write_clean(n) for name in missing] or [lambda: None])

    def register_views(self) -> None:
        """The views read written tables, so that a query on one of them classifies nothing again."""
        self.write_clean()
        register_views(self.raw, self.clean, self.customer_summary)

    def save_executive_table(self, name: str = "executive_customer_risk_summary") -> None:
        save_table(self.executive_summary, name)

    def export(self, folder: str, fmt: str = "parquet") -> None:
        """Write the classified tables and the customer summary."""
        tables = {f"clean_{name}": df for name, df in self.clean.items()}
        write_tables({**tables, "customer_summary": self.customer_summary}, folder, fmt)

    def write_reports(self, folder: str, fmt: str = "parquet", names: Sequence[str] | None = None) -> None:
        """Run the named reports, by default all, and write one result per name.

        A name given again is written again, with its number: ``kpis``, ``kpis_2``, ``kpis_3``.
        """
        reports, seen = self.reports, Counter()
        for name in names or reports:
            seen[name] += 1
            target = name if seen[name] == 1 else f"{name}_{seen[name]}"
            write_tables({target: reports[name]()}, folder, fmt)

    def run_all(self, folder: str | None = None, fmt: str = "parquet") -> RevenueAudit:
        """Classify, measure, score; with ``folder``, write the tables there.

        Also writes the classified tables to the shared folder, for sessions that run many reports.
        """
        self.written_subscriptions  # noqa: B018 - read by all that follows

        def usage() -> None:
            self._write_clean("product_usage")
            self.usage_scores  # noqa: B018

        together(lambda: self._write_clean("invoices"), usage, lambda: self._write_clean("support_cases"))
        self.customer_summary  # noqa: B018
        if folder:
            self.export(folder, fmt)
        return self
