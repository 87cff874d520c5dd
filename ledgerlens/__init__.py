"""Data-quality audit, customer metrics and revenue reports for subscription businesses, on Spark."""

from ledgerlens.plans.audit import RevenueAudit
from ledgerlens.plans.corrections import Corrections

__all__ = ["Corrections", "RevenueAudit"]
