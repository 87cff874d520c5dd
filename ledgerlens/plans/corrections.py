"""Departures from the standard results."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Corrections:
    """Each switch replaces a questionable convention of the standard results; all are off by default."""

    # Rows without a region or plan are compared as one group instead of giving a row per side.
    match_missing_groups: bool = False
    # Reported revenue takes ' active ' for 'Active', as trusted revenue does.
    normalise_reported_status: bool = False
    # Invoices and cases without a status do not count in failure and escalation rates.
    ignore_missing_status: bool = False
    # Invoices reach customers through trusted subscriptions only, so none is counted twice.
    trusted_links_only: bool = False
    # Paid invoices are contradictions only if their payment date is missing or too early.
    payment_dates_only: bool = False
    # The executive table reports each customer's own fees instead of those of the region and plan.
    reported_per_customer: bool = False
    # Attributes come from an active subscription if there is one, and an unknown signup is the oldest.
    prefer_active: bool = False
    # A renewal date in the past is not a renewal due soon.
    upcoming_renewals_only: bool = False
    # The customer summary tells customers without usage or invoices from those with bad figures.
    activity_flags: bool = False
    # The company's mean discount and renewal rate are over subscriptions instead of over plans.
    weigh_plans: bool = False
    # Expired subscriptions count as cancelled in the reports too.
    expired_is_cancelled: bool = False
    # The first of several rows with one id is the first without another fault.
    first_sound_row: bool = False


STANDARD = Corrections()
