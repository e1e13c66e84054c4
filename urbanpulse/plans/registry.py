"""All registered reports, in one dict (batch, scoring, maintenance, streaming)."""

from __future__ import annotations

from urbanpulse.plans import catalog, extra, more
from urbanpulse.streaming import more_reports, reports


def all_reports():
    return {**catalog.REPORTS, **more.REPORTS, **extra.REPORTS, **reports.REPORTS, **more_reports.REPORTS}
