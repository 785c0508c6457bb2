"""The layers: staging, marts, loyalty ledger, analytics, quality report, and the full run."""

from ledgerloom.plans.analytics import build_analytics, kpi_summary
from ledgerloom.plans.marts import build_marts
from ledgerloom.plans.quality import quality_report
from ledgerloom.plans.run import drop_runs, published_layers, run, run_layers, run_summary
from ledgerloom.plans.staging import build_staging

__all__ = [
    "build_analytics",
    "build_marts",
    "build_staging",
    "drop_runs",
    "kpi_summary",
    "published_layers",
    "quality_report",
    "run",
    "run_layers",
    "run_summary",
]
