"""Account-opening and onboarding reports as Spark DataFrame jobs."""

from vestibule.plans.change import hourly_change
from vestibule.plans.kept import run_kept_reports
from vestibule.plans.onboarding import cohort_matrix
from vestibule.plans.openings import openings_by_hour, openings_by_month
from vestibule.plans.pipeline import run_reports

__all__ = [
    "cohort_matrix",
    "hourly_change",
    "openings_by_hour",
    "openings_by_month",
    "run_kept_reports",
    "run_reports",
]
