"""Report jobs (RPT-1..RPT-5): pure functions of input DataFrames and a ``BusinessDate``."""

from cardflow.plans.adjustment_transactions import adjustment_transactions
from cardflow.plans.application_summary import SummaryRules, daily_application_summary, run_daily_application_summary
from cardflow.plans.interest_adjustments import interest_adjustments_mtd
from cardflow.plans.new_flagged_accounts import flagged_delta, flagged_report, new_flagged_accounts
from cardflow.plans.plan_postings import plan_postings_mtd

__all__ = [
    "SummaryRules",
    "adjustment_transactions",
    "daily_application_summary",
    "flagged_delta",
    "flagged_report",
    "interest_adjustments_mtd",
    "new_flagged_accounts",
    "plan_postings_mtd",
    "run_daily_application_summary",
]
