"""Multi-step runs built from the operators."""

from tablewatch.plans.daily_audit import run_daily_audit
from tablewatch.plans.loads import run_flags, run_gated_loads
from tablewatch.plans.validation import ValidationRun, append_reports, run_validation

__all__ = ["ValidationRun", "append_reports", "run_daily_audit", "run_flags", "run_gated_loads", "run_validation"]
