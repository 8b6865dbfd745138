from .landing import check_landing
from .run import run_landing
from .validate import CheckResult, check_records, now_utc

__all__ = ["CheckResult", "check_landing", "check_records", "now_utc", "run_landing"]
