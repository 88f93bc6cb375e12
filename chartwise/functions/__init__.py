"""Column-level helpers: time arithmetic, numeric rounding, score ladders, text."""
from .time import (add_days, add_hours, add_minutes, boundary_diff, ceil_hour, epoch_seconds,
                   trunc_ntz, hours, days, minutes)
from .numeric import round_numeric, nullsafe_sum, logistic

__all__ = [
    "add_days", "add_hours", "add_minutes", "boundary_diff", "ceil_hour", "epoch_seconds",
    "trunc_ntz", "hours", "days", "minutes", "round_numeric", "nullsafe_sum", "logistic",
]
