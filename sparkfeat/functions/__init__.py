"""Column expressions: all built-in, codegen-friendly."""

from .rules import (binary_target, decode_label, lookup, membership_flag, range_flag,
                    region_of, threshold_flag)
from .temporal import (day_of_week, decade_of, duration_days, hour_of_hhmm, lenient_number,
                       lenient_timestamp, month_of)

__all__ = ["binary_target", "decode_label", "lookup", "membership_flag", "range_flag",
           "region_of", "threshold_flag", "day_of_week", "decade_of", "duration_days",
           "hour_of_hhmm", "lenient_number", "lenient_timestamp", "month_of"]
