from watchledger.functions.amounts import (
    amortize_monthly,
    half_up_ratio,
    half_up_ratio_wide,
    mean_of_amounts,
    minutes_to_hours,
    share_4dp,
)
from watchledger.functions.texts import blank_to_null, first_match, is_filled
from watchledger.functions.times import (
    date_key,
    month_start,
    parse_mixed_timestamp,
    recency_status,
)

__all__ = [
    "amortize_monthly",
    "blank_to_null",
    "date_key",
    "first_match",
    "half_up_ratio",
    "half_up_ratio_wide",
    "mean_of_amounts",
    "is_filled",
    "minutes_to_hours",
    "month_start",
    "parse_mixed_timestamp",
    "recency_status",
    "share_4dp",
]
