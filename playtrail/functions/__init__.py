from playtrail.functions.keys import exact_row_key, row_key
from playtrail.functions.log_text import browse_fields, browse_line
from playtrail.functions.net import ipv4_number
from playtrail.functions.time_parts import (
    GRAINS,
    bucket,
    compact_timestamp,
    day_of,
    hour_of,
    minute_of,
    month_of,
    year_of,
)

__all__ = [
    "GRAINS",
    "browse_fields",
    "browse_line",
    "bucket",
    "compact_timestamp",
    "day_of",
    "exact_row_key",
    "hour_of",
    "ipv4_number",
    "minute_of",
    "month_of",
    "row_key",
    "year_of",
]
