from playtrail.streaming.blocklist import exclude_listed, exclude_users, flag_blocked, measure_blocklist, with_possible_members
from playtrail.streaming.events import parse_downloads, parse_messages, parse_payments, rejected_messages
from playtrail.streaming.runs import newest_batch, read_totals, read_windows
from playtrail.streaming.tables import (
    add_sums,
    append_rows,
    keep_daily,
    keep_snapshot,
    keep_sums,
    keep_totals,
    read_daily,
    read_snapshot,
)
from playtrail.streaming.totals import (
    running_downloads,
    running_payments,
    sliding_downloads,
    sliding_payments,
)

__all__ = [
    "add_sums",
    "append_rows",
    "exclude_listed",
    "exclude_users",
    "flag_blocked",
    "keep_daily",
    "keep_snapshot",
    "keep_sums",
    "keep_totals",
    "measure_blocklist",
    "newest_batch",
    "parse_downloads",
    "parse_messages",
    "parse_payments",
    "read_daily",
    "read_snapshot",
    "read_totals",
    "read_windows",
    "rejected_messages",
    "running_downloads",
    "running_payments",
    "sliding_downloads",
    "sliding_payments",
    "with_possible_members",
]
