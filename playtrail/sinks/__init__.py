from playtrail.sinks.browse_store import clean_log, write_browse_log
from playtrail.sinks.growing_log import add_new_files, read_counts, read_growing_log, read_ledger
from playtrail.sinks.key_ranges import key_range_files, read_key_range, write_key_ranges
from playtrail.sinks.keyed_table import merge_keyed_table, write_cells, write_keyed_table
from playtrail.sinks.stat_tables import (
    STAT_TABLES,
    StatTable,
    read_stat,
    report_rows,
    stat_rows,
    write_stat,
    write_stat_jdbc,
)

__all__ = [
    "STAT_TABLES",
    "StatTable",
    "add_new_files",
    "clean_log",
    "key_range_files",
    "merge_keyed_table",
    "read_counts",
    "read_growing_log",
    "read_key_range",
    "read_ledger",
    "read_stat",
    "report_rows",
    "stat_rows",
    "write_browse_log",
    "write_cells",
    "write_key_ranges",
    "write_keyed_table",
    "write_stat",
    "write_stat_jdbc",
]
