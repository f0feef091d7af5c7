from playtrail.sources.browse_log import (
    parse_lines,
    read_browse_log,
    read_clean_log,
    read_rejected_lines,
    rejected_lines,
)
from playtrail.sources.keyed_table import REPORT_COLUMNS, read_cells, read_keyed_table
from playtrail.sources.topics import kafka_options, read_kafka, read_topic_files

__all__ = [
    "REPORT_COLUMNS",
    "kafka_options",
    "parse_lines",
    "read_browse_log",
    "read_cells",
    "read_clean_log",
    "read_kafka",
    "read_keyed_table",
    "read_rejected_lines",
    "read_topic_files",
    "rejected_lines",
]
