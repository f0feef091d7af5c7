"""Row shapes shared by the batch and the streaming side."""

from pyspark.sql import types as T

# Column names and order of the clean browse log; fixed values that stored tables rely on.
BROWSE_COLUMNS = ["ip", "date", "androidVersion", "phoneModel", "gameName", "gameId"]

BROWSE_LOG = T.StructType(
    [
        T.StructField("ip", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("androidVersion", T.StringType()),
        T.StructField("phoneModel", T.StringType()),
        T.StructField("gameName", T.StringType()),
        T.StructField("gameId", T.IntegerType()),
    ]
)

# The stored form of a parsed log: one table holds clean rows and rejected lines, kept apart by
# the `status` folder, so that a single pass over the text fills both.
PARSED_LOG = T.StructType(
    BROWSE_LOG.fields
    + [
        T.StructField("event_time", T.TimestampType()),
        T.StructField("line", T.StringType()),
        T.StructField("reject_reason", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)

TOPIC_MESSAGE = T.StructType(
    [T.StructField("topic", T.StringType()), T.StructField("value", T.StringType())]
)

CELL = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.BinaryType()),
    ]
)
