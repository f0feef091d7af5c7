"""Reading the keyed browse table, as rows or as cells."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playtrail.schema import CELL

# The columns each report needs.
REPORT_COLUMNS = {
    "by_month": ["date", "gameName", "gameId"],
    "by_city": ["ip", "gameName", "gameId"],
    "by_phone_model": ["phoneModel"],
    "by_hour": ["date"],
}


def read_keyed_table(
    spark: SparkSession, path: str, report: str | None = None, schema: StructType | str | None = None
) -> DataFrame:
    """The newest row per key, with all columns or just those of one report.

    A table that may have no rows, hence no files, needs its `schema`.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    return table if report is None else table.select(*REPORT_COLUMNS[report])


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a keyed table with their bytes decoded to text."""
    cells = spark.read.schema(CELL).parquet(path)
    return cells.select("row_key", "qualifier", F.decode("value", "UTF-8").alias("value"))
