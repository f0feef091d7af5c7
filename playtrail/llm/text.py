"""What the text operators share: words, reading the documents, tables kept in the shared folder."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtrail.scratch import new_folder, remove_folder

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole(text: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def without_space(text: Column) -> Column:
    """The text with every white-space character deleted; six plain replacements are faster than one pattern."""
    for mark in " \t\n\x0b\x0c\r":
        text = F.replace(text, F.lit(mark), F.lit(""))
    return text


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back, so that they are computed once.

    Lost executors cost nothing of it: the files are in the folder that all of them share.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read.stored_in = path
    return read


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that `stored` has made, once what was made of them is stored itself."""
    for table in tables:
        remove_folder(table.sparkSession, table.stored_in)


def bound(value: Column, use) -> Column:
    """`use(value)` with the value computed once a row, however often `use` refers to it."""
    return F.element_at(F.transform(F.array(value), use), 1)
