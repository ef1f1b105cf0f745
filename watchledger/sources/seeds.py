"""Raw inputs as CSV files with a header."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The column that holds the text of a record that does not fit.
REJECTED = "_rejected"

# The headers of the raw files.
SEED_COLUMNS = {
    "customers": (
        "Customer ID",
        "First Paid Order Date",
        "First Order Date",
        "Total Spent",
    ),
    "orders": (
        "Order ID",
        "Order Number",
        "Order Created At",
        "Customer ID",
        "Line Items",
        "Billing Address Country",
        "Net (USD)",
    ),
    "courses": ("Course Name", "Course Type", "Course Instructor"),
    "consumption": ("User ID", "Course Name", "Minutes Consumed"),
}


class RaggedSeed(ValueError):
    """A CSV file has records that do not fit its header."""


def read_csv_seed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    multiline: bool = False,
    rejects: bool = False,
) -> DataFrame:
    """Read a headed CSV with every column as text; staging casts later.

    The header of every file is checked against ``columns``: one file's at once,
    each file's when it is read, and a file with another header fails that job.
    Quotes are doubled inside quoted fields, and surrounding blanks are kept for
    staging to trim.

    A record with a field too many or too few fails the job that reads it, even
    if only other columns are asked for; with ``rejects`` such records get
    nulls and their text in a column ``_rejected`` instead, to be split off and
    counted. A line break within quotes fails at once, found by a scan that
    looks for lines with an odd number of quotes, unless ``multiline`` is set:
    then a file is read by one task, as it cannot be split.
    """
    texts = [T.StructField(c, T.StringType()) for c in columns]
    schema = T.StructType([*texts, T.StructField(REJECTED, T.StringType())])
    options = {
        "header": True,
        # Compares each file's header with the schema, less the reject column.
        "enforceSchema": False,
        "escape": '"',
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": REJECTED,
        "multiLine": multiline,
        # Else a record would be split only as far as the query needs.
        "columnPruning": False,
    }
    read = spark.read.options(**options).schema(schema).csv(path)
    _check_header(spark, path, columns, multiline)
    if not multiline:
        _check_quotes(spark, path)
    if rejects:
        return read
    # Bound to every column, so that no selection can prune the check away.
    message = F.concat(F.lit("record does not fit the header: "), F.col(REJECTED))
    return read.select(
        *[
            F.when(F.col(REJECTED).isNotNull(), F.raise_error(message).cast("string"))
            .otherwise(F.col(f"`{c}`"))
            .alias(c)
            for c in columns
        ]
    )


def _check_header(
    spark: SparkSession, path: str, columns: Sequence[str], multiline: bool
) -> None:
    """One file's first record must be the header; blanks and case count."""
    headers = spark.read.csv(path, header=True, escape='"', multiLine=multiline).columns
    if headers != list(columns):
        raise RaggedSeed(f"the header of {path} is {headers}, not {list(columns)}")


def _check_quotes(spark: SparkSession, path: str) -> None:
    """A record in several lines leaves a line with a quote that is not closed."""
    line = F.col("value")
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    for row in spark.read.text(path).where(quotes % 2 == 1).limit(1).collect():
        raise RaggedSeed(f"a quote is not closed within the line: {row.value}")


def write_csv_seed(df: DataFrame, path: str) -> None:
    """Write a headed CSV that ``read_csv_seed`` reads back unchanged."""
    df.write.mode("overwrite").csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Pick columns whose names hold blanks or brackets, under new names."""
    return df.select(*[F.col(f"`{raw}`").alias(new) for raw, new in names.items()])
