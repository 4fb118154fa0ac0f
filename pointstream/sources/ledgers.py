"""Landed ledger responses as a ``value STRING`` column, one response per row."""

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_responses(
    spark: SparkSession, path: str, ledger: str | None = None, whole_file: bool = True
) -> DataFrame:
    """Responses below ``path``, or below ``path/ledger`` for a named ledger.

    ``whole_file=True`` takes a file as one response (its JSON may span lines);
    ``False`` takes each line as one, which lets large files be split.
    """
    folder = f"{path}/{ledger}" if ledger else path
    rows = spark.read.text(folder, wholetext=whole_file)
    return rows if ledger is None else rows.withColumn("ledger", F.lit(ledger))


def read_response_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one response each, cut at every comma: for responses too large for a task.

    Columns: ``file``, ``block`` (where the part of the file begins that a task reads),
    ``row`` (ascending in a block) and ``piece``; partition columns of the folder stay.
    A file is read in as many tasks as its size asks for, as lines are.
    """
    rows = spark.read.option("lineSep", ",").text(path)
    return rows.select(
        *(c for c in rows.columns if c != "value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").alias("piece"),
    )
