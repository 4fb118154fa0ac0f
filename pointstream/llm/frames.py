"""Small helpers on DataFrames that the operators share."""

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from pointstream.storage import shared_folder


def free_name(frame: DataFrame, name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(columns: list[str], made: list[str]) -> list[str]:
    """Columns that stay: one with the name of a result gives way to it."""
    results = {name.lower() for name in made}
    return [column for column in columns if column.lower() not in results]


def set_aside(frame: DataFrame, made: list[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """Columns with these names renamed, and the way back to the frame's own columns.

    The way back takes a frame and the names of columns to add to the frame's own.
    """
    results = {name.lower() for name in made}
    clash = [column for column in frame.columns if column.lower() in results]
    names, aside = {}, frame
    for column in clash:
        names[column] = free_name(aside, f"_given_{column}")
        aside = aside.withColumnRenamed(column, names[column])

    def back(result: DataFrame, *added: str) -> DataFrame:
        stay = [F.col(f"`{names.get(c, c)}`").alias(c) for c in frame.columns]
        return result.select(*stay, *added)

    return aside, back


def given_and_text(
    docs: DataFrame, text: str, keep: list[str] | None, made: list[str], inner: list[str]
) -> tuple[DataFrame, str, list[str], Callable[..., DataFrame]]:
    """What an operator that annotates rows starts from.

    The columns to keep (all unless given), without those that give way to the results
    ``made``, and those with an ``inner`` name set aside; and the text under a free name.
    Returns the frame, that name, the other columns and the way back to kept columns.
    """
    stay = [f"`{c}`" for c in without(docs.columns if keep is None else keep, made)]
    aside, back = set_aside(docs.select(*stay), inner)
    name = free_name(aside, "_text")
    both = docs.select(*stay, F.col(f"`{text}`").alias(name))
    return both.toDF(*aside.columns, name), name, aside.columns, back


def kept(spark: SparkSession, frame: DataFrame, purpose: str) -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Cuts the lineage: a lost executor costs no recomputation beyond this table.
    """
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def give_back() -> None:
    """Hand freed memory of this worker back to the system.

    Workers serve one stage after another, and what a stage has freed would else stay
    with the process beside what the next one takes.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that hands freed memory back at the end of its task."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


# Rows of an Arrow batch: a batch of the usual 10,000 rows of long texts takes hundreds of
# megabytes in the executor and as much in its worker.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
MOST_BATCH_ROWS = 2048


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from the path that the driver has it in.

    A cluster whose machines do not have that path gets the package by ``--py-files``.
    Unless the session says how many rows an Arrow batch has, it has ``MOST_BATCH_ROWS``.
    """
    if spark.conf.get(BATCH_ROWS, None) is None:
        spark.conf.set(BATCH_ROWS, str(MOST_BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}" if known else root
