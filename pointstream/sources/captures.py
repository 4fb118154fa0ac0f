"""Captured datagrams as frames ``(…, recv_time TIMESTAMP, payload BINARY)``."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pointstream.schemas import FRAME
from pointstream.streaming.settings import JobSettings

# Columns of Spark's binary files, which a stream of them must be told.
_BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def read_captures(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Parquet capture files with the columns of ``FRAME``; the form for volume."""
    return _reader(spark, stream).schema(FRAME).parquet(path)


def read_datagram_files(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """One datagram per file; the file time stands for the arrival time."""
    files = _reader(spark, stream).format("binaryFile").schema(_BINARY_FILE).load(path)
    return files.select(
        "path", F.col("modificationTime").alias("recv_time"), F.col("content").alias("payload")
    )


def land_datagrams(
    spark: SparkSession,
    source: str,
    landing: str,
    settings: JobSettings,
    archive: str | None = None,
    delete: bool = False,
) -> StreamingQuery:
    """Gathers one-datagram files into Parquet capture files, each datagram once.

    A stream: a restart goes on where it ended, and the landing folder keeps the log of
    Spark's file sink, which ``read_captures`` goes by. Files of batches that are done are
    moved to ``archive`` or deleted, if asked for, so that the listing of the source stays
    short; a batch cleans up what the batch before it read. ``frame_id`` is a hash of the
    file's path, ``batch_files`` bounds a batch.
    """
    reader = spark.readStream.format("binaryFile").schema(_BINARY_FILE)
    if settings.batch_files is not None:
        reader = reader.option("maxFilesPerTrigger", settings.batch_files)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    elif delete:
        reader = reader.option("cleanSource", "delete")
    frames = reader.load(source).select(
        F.xxhash64("path").alias("frame_id"),
        F.col("modificationTime").alias("recv_time"),
        F.col("content").alias("payload"),
    )
    return settings.start(frames.writeStream.format("parquet").option("path", landing))
