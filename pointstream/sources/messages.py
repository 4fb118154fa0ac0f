"""JSON messages as a ``value STRING`` column, from any source that has one."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pointstream.streaming.settings import JobSettings


def batch_limit(format: str, settings: JobSettings | None) -> dict[str, str]:
    """Source option that bounds one micro-batch: rows of a topic, bytes or files of a folder.

    A folder gives whole files: a batch ends before the file that would go beyond
    ``batch_bytes``, but has one file at least. Files larger than that are cut by
    :func:`bounded_files` first.
    """
    if settings is None:
        return {}
    if format == "kafka":
        name, size = "maxOffsetsPerTrigger", settings.batch_rows
    elif settings.batch_bytes is not None:
        name, size = "maxBytesPerTrigger", settings.batch_bytes
    else:
        name, size = "maxFilesPerTrigger", settings.batch_files
    return {} if size is None else {name: str(size)}


def read_messages(
    spark: SparkSession,
    format: str = "kafka",
    stream: bool = True,
    settings: JobSettings | None = None,
    **options: str,
) -> DataFrame:
    """Message stream; a topic is read from its latest offset unless told else.

    The settings of the job that reads the stream bound its micro-batches.
    """
    if stream and format == "kafka":
        options = {"startingOffsets": "latest", **options}
    reader = spark.readStream if stream else spark.read
    if stream:
        options = {**options, **batch_limit(format, settings)}
    rows = reader.format(format).options(**options).load()
    return rows.withColumn("value", F.col("value").cast("string"))


def bounded_files(
    spark: SparkSession, source: str, landing: str, settings: JobSettings, format: str = "text"
) -> StreamingQuery:
    """Cuts the text files of a folder into files of at most ``batch_rows`` rows each.

    A stream of its own: large files are read in many tasks, and each task starts a new
    file after ``batch_rows`` rows. The landing folder keeps the log of Spark's file sink,
    which readers of it go by, so a file that was written twice is read once. Reading it
    with ``batch_files=1`` bounds a micro-batch by rows, whatever the size of the files
    that came in.
    """
    if settings.batch_rows is None:
        raise ValueError("batch_rows is the number of rows of a file")
    rows = spark.readStream.format(format).options(**batch_limit(format, settings)).load(source)
    writer = rows.writeStream.format(format).option("path", landing)
    return settings.start(writer.option("maxRecordsPerFile", settings.batch_rows))
