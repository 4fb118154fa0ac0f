"""Message and console writers."""

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from pointstream.streaming.settings import JobSettings


def write_messages(messages: DataFrame, format: str = "kafka", **options: str) -> None:
    """Send the ``value`` column to a topic, or to files with ``format="text"``."""
    messages.select("value").write.format(format).options(**options).mode("append").save()


def stream_messages(
    messages: DataFrame, settings: JobSettings, format: str = "kafka", **options: str
) -> StreamingQuery:
    """The same as a streaming query."""
    writer = messages.select("value").writeStream.format(format).options(**options)
    return settings.start(writer)


def print_rows(
    rows: DataFrame,
    settings: JobSettings,
    mode: str = "append",
    limit: int | None = None,
    width: int | None = None,
) -> StreamingQuery:
    """Print each micro-batch on the driver's console.

    All rows and whole cells, unless ``limit`` and ``width`` bound them. Rows are
    fetched a partition at a time.
    """

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}: {', '.join(batch.columns)}")
        shown = batch if limit is None else batch.limit(limit)
        for row in shown.toLocalIterator():
            cells = (str(cell) for cell in row)
            print(" | ".join(cell if width is None else cell[:width] for cell in cells))

    return settings.start(rows.writeStream.outputMode(mode).foreachBatch(show))
