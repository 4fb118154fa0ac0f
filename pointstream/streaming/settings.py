"""Settings that every streaming query carries."""

import dataclasses
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


@dataclass(frozen=True)
class JobSettings:
    """Query name, checkpoint folder and trigger.

    ``interval`` is the time between micro-batches, and so between checkpoints
    and flushes. ``available_now`` handles what is there and stops. ``batch_rows``
    bounds a micro-batch of a topic, ``batch_files`` or ``batch_bytes`` one of a folder;
    ``read_messages`` applies them at the source. ``parallelism`` is the number of
    tasks that look up and write a micro-batch; without it, those that read it do.
    """

    name: str
    checkpoint: str
    interval: str = "5 seconds"
    available_now: bool = False
    batch_rows: int | None = None
    batch_files: int | None = None
    parallelism: int | None = None
    batch_bytes: int | None = None

    @classmethod
    def from_properties(cls, path: str) -> "JobSettings":
        """Settings from ``key=value`` lines named like the fields; ``#`` comments."""
        lines = (line.strip() for line in Path(path).read_text().splitlines())
        pairs = dict(
            (part.strip() for part in line.split("=", 1))
            for line in lines
            if line and not line.startswith("#")
        )
        known = {field.name for field in dataclasses.fields(cls)}
        unknown = sorted(set(pairs) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        values: dict = dict(pairs)
        if "available_now" in values:
            values["available_now"] = values["available_now"].lower() == "true"
        for name in ("batch_rows", "batch_files", "batch_bytes", "parallelism"):
            if name in values:
                values[name] = int(values[name])
        return cls(**values)

    def beside(self, suffix: str) -> "JobSettings":
        """Settings of a second query of the same job, with its own checkpoint."""
        return dataclasses.replace(
            self, name=f"{self.name}_{suffix}", checkpoint=f"{self.checkpoint}_{suffix}"
        )

    def dealt(self, batch: DataFrame) -> DataFrame:
        """A micro-batch in as many partitions as the settings ask for."""
        return batch if self.parallelism is None else batch.repartition(self.parallelism)

    def start(self, writer: DataStreamWriter) -> StreamingQuery:
        """Start a prepared writer under these settings."""
        writer = writer.queryName(self.name).option("checkpointLocation", self.checkpoint)
        if self.available_now:
            return writer.trigger(availableNow=True).start()
        return writer.trigger(processingTime=self.interval).start()


# Flush profiles: the production job, and the first version's smaller batches.
PRODUCTION_INTERVAL = "5 seconds"
SMALL_BATCH_INTERVAL = "2 seconds"
SMALL_BATCH_ROWS = 10_000


def small_batches(name: str, checkpoint: str) -> JobSettings:
    """Flush after 2 seconds or 10000 rows of a topic; a folder gives a file at a time."""
    return JobSettings(
        name, checkpoint, SMALL_BATCH_INTERVAL, batch_rows=SMALL_BATCH_ROWS, batch_files=1
    )
