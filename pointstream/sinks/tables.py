"""Table writers that a repeated batch or a repeated day does not duplicate."""

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from pointstream.storage import names, put_new, read_text, remove

RUN, PART, LABEL, BATCH = "load_run", "load_part", "load_label", "load_batch"
# Folder of a run's compacted parts, hidden from readers of its labels, and its manifests.
COMPACTED, MANIFEST = "_compacted", "manifest-"

# Batches whose labels share a folder.
PART_BATCHES = 1000
# The run of batches that do not come from a streaming query.
NO_QUERY = "batch"


def bind_by_position(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows under the target's column names, matched by position.

    The number of columns and each type must agree with the target.
    """
    if len(rows.columns) != len(schema.fields):
        raise ValueError(f"{len(rows.columns)} columns for a table of {len(schema.fields)}")
    for have, want in zip(rows.schema.fields, schema.fields):
        if have.dataType != want.dataType:
            raise TypeError(
                f"{have.name} is {have.dataType.simpleString()},"
                f" but column {want.name} is {want.dataType.simpleString()}"
            )
    return rows.toDF(*schema.names)


def query_id(spark: SparkSession) -> str:
    """Identity of the checkpoint of the streaming query that runs here."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or NO_QUERY


class LabelledWriter:
    """Appends micro-batches under the label ``{prefix}_{run}_{batch id}``.

    A label is a partition folder that its batch replaces as a whole, so a
    replay adds no rows, and a replay that has become empty leaves none. The run
    is the identity that a query keeps with its checkpoint: a query that starts
    from a new checkpoint counts its batches from 0 again under other labels, and
    the rows of earlier runs stay. Labels lie below their run and below a folder
    for every ``part_batches`` batches. ``files`` is the number of files per batch;
    the rows are dealt out anew for it, so that scan, parse and join keep their tasks.

    A finished part may be compacted. What is live then is what the run's manifest
    names: a small file, written anew for each compaction under the next number, and
    readers go by the highest number. So a part is read either from its labels or from
    its compacted copy, and a compaction that is broken off at any point loses and
    doubles nothing.
    """

    def __init__(
        self,
        path: str,
        prefix: str,
        schema: StructType,
        format: str = "parquet",
        files: int | None = None,
        run: str | None = None,
        part_batches: int = PART_BATCHES,
    ):
        self.path = path
        self.prefix = prefix
        self.schema = schema
        self.format = format
        self.files = files
        self.run = run
        self.part_batches = part_batches

    def _run(self, run: str) -> str:
        return f"{self.path}/{RUN}={run}"

    def _part(self, run: str, part: int) -> str:
        return f"{self._run(run)}/{PART}={part}"

    def label(self, run: str, batch_id: int) -> str:
        return f"{self.prefix}_{run}_{batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = bind_by_position(batch, self.schema)
        if self.files is not None:
            rows = rows.repartition(self.files)
        run = self.run or query_id(batch.sparkSession)
        part = batch_id // self.part_batches
        # Only finished parts are compacted: this batch has been written before.
        if part in self._compacted(batch.sparkSession, run)[1]:
            return
        folder = f"{self._part(run, part)}/{LABEL}={self.label(run, batch_id)}"
        rows.write.format(self.format).mode("overwrite").save(folder)

    def _labelled(self, spark: SparkSession, path: str, *names: str) -> DataFrame:
        below = {RUN: StringType(), PART: IntegerType(), LABEL: StringType()}
        fields = [StructField(name, below[name]) for name in names]
        schema = StructType([*self.schema.fields, *fields])
        try:
            return spark.read.format(self.format).schema(schema).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _compacted(self, spark: SparkSession, run: str) -> tuple[int, dict[int, str]]:
        """Number of the run's manifest (0 for none), and the folder of each compacted part."""
        folder = f"{self._run(run)}/{COMPACTED}"
        numbers = [int(n.removeprefix(MANIFEST)) for n in names(spark, folder) if n.startswith(MANIFEST)]
        for number in sorted(numbers, reverse=True):
            # One that is cut short was never in force.
            text = read_text(spark, f"{folder}/{MANIFEST}{number}")
            if text.endswith("}"):
                return max(numbers), {int(part): name for part, name in json.loads(text).items()}
        return max(numbers, default=0), {}

    def _live(self, spark: SparkSession) -> DataFrame:
        """All rows with run and label, each from the folder that is in force."""
        runs = [n.removeprefix(f"{RUN}=") for n in names(spark, self.path) if n.startswith(f"{RUN}=")]
        rows, copies = self._labelled(spark, self.path, RUN, PART, LABEL), []
        for run in runs:
            _, parts = self._compacted(spark, run)
            if parts:
                rows = rows.filter(~((F.col(RUN) == run) & F.col(PART).isin(list(parts))))
                copies += [f"{self._run(run)}/{COMPACTED}/{name}" for name in parts.values()]
        rows = rows.drop(PART)
        if copies:
            reader = spark.read.format(self.format).option("recursiveFileLookup", True)
            rows = rows.unionByName(reader.schema(rows.schema).load(copies))
        return rows

    def read(self, spark: SparkSession) -> DataFrame:
        """The table written so far, with its label column last; empty before the first batch."""
        return self._live(spark).select(*self.schema.names, LABEL)

    def batches(self, spark: SparkSession) -> DataFrame:
        """The same with the run and the batch id (``load_run``, ``load_batch``) of each row."""
        number = F.substring_index(LABEL, "_", -1).cast("bigint")
        return self._live(spark).select(*self.schema.names, LABEL, RUN, number.alias(BATCH))

    def compact(self, spark: SparkSession, run: str, part: int) -> None:
        """Put the rows of a part, with their labels, into few files.

        For parts that the run has gone beyond: only the last batch of a query can come
        again. The copy is written beside the part and takes its place when the next
        manifest names it, in one step. The part's own files stay until
        :meth:`remove_replaced`, for readers that began before.
        """
        number, parts = self._compacted(spark, run)
        there = [n.removeprefix(f"{PART}=") for n in names(spark, self._run(run)) if n.startswith(f"{PART}=")]
        if part >= max([*map(int, there), *parts], default=-1):
            raise ValueError(f"part {part} of run {run} is not finished")
        if part in parts:
            return
        name = f"part-{part}-{uuid.uuid4().hex}"
        rows = self._labelled(spark, self._part(run, part), LABEL).withColumn(RUN, F.lit(run))
        folder = f"{self._run(run)}/{COMPACTED}"
        rows.hint("rebalance").write.format(self.format).save(f"{folder}/{name}")
        put_new(spark, f"{folder}/{MANIFEST}{number + 1}", json.dumps({**parts, part: name}))

    def remove_replaced(self, spark: SparkSession, run: str) -> None:
        """Remove what no manifest names any more: for when its readers are done.

        Files of compacted parts, copies of compactions that were broken off, and earlier
        manifests. No compaction of the run may be under way.
        """
        number, parts = self._compacted(spark, run)
        for part in parts:
            remove(spark, self._part(run, part))
        folder = f"{self._run(run)}/{COMPACTED}"
        for name in names(spark, folder):
            if name not in parts.values() and name != f"{MANIFEST}{number}":
                if not name.startswith(MANIFEST) or self._whole(spark, f"{folder}/{MANIFEST}{number}"):
                    remove(spark, f"{folder}/{name}")

    def _whole(self, spark: SparkSession, manifest: str) -> bool:
        return read_text(spark, manifest).endswith("}")


def append_batches(format: str, **options: str):
    """Micro-batch writer that appends to an external table (for example JDBC).

    Delivery is at least once: only the target can reject a repeated batch.
    ``LoggedAppends`` keeps a log beside the target that does.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(format).options(**options).mode("append").save()

    return write


def write_day(rows: DataFrame, path: str, day: str, format: str = "parquet") -> None:
    """Replace one day of a ledger table; a day without rows becomes empty."""
    content = rows.filter(F.col("cm") == day).drop("cm")
    content.write.format(format).mode("overwrite").save(f"{path}/cm={day}")


def write_days(
    rows: DataFrame, path: str, format: str = "parquet", pulled: DataFrame | None = None
) -> None:
    """Replace every day that occurs in the rows, and every day that was pulled.

    ``pulled`` has the days of the pulls as ``cm`` (:func:`pulled_days`): one without rows
    becomes empty. The rebalance gathers a day's rows into few files and lets adaptive
    execution split a day that is far larger than the others.
    """
    (
        rows.hint("rebalance", F.col("cm"))
        .write.format(format)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("cm")
        .save(path)
    )
    if pulled is not None:
        # One value per day of the calendar: as many as the pulls have, whatever they hold.
        empty = pulled.select("cm").distinct().join(rows.select("cm").distinct(), "cm", "left_anti")
        for day in empty.collect():
            remove(rows.sparkSession, f"{path}/cm={day['cm']}")


def append_rows(rows: DataFrame, format: str, **options: str) -> None:
    """Append rows to an external table (for example JDBC)."""
    rows.write.format(format).options(**options).mode("append").save()
