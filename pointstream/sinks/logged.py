"""Appends to targets that cannot tell a repeated batch: a log of labels beside them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointstream.sinks.tables import query_id
from pointstream.storage import exists, names, put_new, remove

DONE, BEGUN, STAGED = "done-", "begun-", "staged-"
APPEND, FAIL = "append", "fail"


class InDoubt(RuntimeError):
    """An append was broken off, and nobody can tell whether the target has it."""


class LoggedAppends:
    """Micro-batch writer that appends each batch once to any target that takes appends.

    The log lies in the folder ``log``, by run: the identity that a query keeps with its
    checkpoint. A batch goes through four steps:

    1. its rows are staged in the log's folder, so that what is appended is computed once,
       whatever a replay would compute (a dimension may have changed);
    2. ``begun`` is noted;
    3. the staged rows are appended by ``append``;
    4. ``done`` is noted, and what earlier batches left is removed.

    Batch ids of a run only grow, so a batch up to the last one done is a replay and adds
    nothing; the log holds one number per run, however long it runs. What is left is the
    window between the end of 3 and the end of 4: a batch found begun but not done may be
    in the target. ``landed(spark, label)`` decides that where the target can be asked
    (:func:`label_in_target`, with ``label_column``); without it, ``in_doubt`` says whether
    to append again (at least once, the default) or to raise :class:`InDoubt`.
    """

    def __init__(
        self,
        log: str,
        prefix: str,
        append: Callable[[DataFrame], None],
        run: str | None = None,
        label_column: str | None = None,
        landed: Callable[[SparkSession, str], bool] | None = None,
        in_doubt: str = APPEND,
    ):
        if in_doubt not in (APPEND, FAIL):
            raise ValueError(f"in_doubt is {in_doubt!r}")
        self.log = log
        self.prefix = prefix
        self.append = append
        self.run = run
        self.label_column = label_column
        self.landed = landed
        self.in_doubt = in_doubt

    def _folder(self, run: str) -> str:
        return f"{self.log}/{self.prefix}_{run}"

    def last_done(self, spark: SparkSession, run: str) -> int | None:
        """Id of the last batch of a run that was appended."""
        found = [n.removeprefix(DONE) for n in names(spark, self._folder(run)) if n.startswith(DONE)]
        return max(map(int, found), default=None)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = self.run or query_id(spark)
        folder, label = self._folder(run), f"{self.prefix}_{run}_{batch_id}"
        last = self.last_done(spark, run)
        if last is not None and batch_id <= last:
            return
        staged, begun = f"{folder}/{STAGED}{batch_id}", f"{folder}/{BEGUN}{batch_id}"
        doubtful = exists(spark, begun)
        if not exists(spark, f"{staged}/_SUCCESS"):
            rows = batch
            if self.label_column is not None:
                rows = rows.withColumn(self.label_column, F.lit(label))
            rows.write.mode("overwrite").parquet(staged)
        if doubtful and self.landed is None and self.in_doubt == FAIL:
            raise InDoubt(f"{label} was begun and not noted as done")
        if not (doubtful and self.landed is not None and self.landed(spark, label)):
            if not doubtful:
                put_new(spark, begun, label)
            self.append(spark.read.parquet(staged))
        put_new(spark, f"{folder}/{DONE}{batch_id}", label)
        self._tidy(spark, run, batch_id)

    def _tidy(self, spark: SparkSession, run: str, batch_id: int) -> None:
        """Remove what the run's log holds beside the last batch done."""
        folder = self._folder(run)
        for name in names(spark, folder):
            number = int(name.rpartition("-")[2])
            if number < batch_id or (number == batch_id and not name.startswith(DONE)):
                remove(spark, f"{folder}/{name}")


def label_in_target(format: str, label_column: str, **options: str) -> Callable[[SparkSession, str], bool]:
    """Asks a target that can be read whether it has rows of a label.

    For targets that take an append whole or not at all; an empty batch has no rows to
    find and may be appended again.
    """

    def landed(spark: SparkSession, label: str) -> bool:
        rows = spark.read.format(format).options(**options).load()
        return not rows.filter(F.col(f"`{label_column}`") == label).isEmpty()

    return landed
