"""The streaming jobs: enrich readings, count lookups, and the trial of both."""

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from pointstream.operators.keyed import looked_up
from pointstream.operators.lookup import described, enriched, lookup_join, total_count
from pointstream.operators.messages import (
    FAIL,
    drop_sentinel,
    mark_messages,
    marked_readings,
    marked_rejects,
    message_rejects,
    parse_messages,
)
from pointstream.schemas import LOOKUP_TTL_SECONDS, SENTINEL_DAY
from pointstream.sinks.tables import BATCH, LABEL, RUN
from pointstream.sources.dimension import DimSnapshot, Loader
from pointstream.streaming.settings import JobSettings

BatchWriter = Callable[[DataFrame, int], None]

# Batches whose counts are added up in one task.
CHANGE_BLOCK = 1000
# Largest dimension that a stream broadcasts. Each micro-batch gathers it at the driver
# anew, so the limit is lower than that of a single join; larger ones are merged.
BATCH_BROADCAST_BYTES = 16 << 20


def start_lookup(
    facts: DataFrame,
    snapshot: DimSnapshot,
    project: Callable[[DataFrame], DataFrame],
    writer: BatchWriter,
    settings: JobSettings,
    fact_key: str = "id",
    dim_key: str = "point_id",
    broadcast_bytes: int = BATCH_BROADCAST_BYTES,
) -> StreamingQuery:
    """Join each micro-batch to the snapshot of its time and write the result.

    The join runs inside ``foreachBatch`` so that a reload of the snapshot is
    seen by the next batch, and so that adaptive execution plans it; results
    already written are not revised.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = settings.dealt(batch)
        with looked_up(snapshot.current(batch.sparkSession), rows, fact_key) as (rows, dim):
            writer(project(lookup_join(rows, dim, fact_key, dim_key, broadcast_bytes)), batch_id)

    return settings.start(facts.writeStream.foreachBatch(handle))


def start_enrich(
    messages: DataFrame,
    snapshot: DimSnapshot,
    writer: BatchWriter,
    settings: JobSettings,
    sentinel: str | None = SENTINEL_DAY,
    on_error: str = FAIL,
    broadcast_bytes: int = BATCH_BROADCAST_BYTES,
    rejects: BatchWriter | None = None,
) -> StreamingQuery:
    """JSON messages to enriched rows: parse, drop sentinel days, look up, write.

    With ``rejects``, malformed messages go to that writer, from the same
    micro-batch that the good ones are in, so none is lost between the two;
    the parsed batch is kept while both are written.
    """
    if rejects is None:
        readings = drop_sentinel(parse_messages(messages, on_error), sentinel)
        return start_lookup(
            readings, snapshot, enriched, writer, settings, broadcast_bytes=broadcast_bytes
        )

    def handle(batch: DataFrame, batch_id: int) -> None:
        marked = mark_messages(batch).persist()
        try:
            rejects(marked_rejects(marked), batch_id)
            readings = settings.dealt(drop_sentinel(marked_readings(marked), sentinel))
            with looked_up(snapshot.current(batch.sparkSession), readings, "id") as (rows, dim):
                joined = lookup_join(rows, dim, broadcast_bytes=broadcast_bytes)
                writer(enriched(joined), batch_id)
        finally:
            marked.unpersist()

    return settings.start(messages.writeStream.foreachBatch(handle))


def start_quarantine(
    messages: DataFrame, writer: BatchWriter, settings: JobSettings
) -> StreamingQuery:
    """Malformed messages alone; ``start_enrich`` sets them aside beside the good ones."""
    return settings.start(message_rejects(messages).writeStream.foreachBatch(writer))


def start_count(
    facts: DataFrame,
    snapshot: DimSnapshot,
    writer: BatchWriter,
    settings: JobSettings,
    fact_key: str = "id",
    dim_key: str = "point_id",
    broadcast_bytes: int = BATCH_BROADCAST_BYTES,
) -> StreamingQuery:
    """Number of looked-up rows of each micro-batch, a row ``total`` under its label.

    The running total is the sum over the labels (:func:`running_total`). A replayed
    batch replaces its count, and a reload of the dimension is seen by the next one.
    """
    return start_lookup(
        facts, snapshot, total_count, writer, settings, fact_key, dim_key, broadcast_bytes
    )


def running_total(counts: DataFrame) -> DataFrame:
    """Total of the counts written so far."""
    return counts.agg(F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total"))


def running_changes(counts: DataFrame, block: int = CHANGE_BLOCK) -> DataFrame:
    """How the running total of each run changed, batch by batch.

    ``counts`` are the rows of ``LabelledWriter.batches``. Columns: the run, the batch,
    its label, and the total ``before`` and ``after`` it. Rows that a replay wrote again
    have replaced the earlier ones, so the changes stay the same. Sums are taken within
    blocks of batches and over the blocks, so that the batches of a long run are added up
    in many tasks; one row per block meets in one.
    """
    each = counts.groupBy(RUN, BATCH, LABEL).agg(F.sum("total").alias("total"))
    each = each.withColumn("block", F.expr(f"{BATCH} div {block}"))
    inside = Window.partitionBy(RUN, "block").orderBy(BATCH)
    earlier = Window.partitionBy(RUN).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = each.groupBy(RUN, "block").agg(F.sum("total").alias("total"))
    offsets = sums.select(RUN, "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    after = F.col("offset") + F.sum("total").over(inside)
    found = each.join(offsets, [RUN, "block"]).withColumn("after", after)
    return found.select(
        RUN, BATCH, LABEL, (F.col("after") - F.col("total")).alias("before"), "after"
    )


def change_rows(changes: DataFrame) -> DataFrame:
    """Changes as rows of a changelog: the old total taken back, the new one put in.

    Column ``kind`` is ``+I`` for a run's first total, then ``-U`` and ``+U``; batches that
    change nothing give no rows, but for the first.
    """
    firsts = changes.groupBy(RUN).agg(F.min(BATCH).alias("first_batch"))
    first = F.col(BATCH) == F.col("first_batch")
    row = lambda kind, total: F.struct(F.lit(kind).alias("kind"), F.col(total).alias("total"))
    rows = F.when(F.col("first"), F.array(row("+I", "after"))).otherwise(
        F.array(row("-U", "before"), row("+U", "after"))
    )
    found = changes.join(firsts, RUN).withColumn("first", first).filter(F.col("first") | (F.col("before") != F.col("after")))
    return found.select(RUN, BATCH, LABEL, F.explode(rows).alias("row")).select(RUN, BATCH, LABEL, "row.*")


def start_trial(
    ids: DataFrame,
    loader: Loader,
    writer: BatchWriter,
    counts: BatchWriter,
    settings: JobSettings,
    ttl: float = LOOKUP_TTL_SECONDS,
) -> StreamingQuery:
    """Write the lookups of a stream of ids, and their number beside them.

    Both outputs come from the same looked-up batch, kept while they are written,
    so the count is always that of the rows.
    """
    snapshot = DimSnapshot(loader, ttl)

    def handle(batch: DataFrame, batch_id: int) -> None:
        dim = snapshot.current(batch.sparkSession)
        rows = described(
            lookup_join(settings.dealt(batch), dim, dim_key="id", broadcast_bytes=BATCH_BROADCAST_BYTES)
        ).persist()
        try:
            writer(rows, batch_id)
            counts(total_count(rows), batch_id)
        finally:
            rows.unpersist()

    return settings.start(ids.writeStream.foreachBatch(handle))
