"""The registered queries: each takes a session and a data folder."""

import dataclasses
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pointstream.functions.binary import (
    hex_bytes,
    hex_text,
    le_float32,
    le_int32,
    strip_header_text,
    unsigned_byte,
)
from pointstream.functions.once import once
from pointstream.functions.times import (
    day_text,
    in_pull_window,
    local_time,
    milli_text,
    pull_day,
    second_text,
)
from pointstream.operators.decode import BUFFER, decode_frames, frame_rejects
from pointstream.operators.ledger import ledger_rejects, load_ledger, pulled_days
from pointstream.operators.lookup import described, enriched, lookup_join, total_count
from pointstream.operators.messages import (
    QUARANTINE,
    drop_sentinel,
    message_rejects,
    non_finite_rejects,
    parse_messages,
    through_json,
    to_messages,
    to_readings,
)
from pointstream.operators.pieces import load_large_ledger
from pointstream.plans import tables as t
from pointstream.schemas import COUNT, ENRICHED, GENERATED, HEADER_BYTES, MESSAGE, RECORD_BYTES
from pointstream.sinks.logged import LoggedAppends
from pointstream.sinks.messages import write_messages
from pointstream.sinks.tables import (
    BATCH,
    LABEL,
    LabelledWriter,
    append_rows,
    bind_by_position,
    write_day,
    write_days,
)
from pointstream.sources.captures import read_captures
from pointstream.sources.dimension import DimSnapshot, read_dimension
from pointstream.sources.generated import generated_ids
from pointstream.sources.ledgers import read_response_pieces, read_responses
from pointstream.sources.messages import bounded_files, read_messages
from pointstream.storage import shared_folder
from pointstream.streaming.jobs import (
    change_rows,
    running_changes,
    running_total,
    start_count,
    start_enrich,
    start_lookup,
    start_trial,
)
from pointstream.streaming.settings import JobSettings, small_batches

Query = Callable[[SparkSession, str], DataFrame]

# Parts that trial inputs are landed in, one to a micro-batch, and the rows of a part's file
# that make it several files.
FILES = 3
FILE_ROWS = 250_000
# Frames that a task decodes whole receive buffers of.
TASK_FRAMES = 20_000
# What a changed dimension has behind its names.
CHANGED = "#2"
LEDGERS = ("entrance", "furnace")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "events")


def _part_files(rows: DataFrame, parts: int = FILES) -> int:
    """Files of each of the parts that rows are landed in: one task writes a file."""
    return max(1, math.ceil(rows.count() / (parts * FILE_ROWS)))


def _even_points(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("point_id") % 2 == 0)


# Lookup join


def lookup_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = drop_sentinel(t.as_readings(_events(spark, sf_dir)), t.TRIAL_SENTINEL)
    rows = enriched(lookup_join(readings, t.point_dim(spark, sf_dir)))
    return bind_by_position(rows, ENRICHED)


def lookup_enrich_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = drop_sentinel(t.as_readings(_events(spark, sf_dir)), None)
    return enriched(lookup_join(readings, t.point_dim(spark, sf_dir)))


def lookup_enrich_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup with the dimension taken as too large to broadcast."""
    readings = t.as_readings(_events(spark, sf_dir))
    return enriched(lookup_join(readings, t.point_dim(spark, sf_dir), broadcast_bytes=0))


def lookup_unmatched_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = t.as_readings(_events(spark, sf_dir))
    return enriched(lookup_join(readings, _even_points(t.point_dim(spark, sf_dir))))


def lookup_multi_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with several rows per key: every order of a reading's customer."""
    dim = t.priority_dim(spark, sf_dir)
    readings = t.as_readings(_events(spark, sf_dir), "event_id")
    return lookup_join(readings, dim).select(
        "f.event_id", "d.point_id", "d.point_index_name", "f.point_value"
    )


def sentinel_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = t.as_readings(_events(spark, sf_dir), "event_id")
    return drop_sentinel(readings, t.TRIAL_SENTINEL).select(
        "event_id",
        "id",
        "point_value",
        "status",
        day_text("real_time").alias("real_day"),
        milli_text("real_time").alias("real_time"),
        milli_text("collect_time").alias("collect_time"),
    )


def count_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = t.as_readings(_events(spark, sf_dir))
    return total_count(lookup_join(readings, _even_points(t.point_dim(spark, sf_dir))))


# Frames


def _dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in tasks of ``TASK_FRAMES``: of a receive buffer come 78 records, padding too.

    The scan has a task per row group, few for so many records.
    """
    events = _events(spark, sf_dir)
    tasks = math.ceil(events.count() / TASK_FRAMES)
    return events.repartition(tasks) if tasks > 1 else events


def _record_text(records: DataFrame) -> DataFrame:
    """Decoded records with their times as text and the value in both widths."""
    # Padding and unset clocks have the time 0, whose text is a constant.
    unset, real_time = local_time(F.lit(0)), F.col("real_time")
    return records.select(
        "frame_id",
        "record_seq",
        second_text("collect_time").alias("collect_time"),
        "id",
        through_json(F.col("point_value")).alias("point_value"),
        F.col("point_value").cast("double").alias("point_value_bits"),
        F.when(real_time == unset, second_text(unset))
        .otherwise(second_text(real_time))
        .alias("real_time"),
        "status",
    )


def frame_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = t.as_frames(_events(spark, sf_dir))
    text = hex_text("payload")
    return frames.select(
        "frame_id",
        F.substring(text, 1, 2 * HEADER_BYTES).alias("header_hex"),
        strip_header_text(text).alias("body_hex"),
        (hex_bytes(text) == F.col("payload")).alias("same_bytes"),
    )


def frame_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of each frame, field by field."""
    frames = t.as_frames(_events(spark, sf_dir))
    records = F.expr(f"int((length(payload) - {HEADER_BYTES}) div {RECORD_BYTES})")
    several = frames.filter(records > 0)
    each = several.select(
        "frame_id", "payload", F.explode(F.sequence(F.lit(0), records - 1)).alias("record_seq")
    )
    start = F.col("record_seq") * RECORD_BYTES + HEADER_BYTES + 1
    record = F.col("payload").substr(start, F.lit(RECORD_BYTES))
    return each.select("frame_id", "record_seq", once(record=record)).select(
        "frame_id",
        "record_seq",
        le_int32("record", 1).alias("id"),
        le_float32("record", 5).cast("double").alias("point_value_bits"),
        le_int32("record", 9).alias("seconds"),
        unsigned_byte("record", 13).alias("status"),
    )


def frame_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_text(decode_frames(t.as_frames(_events(spark, sf_dir))))


def frame_decode_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the receive buffer, those that are padding too."""
    frames = t.as_frames(_dealt_events(spark, sf_dir))
    return _record_text(decode_frames(frames, padding=BUFFER))


def frame_decode_padded_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = decode_frames(t.as_frames(_dealt_events(spark, sf_dir)), padding=BUFFER)
    return _record_text(drop_sentinel(records))


def frame_decode_unsigned_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames whose times lie past 2038, read signed and unsigned."""
    events = _events(spark, sf_dir).withColumn(
        "ts", F.col("ts") + F.expr("interval '14' year + interval '9' month")
    )
    frames = t.as_frames(events).drop("recv_time").withColumn(
        "recv_time", F.lit("2024-01-01 00:00:00+00:00").cast("timestamp")
    )

    def times(reading: str) -> DataFrame:
        records = decode_frames(frames, unsigned_time=reading == "unsigned")
        return records.select(
            "frame_id",
            "record_seq",
            F.lit(reading).alias("reading"),
            second_text("real_time").alias("real_time"),
        )

    return times("signed").unionAll(times("unsigned"))


def frame_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = frame_rejects(t.cut_frames(_events(spark, sf_dir)))
    return rejects.select("frame_id", "reason", hex_text("rest").alias("rest_hex"))


def frame_over_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies past the receive buffer."""
    rejects = frame_rejects(t.as_frames(_events(spark, sf_dir)), padding=BUFFER)
    return rejects.select("frame_id", "reason", hex_text("rest").alias("rest_hex"))


def captures_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datagrams landed as capture files and decoded from there."""
    path = shared_folder(spark, "captures")
    events = _events(spark, sf_dir)
    t.as_frames(events).repartition(FILES * _part_files(events)).write.parquet(path)
    return _record_text(decode_frames(read_captures(spark, path)))


def frame_whole_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is still decoded of frames that were cut short."""
    records = decode_frames(t.cut_frames(_events(spark, sf_dir)))
    return records.select("frame_id", "record_seq", "id", "status")


def non_finite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with NaN or infinite values, which JSON cannot carry."""
    kind = F.col("event_id") % 10
    value = (
        F.when(kind == 0, F.lit(float("nan")))
        .when(kind == 1, F.lit(float("inf")))
        .when(kind == 2, F.lit(float("-inf")))
        .otherwise(F.col("point_value"))
    )
    records = t.as_records(_events(spark, sf_dir), "event_id")
    spoiled = records.withColumn("point_value", value.cast("float"))
    return non_finite_rejects(spoiled).select(
        "event_id", "id", F.col("point_value").cast("string").alias("point_value"), "reason"
    )


# Messages


def message_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(t.as_records(_events(spark, sf_dir), "event_id"), ["event_id"])
    fields = F.json_tuple("value", *MESSAGE.names).alias(*MESSAGE.names)
    return messages.select("event_id", fields)


def _typed_text(readings: DataFrame, *keep: str) -> DataFrame:
    return readings.select(
        *keep,
        "id",
        "point_value",
        "status",
        milli_text("collect_time").alias("collect_time"),
        milli_text("real_time").alias("real_time"),
    )


def message_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_messages(t.as_records(_events(spark, sf_dir), "event_id"), ["event_id"])
    return _typed_text(parse_messages(messages), "event_id")


def _spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = t.as_records(_events(spark, sf_dir), "event_id")
    return t.spoiled_messages(to_messages(records, ["event_id"]))


def message_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that are left once malformed ones are set aside."""
    return _typed_text(parse_messages(_spoiled(spark, sf_dir), QUARANTINE), "event_id")


def message_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = message_rejects(_spoiled(spark, sf_dir))
    return rejects.select("event_id", "reason", "value")


def message_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written out as text lines and read back."""
    path = shared_folder(spark, "messages")
    write_messages(to_messages(t.as_records(_events(spark, sf_dir))), "text", path=path)
    messages = read_messages(spark, "text", stream=False, path=path)
    return _typed_text(parse_messages(messages))


def frames_to_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datagrams to result rows by way of JSON messages."""
    messages = to_messages(decode_frames(t.as_frames(_events(spark, sf_dir))))
    readings = drop_sentinel(parse_messages(messages))
    return enriched(lookup_join(readings, t.point_dim(spark, sf_dir)))


def frames_to_enriched_fused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows without writing and parsing the messages."""
    readings = drop_sentinel(to_readings(decode_frames(t.as_frames(_events(spark, sf_dir)))))
    return enriched(lookup_join(readings, t.point_dim(spark, sf_dir)))


# Generated ids


def datagen_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = generated_ids(_events(spark, sf_dir), "event_id")
    joined = lookup_join(ids, t.described_dim(spark, sf_dir), dim_key="id")
    return bind_by_position(described(joined), GENERATED)


def datagen_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return total_count(datagen_lookup(spark, sf_dir))


# Ledgers


def _content_fields(rows: DataFrame, *keep: str) -> DataFrame:
    """The fields of the element texts, which engines may space differently."""
    return rows.select(
        *keep,
        "cm",
        F.get_json_object("content", "$.no").cast("bigint").alias("no"),
        F.get_json_object("content", "$.part").cast("int").alias("part"),
        F.get_json_object("content", "$.kind").alias("kind"),
        F.get_json_object("content", "$.by.user").cast("bigint").alias("user"),
    )


def ledger_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = t.as_responses(_events(spark, sf_dir))
    return _content_fields(load_ledger(responses, F.col("run_date")))


def ledger_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_rejects(t.as_responses(_events(spark, sf_dir))).select("event_id", "reason")


def ledger_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).filter(in_pull_window("ts", t.TRIAL_RUN_DATE))
    return rows.select(
        F.lit(pull_day(t.TRIAL_RUN_DATE)).alias("cm"),
        "event_id",
        milli_text("ts").alias("event_time"),
    )


def ledger_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of ledger elements that a double would change."""
    rows = load_ledger(t.number_responses(_events(spark, sf_dir)), F.col("run_date"))
    value = F.parse_json("content")
    field = lambda path, kind: F.variant_get(value, path, kind)
    return rows.select(
        "cm",
        field("$.long", "decimal(38,9)").cast("string").alias("long"),
        field("$.whole", "decimal(38,0)").cast("string").alias("whole"),
        field("$.power", "double").alias("power"),
        field("$.text", "string").alias("text"),
        field("$.deep.list[0]", "decimal(4,2)").cast("string").alias("deep_number"),
        field("$.deep.list[1].x", "bigint").alias("deep_x"),
    )


def ledgers_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ledgers landed as response lines, read by name and kept apart."""
    path = shared_folder(spark, "responses")
    responses = t.as_responses(_events(spark, sf_dir))
    for number, ledger in enumerate(LEDGERS):
        own = responses.filter(F.col("event_id") % 2 == number).select("value")
        own.write.text(f"{path}/{ledger}")
    landed = [read_responses(spark, path, ledger, whole_file=False) for ledger in LEDGERS]
    rows = load_ledger(landed[0].unionAll(landed[1]), t.TRIAL_RUN_DATE)
    return _content_fields(rows, "ledger")


def ledger_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then all loaded again, then one day once more.

    Responses are landed by run date, so that loading one day reads that day.
    """
    landed, path = shared_folder(spark, "responses"), shared_folder(spark, "ledger")
    responses = t.as_responses(_events(spark, sf_dir)).select("run_date", "value")
    responses.hint("rebalance", F.col("run_date")).write.partitionBy("run_date").parquet(landed)
    found = spark.read.schema("value string, run_date date").parquet(landed)
    rows = load_ledger(found, F.col("run_date"))
    write_days(rows, path)
    write_days(rows, path)
    one = found.filter(F.col("run_date") == F.lit(t.TRIAL_RUN_DATE).cast("date"))
    write_day(load_ledger(one, F.col("run_date")), path, pull_day(t.TRIAL_RUN_DATE))
    return _content_fields(spark.read.schema("content string, cm string").parquet(path))


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A glob lets the file stream start from one Parquet file or a folder of them.
    source = f"{sf_dir}/event[s].parquet"
    return spark.readStream.schema(_events(spark, sf_dir).schema).parquet(source)


def _settings(spark: SparkSession, name: str, **how) -> JobSettings:
    """Settings of a trial: what is there, a file at a time."""
    checkpoint = shared_folder(spark, f"checkpoint-{name}")
    return JobSettings(name, checkpoint, available_now=True, **{"batch_files": 1, **how})


def _land_messages(
    spark: SparkSession, sf_dir: str, path: str, settings: JobSettings, where: str = "TRUE"
) -> JobSettings:
    """Messages of the events as text files; settings to read them in ``FILES`` micro-batches."""
    events = _events(spark, sf_dir).filter(where)
    messages = to_messages(t.as_records(events))
    files = _part_files(events)
    messages.repartition(FILES * files).write.mode("append").text(path)
    return dataclasses.replace(settings, batch_files=files)


def _landed_stream(spark: SparkSession, path: str, settings: JobSettings) -> DataFrame:
    return read_messages(spark, "text", settings=settings, path=path)


def _enrich_landed(
    spark: SparkSession, path: str, snapshot: DimSnapshot, writer, settings: JobSettings, **how
) -> None:
    stream = _landed_stream(spark, path, settings)
    query = start_enrich(stream, snapshot, writer, settings, sentinel=t.TRIAL_SENTINEL, **how)
    query.awaitTermination()


def _stream_enrich(
    spark: SparkSession, sf_dir: str, settings: JobSettings, ttl: float = 24 * 3600, **how
) -> DataFrame:
    path = shared_folder(spark, "messages")
    settings = _land_messages(spark, sf_dir, path, settings)
    writer = LabelledWriter(shared_folder(spark, settings.name), settings.name, ENRICHED)
    snapshot = DimSnapshot(lambda session: t.point_dim(session, sf_dir), ttl)
    _enrich_landed(spark, path, snapshot, writer, settings, **how)
    return writer.read(spark).select(*ENRICHED.names)


def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of several files, a micro-batch for each."""
    return _stream_enrich(spark, sf_dir, _settings(spark, "stream_enrich"))


def stream_enrich_uncached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stream_enrich(spark, sf_dir, _settings(spark, "stream_enrich_uncached"), ttl=0)


def stream_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flush profile of small batches, and a number of tasks of its own."""
    small = small_batches("stream_small_batches", shared_folder(spark, "checkpoint-small"))
    return _stream_enrich(
        spark, sf_dir, dataclasses.replace(small, available_now=True, parallelism=3)
    )


def _stream_changed_dimension(spark: SparkSession, sf_dir: str, name: str, ttl: float) -> DataFrame:
    """Half of the messages, then a changed dimension, then the other half."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, name)
    writer = LabelledWriter(shared_folder(spark, name), name, ENRICHED)
    suffix = [""]

    def loader(session: SparkSession) -> DataFrame:
        points = t.point_dim(session, sf_dir)
        return points.withColumn("point_name", F.concat("point_name", F.lit(suffix[0])))

    snapshot = DimSnapshot(loader, ttl)
    for half, suffix[0] in enumerate(("", CHANGED)):
        landed = _land_messages(spark, sf_dir, path, settings, f"event_id % 2 = {half}")
        _enrich_landed(spark, path, snapshot, writer, landed)
    return writer.read(spark).select(*ENRICHED.names)


def stream_dimension_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a cache, each micro-batch sees the dimension of its time."""
    return _stream_changed_dimension(spark, sf_dir, "stream_dimension_reloaded", ttl=0)


def stream_dimension_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache, the dimension stays until its time is over."""
    return _stream_changed_dimension(spark, sf_dir, "stream_dimension_kept", ttl=24 * 3600)


def dimension_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed dimension table read in declared columns and types."""
    path = shared_folder(spark, "points")
    wide = t.point_dim(spark, sf_dir).withColumn("id", F.col("id").cast("bigint"))
    wide.withColumn("more", F.lit(1)).write.parquet(path)
    return read_dimension(spark, "parquet", path=path)


def stream_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of datagrams decoded, enriched and written, without messages."""
    frames = t.as_frames(_event_stream(spark, sf_dir))
    writer = LabelledWriter(shared_folder(spark, "frames"), "frames", ENRICHED)
    query = start_lookup(
        drop_sentinel(to_readings(decode_frames(frames))),
        DimSnapshot(lambda session: t.point_dim(session, sf_dir)),
        enriched,
        writer,
        _settings(spark, "stream_frames"),
    )
    query.awaitTermination()
    return writer.read(spark).select(*ENRICHED.names)


def _stream_quarantine(spark: SparkSession, sf_dir: str) -> tuple[LabelledWriter, LabelledWriter]:
    """Good and malformed messages of one stream, split in the same micro-batches."""
    path, settings = shared_folder(spark, "spoiled"), _settings(spark, "stream_quarantine")
    spoiled = _spoiled(spark, sf_dir)
    files = _part_files(_events(spark, sf_dir))
    spoiled.repartition(FILES * files).write.parquet(path)
    reader = spark.readStream.schema(spoiled.schema).option("maxFilesPerTrigger", files)
    stream = reader.parquet(path)
    rejects = LabelledWriter(
        shared_folder(spark, "quarantine"), "quarantine", message_rejects(spoiled).schema
    )
    writer = LabelledWriter(shared_folder(spark, "good"), "good", ENRICHED)
    snapshot = DimSnapshot(lambda session: t.point_dim(session, sf_dir))
    query = start_enrich(stream, snapshot, writer, settings, None, rejects=rejects)
    query.awaitTermination()
    return writer, rejects


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed messages of a stream, set aside in a table of their own."""
    _, rejects = _stream_quarantine(spark, sf_dir)
    return rejects.read(spark).select("event_id", "reason", "value")


def stream_quarantine_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the other messages of that stream."""
    writer, _ = _stream_quarantine(spark, sf_dir)
    return writer.read(spark).select(*ENRICHED.names)


def stream_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A running count over several micro-batches, with a dimension too large to broadcast."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, "stream_count")
    settings = _land_messages(spark, sf_dir, path, settings)
    counts = LabelledWriter(shared_folder(spark, "counts"), "count", COUNT)
    start_count(
        parse_messages(_landed_stream(spark, path, settings)),
        DimSnapshot(lambda session: _even_points(t.point_dim(session, sf_dir))),
        counts,
        settings,
        broadcast_bytes=0,
    ).awaitTermination()
    return running_total(counts.read(spark))


def trial_two_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked-up ids and their count from one stream: both numbers of rows."""
    path, settings = shared_folder(spark, "events"), _settings(spark, "trial")
    events = _events(spark, sf_dir)
    files = _part_files(events)
    events.repartition(FILES * files).write.parquet(path)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files)
    rows = LabelledWriter(shared_folder(spark, "trial"), "trial", GENERATED)
    counts = LabelledWriter(shared_folder(spark, "trial-counts"), "count", COUNT)
    start_trial(
        generated_ids(reader.parquet(path), "event_id"),
        lambda session: t.described_dim(session, sf_dir),
        rows,
        counts,
        settings,
    ).awaitTermination()
    written = rows.read(spark).agg(F.count("*").alias("total"))
    outputs = {"rows": written, "counted": running_total(counts.read(spark))}
    one, two = (frame.select(F.lit(name).alias("output"), "total") for name, frame in outputs.items())
    return one.unionAll(two)


def stream_datagen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated ids of a stream looked up and written as labelled batches."""
    writer = LabelledWriter(shared_folder(spark, "datagen"), "datagen", GENERATED)
    query = start_lookup(
        generated_ids(_event_stream(spark, sf_dir), "event_id"),
        DimSnapshot(lambda session: t.described_dim(session, sf_dir)),
        described,
        writer,
        _settings(spark, "stream_datagen"),
        dim_key="id",
    )
    query.awaitTermination()
    return writer.read(spark).select(*GENERATED.names)


def sink_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One batch written twice under its label."""
    writer = LabelledWriter(shared_folder(spark, "replay"), "replay", ENRICHED)
    rows = lookup_enrich(spark, sf_dir)
    writer(rows, 0)
    writer(rows, 0)
    return writer.read(spark).select(*ENRICHED.names)


def sink_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs under one label prefix, the second from a new checkpoint: both stay."""
    path = shared_folder(spark, "messages")
    files = _land_messages(spark, sf_dir, path, _settings(spark, "files")).batch_files
    writer = LabelledWriter(shared_folder(spark, "runs"), "job", ENRICHED, part_batches=2)
    snapshot = DimSnapshot(lambda session: t.point_dim(session, sf_dir))
    for _ in range(2):
        run = _settings(spark, "sink_new_checkpoint", batch_files=files)
        _enrich_landed(spark, path, snapshot, writer, run)
    return writer.read(spark).select(*ENRICHED.names)


def stream_dimension_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension kept by key: each micro-batch reads the buckets of its own keys."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, "stream_bucketed")
    settings = _land_messages(spark, sf_dir, path, settings)
    writer = LabelledWriter(shared_folder(spark, "bucketed"), "bucketed", ENRICHED)
    snapshot = DimSnapshot(
        lambda session: t.point_dim(session, sf_dir), key="point_id", keyed_beyond=0, buckets=64
    )
    _enrich_landed(spark, path, snapshot, writer, settings)
    return writer.read(spark).select(*ENRICHED.names)


def stream_dimension_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension store that fails twice at first, and for good once a copy is there."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, "stream_retried")
    settings = _land_messages(spark, sf_dir, path, settings)
    writer = LabelledWriter(shared_folder(spark, "retried"), "retried", ENRICHED)
    calls = []

    def loader(session: SparkSession) -> DataFrame:
        calls.append(len(calls))
        if calls[-1] != 2:
            raise OSError("the dimension store is down")
        return t.point_dim(session, sf_dir)

    snapshot = DimSnapshot(loader, ttl=0, pause=0.01, max_age=3600)
    _enrich_landed(spark, path, snapshot, writer, settings)
    return writer.read(spark).select(*ENRICHED.names)


def sink_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a run compacted part by part, then a batch of a compacted part again."""
    writer = LabelledWriter(
        shared_folder(spark, "compacted"), "job", ENRICHED, run="trial", part_batches=2
    )
    rows = lookup_enrich(spark, sf_dir)
    parts = FILES + 2
    for batch in range(parts):
        writer(rows.filter(F.pmod(F.col("point_id"), F.lit(parts)) == batch), batch)
    for part in range(parts // 2):
        writer.compact(spark, "trial", part)
    writer.remove_replaced(spark, "trial")
    writer(rows.filter(F.pmod(F.col("point_id"), F.lit(parts)) == 0), 0)
    return writer.read(spark).select(*ENRICHED.names)


def sink_label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream into a target that takes plain appends, every batch handed over twice."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, "sink_label_log")
    settings = _land_messages(spark, sf_dir, path, settings)
    target = shared_folder(spark, "target")
    once_each = LoggedAppends(
        shared_folder(spark, "label-log"), "job", lambda rows: append_rows(rows, "parquet", path=target)
    )

    def twice(batch: DataFrame, batch_id: int) -> None:
        once_each(batch, batch_id)
        once_each(batch, batch_id)

    snapshot = DimSnapshot(lambda session: t.point_dim(session, sf_dir))
    _enrich_landed(spark, path, snapshot, twice, settings)
    return spark.read.schema(ENRICHED).parquet(target)


def _stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of a running count over messages that come file by file: by event_id % FILES."""
    path, settings = shared_folder(spark, "messages"), _settings(spark, "stream_changes")
    events = _events(spark, sf_dir)
    parts = [events.filter(F.col("event_id") % FILES == number) for number in range(FILES)]
    files = max(_part_files(part, 1) for part in parts)
    settings = dataclasses.replace(settings, batch_files=files)
    for part in parts:
        own = to_messages(t.as_records(part))
        own.repartition(files).write.mode("append").text(path)
    counts = LabelledWriter(shared_folder(spark, "changes"), "count", COUNT, part_batches=2)
    start_count(
        parse_messages(_landed_stream(spark, path, settings)),
        DimSnapshot(lambda session: _even_points(t.point_dim(session, sf_dir))),
        counts,
        settings,
    ).awaitTermination()
    return running_changes(counts.batches(spark), block=2)


def stream_count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The total before and after each micro-batch."""
    changes = _stream_counts(spark, sf_dir)
    return changes.select(F.col(BATCH).alias("batch"), "before", "after")


def stream_count_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as rows of a changelog: totals taken back and put in."""
    rows = change_rows(_stream_counts(spark, sf_dir))
    return rows.select(F.col(BATCH).alias("batch"), "kind", "total")


def stream_bounded_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of many messages, cut so that no micro-batch has more than a tenth of them.

    Rows with the largest batch's share of the bound, which must not be above 1.
    """
    path, landing = shared_folder(spark, "large"), shared_folder(spark, "bounded")
    events = _events(spark, sf_dir)
    to_messages(t.as_records(events)).coalesce(1).write.text(path)
    bound = events.count() // 10 + 1
    cutting = dataclasses.replace(_settings(spark, "bounded_cut"), batch_rows=bound)
    bounded_files(spark, path, landing, cutting).awaitTermination()
    settings = _settings(spark, "stream_bounded")
    writer = LabelledWriter(shared_folder(spark, "bounded-rows"), "bounded", ENRICHED)
    snapshot = DimSnapshot(lambda session: t.point_dim(session, sf_dir))
    start_enrich(
        _landed_stream(spark, landing, settings), snapshot, writer, settings, sentinel=None
    ).awaitTermination()
    rows = writer.read(spark)
    within = rows.groupBy(LABEL).agg((F.count("*") <= bound).alias("within_bound"))
    return rows.join(within, LABEL).select(*ENRICHED.names, "within_bound")


def ledger_emptied_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days loaded, then every other day pulled again, without a single element."""
    path = shared_folder(spark, "ledger")
    responses = t.as_responses(_events(spark, sf_dir))
    day = F.col("run_date")
    write_days(load_ledger(responses, day), path, pulled=pulled_days(responses, day))
    again = responses.filter(F.dayofmonth("run_date") % 2 == 0)
    empty = again.withColumn("value", F.lit('{"code":200,"result":[]}'))
    write_days(load_ledger(empty, day), path, pulled=pulled_days(empty, day))
    return _content_fields(spark.read.schema("content string, cm string").parquet(path))


def ledger_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One response per day with all its elements, parsed in blocks of the files."""
    path = shared_folder(spark, "large-responses")
    lines = t.day_responses(_events(spark, sf_dir)).repartition("run_date")
    ordered = lines.sortWithinPartitions("run_date", "place").select("run_date", "line")
    ordered.write.partitionBy("run_date").text(path)
    rows = load_large_ledger(read_response_pieces(spark, path), F.col("run_date"))
    return _content_fields(rows)


QUERIES: dict[str, Query] = {
    "lookup_enrich": lookup_enrich,
    "lookup_enrich_unfiltered": lookup_enrich_unfiltered,
    "lookup_enrich_shuffled": lookup_enrich_shuffled,
    "lookup_unmatched_dropped": lookup_unmatched_dropped,
    "lookup_multi_match": lookup_multi_match,
    "sentinel_filter": sentinel_filter,
    "count_enriched": count_enriched,
    "frame_hex": frame_hex,
    "frame_fields": frame_fields,
    "frame_decode": frame_decode,
    "frame_decode_padded": frame_decode_padded,
    "frame_decode_padded_filtered": frame_decode_padded_filtered,
    "frame_decode_unsigned_time": frame_decode_unsigned_time,
    "frame_rejects": frame_reject_rows,
    "frame_over_length": frame_over_length,
    "captures_decode": captures_decode,
    "frame_whole_records": frame_whole_records,
    "non_finite_rejects": non_finite_rows,
    "message_fields": message_fields,
    "message_roundtrip": message_roundtrip,
    "message_quarantined": message_quarantined,
    "message_rejects": message_reject_rows,
    "message_sink": message_sink,
    "frames_to_enriched": frames_to_enriched,
    "frames_to_enriched_fused": frames_to_enriched_fused,
    "datagen_lookup": datagen_lookup,
    "datagen_count": datagen_count,
    "ledger_daily": ledger_daily,
    "ledger_rejects": ledger_reject_rows,
    "ledger_window": ledger_window,
    "ledger_numbers": ledger_numbers,
    "ledgers_two": ledgers_two,
    "ledger_replay": ledger_replay,
    "stream_enrich": stream_enrich,
    "stream_enrich_uncached": stream_enrich_uncached,
    "stream_small_batches": stream_small_batches,
    "stream_dimension_reloaded": stream_dimension_reloaded,
    "stream_dimension_kept": stream_dimension_kept,
    "dimension_read": dimension_read,
    "stream_frames": stream_frames,
    "stream_quarantine": stream_quarantine,
    "stream_quarantine_good": stream_quarantine_good,
    "stream_count": stream_count,
    "trial_two_outputs": trial_two_outputs,
    "stream_datagen": stream_datagen,
    "sink_replay": sink_replay,
    "sink_new_checkpoint": sink_new_checkpoint,
    "stream_dimension_bucketed": stream_dimension_bucketed,
    "stream_dimension_retried": stream_dimension_retried,
    "sink_compacted": sink_compacted,
    "sink_label_log": sink_label_log,
    "stream_count_changes": stream_count_changes,
    "stream_count_changelog": stream_count_changelog,
    "stream_bounded_rows": stream_bounded_rows,
    "ledger_emptied_day": ledger_emptied_day,
    "ledger_large": ledger_large,
}
