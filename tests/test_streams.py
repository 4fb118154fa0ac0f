import hashlib
import time

import pytest
from pyspark.sql import functions as F

from pointstream.operators.lookup import Dimension, described, enriched, lookup_join
from pointstream.operators.messages import drop_sentinel, parse_messages, to_messages
from pointstream.plans import tables as t
from pointstream.schemas import COUNT, ENRICHED, GENERATED
from pointstream.sinks.messages import print_rows, stream_messages
from pointstream.sinks.tables import LABEL, NO_QUERY, LabelledWriter
from pointstream.sources.captures import land_datagrams, read_captures
from pointstream.sources.dimension import DimSnapshot
from pointstream.sources.generated import generate_batch, generate_stream, generated_id
from pointstream.sources.messages import batch_limit, bounded_files, read_messages
from pointstream.streaming import jobs
from pointstream.streaming.jobs import (
    change_rows,
    running_changes,
    running_total,
    start_count,
    start_enrich,
    start_lookup,
    start_quarantine,
    start_trial,
)
from pointstream.streaming.settings import JobSettings, small_batches
from conftest import SF_DIR


@pytest.fixture
def landed(spark, tmp_path):
    """Messages of the events as text files, four of them."""
    path = str(tmp_path / "messages")
    events = t.table(spark, SF_DIR, "events")
    to_messages(t.as_records(events)).repartition(4).write.text(path)
    return path


def settings(tmp_path, name, **how):
    return JobSettings(name, str(tmp_path / f"ck-{name}"), available_now=True, **how)


ONE_FILE = JobSettings("one", "unused", batch_files=1)


def stream(spark, path, settings=ONE_FILE):
    return read_messages(spark, "text", settings=settings, path=path)


def points(spark):
    return DimSnapshot(lambda session: t.point_dim(session, SF_DIR))


def as_set(rows):
    return sorted(tuple(r) for r in rows.select(*ENRICHED.names).collect())


def batch_rows(spark, path):
    readings = drop_sentinel(parse_messages(spark.read.text(path)), t.TRIAL_SENTINEL)
    return as_set(enriched(lookup_join(readings, t.point_dim(spark, SF_DIR))))


def test_stream_equals_batch_over_several_micro_batches(spark, landed, tmp_path):
    writer = LabelledWriter(str(tmp_path / "out"), "enrich", ENRICHED)
    start_enrich(
        stream(spark, landed), points(spark), writer, settings(tmp_path, "enrich"), t.TRIAL_SENTINEL
    ).awaitTermination()
    rows = writer.read(spark)
    assert as_set(rows) == batch_rows(spark, landed)
    labels = {r[0] for r in rows.select(LABEL).distinct().collect()}
    runs = {label.split("_")[1] for label in labels}
    assert len(runs) == 1 and runs != {NO_QUERY}
    assert {label.split("_")[2] for label in labels} == {"0", "1", "2", "3"}


def test_new_checkpoint_keeps_earlier_rows(spark, landed, tmp_path):
    writer = LabelledWriter(str(tmp_path / "out"), "job", ENRICHED)
    for n in range(2):
        start_enrich(
            stream(spark, landed), points(spark), writer, settings(tmp_path, f"run{n}"),
            t.TRIAL_SENTINEL,
        ).awaitTermination()
    assert as_set(writer.read(spark)) == sorted(2 * batch_rows(spark, landed))


@pytest.mark.parametrize("files, batches", [(1, 4), (2, 2), (None, 1)])
def test_settings_bound_the_micro_batches(spark, landed, tmp_path, files, batches):
    job = settings(tmp_path, f"bound{files}", batch_files=files, parallelism=3)
    seen = []
    snapshot = points(spark)

    def writer(batch, batch_id):
        seen.append(batch.rdd.getNumPartitions())

    start_enrich(stream(spark, landed, job), snapshot, writer, job).awaitTermination()
    assert seen == [3] * batches


def test_restart_goes_on_where_it_stopped(spark, landed, tmp_path):
    writer = LabelledWriter(str(tmp_path / "out"), "enrich", ENRICHED)

    def run():
        start_enrich(
            stream(spark, landed), points(spark), writer, settings(tmp_path, "again"),
            t.TRIAL_SENTINEL,
        ).awaitTermination()

    run()
    before = as_set(writer.read(spark))
    run()
    assert as_set(writer.read(spark)) == before
    text = '{"id":3,"point_value":1.5,"real_time":"2024-02-01 00:00:00","status":1}'
    more = spark.createDataFrame([(text,)], "value string")
    more.write.mode("append").text(landed)
    run()
    assert len(as_set(writer.read(spark))) == len(before) + 1


def test_batch_that_failed_is_repeated_without_doubling(spark, landed, tmp_path):
    inner = LabelledWriter(str(tmp_path / "out"), "enrich", ENRICHED)
    failures = []

    def fails_after_writing(batch, batch_id):
        inner(batch, batch_id)
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after the write")

    def run():
        start_enrich(
            stream(spark, landed), points(spark), fails_after_writing,
            settings(tmp_path, "fails"), t.TRIAL_SENTINEL,
        ).awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    assert failures == [1]
    assert as_set(inner.read(spark)) == batch_rows(spark, landed)


@pytest.mark.parametrize("ttl, later", [(0, "new"), (3600, "old")])
def test_dimension_changed_while_running(spark, tmp_path, ttl, later):
    dim_path, source = str(tmp_path / "dim"), str(tmp_path / "in")

    def put_dim(name):
        spark.createDataFrame([(1, name)], "id int, description string").write.mode(
            "overwrite"
        ).parquet(dim_path)

    def put_message():
        spark.createDataFrame([("1",)], "value string").write.mode("append").text(source)

    put_dim("old")
    put_message()
    writer = LabelledWriter(str(tmp_path / "out"), "dim", GENERATED)
    ids = read_messages(spark, "text", path=source).select(F.col("value").cast("int").alias("id"))
    query = start_lookup(
        ids,
        DimSnapshot(lambda session: session.read.parquet(dim_path), ttl),
        described,
        writer,
        JobSettings(f"dim{ttl}", str(tmp_path / "ck"), interval="100 milliseconds"),
        dim_key="id",
    )
    try:
        query.processAllAvailable()
        put_dim("new")
        put_message()
        query.processAllAvailable()
    finally:
        query.stop()
    rows = writer.read(spark).orderBy(LABEL).collect()
    assert [r.description for r in rows] == ["old", later]


def test_large_dimension_is_shuffled_and_planned_adaptively(
    spark, landed, tmp_path, session_conf, plan_text
):
    session_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    inner = LabelledWriter(str(tmp_path / "out"), "wide", ENRICHED)
    plans = []

    def keep_plan(batch, batch_id):
        plans.append(plan_text(batch, "simple"))
        inner(batch, batch_id)

    start_enrich(
        stream(spark, landed), points(spark), keep_plan, settings(tmp_path, "wide"),
        t.TRIAL_SENTINEL, broadcast_bytes=0,
    ).awaitTermination()
    assert as_set(inner.read(spark)) == batch_rows(spark, landed)
    assert all("AdaptiveSparkPlan" in plan and "SortMergeJoin" in plan for plan in plans)
    # The parse is in the stream's own plan, so nothing before the join shuffles.
    assert all(plan.count("Exchange hashpartitioning") == 2 for plan in plans)


def test_a_stream_does_not_broadcast_a_large_dimension_for_each_batch(
    spark, landed, tmp_path, plan_text
):
    inner = LabelledWriter(str(tmp_path / "out"), "large", ENRICHED)
    table, plans = points(spark).current(spark).frame, []

    class Large:
        def current(self, spark):
            return Dimension(table, 5000, jobs.BATCH_BROADCAST_BYTES + 1)

    def keep_plan(batch, batch_id):
        plans.append(plan_text(batch, "simple"))
        inner(batch, batch_id)

    start_enrich(
        stream(spark, landed), Large(), keep_plan, settings(tmp_path, "large"), t.TRIAL_SENTINEL
    ).awaitTermination()
    assert as_set(inner.read(spark)) == batch_rows(spark, landed)
    assert plans and all("SortMergeJoin" in plan for plan in plans)


def test_malformed_message_fails_or_goes_aside(spark, landed, tmp_path):
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(landed)
    good = LabelledWriter(str(tmp_path / "good"), "good", ENRICHED)
    with pytest.raises(Exception):
        start_enrich(
            stream(spark, landed), points(spark), good, settings(tmp_path, "strict")
        ).awaitTermination()
    schema = spark.createDataFrame([], "reason string, value string").schema
    alone = LabelledWriter(str(tmp_path / "alone"), "alone", schema)
    job = settings(tmp_path, "alone")
    start_quarantine(stream(spark, landed), alone, job).awaitTermination()
    assert [r.value for r in alone.read(spark).collect()] == ["{bad"]


def test_no_message_is_lost_between_good_and_malformed(spark, tmp_path):
    """Messages that arrive once the job has started end up on one side or the other."""
    path = str(tmp_path / "in")

    def put(n):
        texts = [f'{{"id":{n},"point_value":1.5,"real_time":"2024-02-01 00:00:00","status":1}}', f"{{bad {n}"]
        spark.createDataFrame([(x,) for x in texts], "value string").write.mode("append").text(path)

    put(1)
    schema = spark.createDataFrame([], "reason string, value string").schema
    kept = LabelledWriter(str(tmp_path / "kept"), "kept", ENRICHED)
    aside = LabelledWriter(str(tmp_path / "aside"), "aside", schema)
    job = JobSettings("split", str(tmp_path / "ck"), interval="100 milliseconds")
    query = start_enrich(
        stream(spark, path), points(spark), kept, job, None, rejects=aside
    )
    try:
        put(2)
        query.processAllAvailable()
        put(3)
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.point_id for r in kept.read(spark).collect()) == [1, 2, 3]
    assert sorted(r.value for r in aside.read(spark).collect()) == ["{bad 1", "{bad 2", "{bad 3"]


def test_running_count_with_a_shuffled_dimension(spark, landed, tmp_path, plan_text):
    inner = LabelledWriter(str(tmp_path / "counts"), "count", COUNT)
    plans, failures = [], []

    def fails_after_writing(batch, batch_id):
        plans.append(plan_text(batch, "simple"))
        inner(batch, batch_id)
        if batch_id == 2 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost after the write")

    def run():
        start_count(
            parse_messages(stream(spark, landed)), points(spark), fails_after_writing,
            settings(tmp_path, "totals"), broadcast_bytes=0,
        ).awaitTermination()

    with pytest.raises(Exception):
        run()
    run()
    assert failures == [2] and inner.read(spark).count() == 4
    assert [r.total for r in running_total(inner.read(spark)).collect()] == [1000]
    assert all("AdaptiveSparkPlan" in plan and "SortMergeJoin" in plan for plan in plans)


def test_trial_writes_and_counts_the_same_rows(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "out"), "trial", GENERATED)
    counts = LabelledWriter(str(tmp_path / "counts"), "count", COUNT)
    job = JobSettings("trial", str(tmp_path / "ck"), interval="200 milliseconds")
    ids = generate_stream(spark, rows_per_second=200)
    query = start_trial(
        ids, lambda session: t.described_dim(session, SF_DIR), writer, counts, job
    )
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not running_total(counts.read(spark)).first().total:
            time.sleep(0.5)
    finally:
        query.stop()
    rows = writer.read(spark)
    assert rows.filter("id not between 1 and 10 or description is null").count() == 0
    by_batch = lambda frame: {
        r[LABEL].split("_")[2]: r.n for r in frame.groupBy(LABEL).agg(F.expr("sum(n)").alias("n")).collect()
    }
    counted = by_batch(counts.read(spark).withColumnRenamed("total", "n"))
    written = by_batch(rows.withColumn("n", F.lit(1)))
    assert sum(counted.values()) > 0
    assert all(written.get(batch, 0) == n for batch, n in counted.items())


def test_generated_ids_repeat_and_stay_in_range(spark):
    got = [r.id for r in spark.range(1000).select(generated_id("id").alias("id")).collect()]
    want = [int(hashlib.md5(str(n).encode()).hexdigest()[:8], 16) % 10 + 1 for n in range(1000)]
    assert got == want and set(got) == set(range(1, 11))
    other = {r.id for r in generate_batch(spark, 500, low=5, high=6).collect()}
    assert other == {5, 6}


def test_messages_streamed_to_text(spark, landed, tmp_path):
    out = str(tmp_path / "topic")
    stream_messages(
        stream(spark, landed), settings(tmp_path, "topic"), "text", path=out
    ).awaitTermination()
    assert sorted(spark.read.text(out).collect()) == sorted(spark.read.text(landed).collect())


def test_console(spark, tmp_path, capsys):
    path = str(tmp_path / "wide")
    spark.createDataFrame([(f"{n:02d}" + "x" * 60,) for n in range(30)], "value string").coalesce(1).write.text(path)
    print_rows(stream(spark, path), settings(tmp_path, "console")).awaitTermination()
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 31 and all(len(line) == 62 for line in lines[1:])
    job = settings(tmp_path, "console_few")
    print_rows(stream(spark, path), job, limit=5, width=10).awaitTermination()
    lines = capsys.readouterr().out.splitlines()
    assert len(lines) == 6 and all(len(line) == 10 for line in lines[1:])


def test_batch_limits():
    job = JobSettings("job", "unused", batch_rows=10_000, batch_files=2)
    assert batch_limit("kafka", job) == {"maxOffsetsPerTrigger": "10000"}
    assert batch_limit("text", job) == {"maxFilesPerTrigger": "2"}
    assert batch_limit("text", None) == batch_limit("kafka", ONE_FILE) == {}


def test_settings(tmp_path):
    path = tmp_path / "job.properties"
    path.write_text(
        "# trial\nname=enrich\ncheckpoint = /shared/ck\ninterval=10 seconds\n"
        "batch_rows=500\nbatch_files=2\nparallelism=10\navailable_now=true\n"
    )
    job = JobSettings.from_properties(str(path))
    assert job == JobSettings("enrich", "/shared/ck", "10 seconds", True, 500, 2, 10)
    beside = JobSettings("enrich_count", "/shared/ck_count", "10 seconds", True, 500, 2, 10)
    assert job.beside("count") == beside
    path.write_text("name=a\ncheckpoint=b\ntopic=c\n")
    with pytest.raises(ValueError):
        JobSettings.from_properties(str(path))
    quick = small_batches("first", "/shared/first")
    assert (quick.interval, quick.batch_rows, quick.batch_files) == ("2 seconds", 10_000, 1)


def counted(spark, tmp_path, *totals, run="a", part_batches=3):
    """A table of counts, written batch by batch."""
    counts = LabelledWriter(str(tmp_path / "counts"), "c", COUNT, run=run, part_batches=part_batches)
    for batch, total in enumerate(totals):
        counts(spark.createDataFrame([(total,)], COUNT), batch)
    return counts


def changes(spark, counts, block):
    found = running_changes(counts.batches(spark), block)
    return sorted((r.load_run, r.load_batch, r.before, r.after) for r in found.collect())


def test_changes_of_the_total(spark, tmp_path):
    totals = [4, 0, 7, 1, 0, 0, 3, 5]
    counts = counted(spark, tmp_path, *totals)
    counted(spark, tmp_path, 10, 20, run="b")
    expected = [("a", i, sum(totals[:i]), sum(totals[: i + 1])) for i in range(8)]
    expected += [("b", 0, 0, 10), ("b", 1, 10, 30)]
    for block in (1, 2, 3, 1000):
        assert changes(spark, counts, block) == expected
    counts.compact(spark, "a", 0)
    counts.remove_replaced(spark, "a")
    # A replay with another count: later totals follow.
    counts(spark.createDataFrame([(6,)], COUNT), 7)
    expected[7] = ("a", 7, 15, 21)
    assert changes(spark, counts, 2) == expected


def test_rows_of_the_changelog(spark, tmp_path):
    counts = counted(spark, tmp_path, 0, 2, 0, 3)
    found = change_rows(running_changes(counts.batches(spark), 2))
    rows = [(r.load_batch, r.kind, r.total) for r in found.collect()]
    assert sorted(rows) == [(0, "+I", 0), (1, "+U", 2), (1, "-U", 0), (3, "+U", 5), (3, "-U", 2)]


def test_blocks_are_added_up_in_many_tasks(spark, tmp_path, plan_text):
    counts = counted(spark, tmp_path, 1, 2)
    plan = plan_text(running_changes(counts.batches(spark), 2))
    assert "SinglePartition" not in plan and plan.count("Window") >= 2


def test_a_large_file_gives_many_bounded_batches(spark, tmp_path):
    source, landing = str(tmp_path / "in"), str(tmp_path / "cut")
    spark.range(1000).selectExpr("CAST(id AS STRING) AS value").coalesce(1).write.text(source)
    cut = settings(tmp_path, "cut", batch_rows=90)
    bounded_files(spark, source, landing, cut).awaitTermination()
    seen = []
    reading = settings(tmp_path, "reading", batch_files=1)
    rows = stream(spark, landing, reading)

    def run():
        reading.start(rows.writeStream.foreachBatch(lambda b, _: seen.append(b.count()))).awaitTermination()

    run()
    assert sum(seen) == 1000 and max(seen) <= 90 and len(seen) >= 12
    # More rows later, and nothing twice.
    spark.range(100).selectExpr("CAST(id AS STRING) AS value").write.mode("append").text(source)
    bounded_files(spark, source, landing, cut).awaitTermination()
    run()
    assert sum(seen) == 1100 and max(seen) <= 90
    with pytest.raises(ValueError):
        bounded_files(spark, source, landing, settings(tmp_path, "unbounded"))


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(0, 800, 1, 8).selectExpr("CAST(id + 1000 AS STRING) AS value").write.text(source)
    seen = []
    by_bytes = settings(tmp_path, "bytes", batch_bytes=1000)
    rows = stream(spark, source, by_bytes)
    by_bytes.start(rows.writeStream.foreachBatch(lambda b, _: seen.append(b.count()))).awaitTermination()
    # Files of 500 bytes: two to a batch.
    assert seen == [200] * 4
    assert batch_limit("text", by_bytes) == {"maxBytesPerTrigger": "1000"}
    assert JobSettings.from_properties(_properties(tmp_path, "batch_bytes=1000")).batch_bytes == 1000


def _properties(tmp_path, *lines):
    path = tmp_path / "job.properties"
    path.write_text("\n".join(["name=job", "checkpoint=/ck", *lines]))
    return str(path)


def test_datagram_files_are_landed_once_and_cleared(spark, tmp_path):
    source, landing, archive = (tmp_path / n for n in ("in", "captures", "archive"))
    source.mkdir()
    job = settings(tmp_path, "landing", batch_files=2)

    def arrive(*numbers):
        for n in numbers:
            (source / f"{n}.bin").write_bytes(b"h" * 10 + bytes([n]) * 13)

    def land(**how):
        land_datagrams(spark, str(source), str(landing), job, **how).awaitTermination()
        rows = read_captures(spark, str(landing)).collect()
        assert len({r.frame_id for r in rows}) == len(rows)
        return sorted(bytes(r.payload)[10] for r in rows)

    arrive(1, 2, 3)
    assert land(archive=str(archive)) == [1, 2, 3]
    assert land(archive=str(archive)) == [1, 2, 3]
    arrive(4, 5)
    assert land(archive=str(archive)) == [1, 2, 3, 4, 5]
    for _ in range(50):
        if len(list(archive.rglob("*.bin"))) >= 3:
            break
        time.sleep(0.1)
    # The last batch's files stay until the next one.
    assert {p.name for p in archive.rglob("*.bin")} >= {"1.bin", "2.bin", "3.bin"}
    assert not (source / "1.bin").exists()
    frames = read_captures(spark, str(landing), stream=True)
    seen = []
    read = settings(tmp_path, "read")
    read.start(frames.writeStream.foreachBatch(lambda b, _: seen.append(b.count()))).awaitTermination()
    assert sum(seen) == 5
    arrive(6)
    assert land(delete=True) == [1, 2, 3, 4, 5, 6]
