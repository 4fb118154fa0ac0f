import pytest
from pyspark.sql import functions as F

from pointstream.sinks import logged
from pointstream.sinks.logged import InDoubt, LoggedAppends, label_in_target
from pointstream.sinks.tables import append_rows
from pointstream.storage import names


class Killed(Exception):
    pass


def rows(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id int")


class Target:
    """A plain append target that can be told to fail before or after its append."""

    def __init__(self, path):
        self.path, self.before, self.after = str(path), False, False

    def __call__(self, frame):
        if self.before:
            raise Killed
        append_rows(frame, "parquet", path=self.path)
        if self.after:
            raise Killed

    def ids(self, spark):
        return sorted(r.id for r in spark.read.parquet(self.path).collect())


@pytest.fixture
def target(tmp_path):
    return Target(tmp_path / "target")


def test_a_replay_adds_nothing(spark, tmp_path, target):
    writer = LoggedAppends(str(tmp_path / "log"), "job", target, run="a")
    for batch in (0, 1, 1, 2, 0, 2):
        writer(rows(spark, batch), batch)
    assert target.ids(spark) == [0, 1, 2]
    assert names(spark, str(tmp_path / "log" / "job_a")) == ["done-2"]
    # Another run, from a new checkpoint, is a run of its own.
    LoggedAppends(str(tmp_path / "log"), "job", target, run="b")(rows(spark, 9), 0)
    assert target.ids(spark) == [0, 1, 2, 9]


def test_broken_off_before_the_append(spark, tmp_path, target):
    writer = LoggedAppends(str(tmp_path / "log"), "job", target, run="a")
    target.before = True
    with pytest.raises(Killed):
        writer(rows(spark, 1, 2), 0)
    target.before = False
    # The replay computes something else: what was staged is appended.
    writer(rows(spark, 1, 2, 3), 0)
    writer(rows(spark, 4), 1)
    assert target.ids(spark) == [1, 2, 4]


def broken_off_after_the_append(spark, tmp_path, target, **how):
    writer = LoggedAppends(str(tmp_path / "log"), "job", target, run="a", **how)
    writer(rows(spark, 0), 0)
    target.after = True
    with pytest.raises(Killed):
        writer(rows(spark, 1), 1)
    target.after = False
    return writer


def test_the_window_that_is_left(spark, tmp_path, target):
    writer = broken_off_after_the_append(spark, tmp_path, target)
    writer(rows(spark, 1), 1)
    assert target.ids(spark) == [0, 1, 1]


def test_the_window_can_be_refused(spark, tmp_path, target):
    writer = broken_off_after_the_append(spark, tmp_path, target, in_doubt=logged.FAIL)
    with pytest.raises(InDoubt):
        writer(rows(spark, 1), 1)
    with pytest.raises(ValueError):
        LoggedAppends("log", "job", target, in_doubt="guess")


def test_a_target_that_can_be_asked_closes_the_window(spark, tmp_path, target):
    landed = label_in_target("parquet", "label", path=target.path)
    writer = broken_off_after_the_append(spark, tmp_path, target, label_column="label", landed=landed)
    writer(rows(spark, 1), 1)
    writer(rows(spark, 2), 2)
    assert target.ids(spark) == [0, 1, 2]
    labels = {r.label for r in spark.read.parquet(target.path).collect()}
    assert labels == {"job_a_0", "job_a_1", "job_a_2"}
    target.before = True
    with pytest.raises(Killed):
        writer(rows(spark, 3), 3)
    target.before = False
    writer(rows(spark, 3), 3)
    assert target.ids(spark) == [0, 1, 2, 3]


@pytest.mark.parametrize("step", ["put_new", "remove"])
def test_broken_off_in_the_log(spark, tmp_path, target, monkeypatch, step):
    writer = LoggedAppends(str(tmp_path / "log"), "job", target, run="a")
    writer(rows(spark, 0), 0)

    def killed(*_):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(logged, step, killed)
        with pytest.raises(Killed):
            writer(rows(spark, 1), 1)
    writer(rows(spark, 1), 1)
    writer(rows(spark, 2), 2)
    assert target.ids(spark) == [0, 1, 2]
    assert names(spark, str(tmp_path / "log" / "job_a")) == ["done-2"]


def test_an_empty_batch(spark, tmp_path, target):
    writer = LoggedAppends(str(tmp_path / "log"), "job", target, run="a")
    writer(rows(spark), 0)
    writer(rows(spark, 1), 1)
    assert target.ids(spark) == [1]
    assert writer.last_done(spark, "a") == 1 and writer.last_done(spark, "none") is None


def test_the_run_of_a_stream(spark, tmp_path, target):
    """Two streams from new checkpoints, each replayed by hand: four batches in all."""
    source = str(tmp_path / "source")
    rows(spark, 1, 2).coalesce(1).write.parquet(source)
    writer = LoggedAppends(str(tmp_path / "log"), "job", target)

    def twice(batch, batch_id):
        writer(batch, batch_id)
        writer(batch, batch_id)

    for name in ("one", "two"):
        stream = spark.readStream.schema("id int").parquet(source).writeStream.foreachBatch(twice)
        stream = stream.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True)
        stream.start().awaitTermination()
    assert target.ids(spark) == [1, 1, 2, 2]
    assert len(names(spark, str(tmp_path / "log"))) == 2
