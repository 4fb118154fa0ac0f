from pathlib import Path

import pytest

from pointstream.operators.keyed import KeyedDimension
from pointstream.operators.lookup import Dimension
from pointstream.sources.dimension import DimSnapshot, StaleDimension


class Clock:
    def __init__(self):
        self.now = 0.0

    def __call__(self):
        return self.now


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "dim")

    def put(*ids):
        spark.createDataFrame([(i,) for i in ids], "id int").write.mode("overwrite").parquet(path)

    put(1, 2)
    return put, lambda session: session.read.parquet(path)


def ids(dimension):
    return sorted(r.id for r in dimension.frame.collect())


def test_copy_outlives_a_change_until_its_time_is_up(spark, table):
    put, loader = table
    clock = Clock()
    snapshot = DimSnapshot(loader, ttl=10, clock=clock)
    assert ids(snapshot.current(spark)) == [1, 2]
    put(3)
    clock.now = 9.9
    assert ids(snapshot.current(spark)) == [1, 2]
    clock.now = 10
    assert ids(snapshot.current(spark)) == [3]


def test_uncached_lookup_sees_every_change(spark, table):
    put, loader = table
    snapshot = DimSnapshot(loader, ttl=0)
    assert ids(snapshot.current(spark)) == [1, 2]
    put(3)
    assert ids(snapshot.current(spark)) == [3]


def test_one_load_per_life_and_two_copies_at_most(spark, table, tmp_path):
    put, loader = table
    loads = []

    def counted(session):
        loads.append(1)
        return loader(session)

    clock = Clock()
    snapshot = DimSnapshot(counted, ttl=1, clock=clock)
    for now in range(5):
        clock.now = now
        put(now)
        first, second = snapshot.current(spark), snapshot.current(spark)
        assert first is second and ids(first) == [now]
    assert len(loads) == 5
    folder = Path(snapshot._folder.removeprefix("file:"))
    assert sorted(p.name for p in folder.iterdir()) == ["copy-0", "copy-1"]


def test_a_failed_load_keeps_nothing_half_done(spark, table):
    put, loader = table
    clock = Clock()
    fail = []

    def flaky(session):
        if fail:
            raise RuntimeError("dimension store is down")
        return loader(session)

    snapshot = DimSnapshot(flaky, ttl=1, clock=clock, retries=0)
    snapshot.current(spark)
    fail.append(True)
    clock.now = 2
    with pytest.raises(StaleDimension):
        snapshot.current(spark)
    fail.clear()
    put(8)
    assert ids(snapshot.current(spark)) == [8]


def test_size_is_measured_on_the_copy(spark, table):
    _, loader = table
    dimension = DimSnapshot(loader).current(spark)
    assert dimension.rows == 2 and dimension.size_bytes > 0


class Store:
    """A loader that fails as often as it is told."""

    def __init__(self, loader):
        self.loader, self.failures, self.calls = loader, 0, 0

    def __call__(self, session):
        self.calls += 1
        if self.failures:
            self.failures -= 1
            raise OSError("dimension store is down")
        return self.loader(session)


def test_a_load_is_tried_again_with_growing_pauses(spark, table):
    _, loader = table
    store, pauses = Store(loader), []
    snapshot = DimSnapshot(store, pause=2, sleep=pauses.append)
    store.failures = 2
    assert ids(snapshot.current(spark)) == [1, 2]
    assert pauses == [2, 4] and store.calls == 3


def test_without_a_copy_a_load_that_fails_for_good_ends_the_batch(spark, table):
    _, loader = table
    store, pauses = Store(loader), []
    store.failures = 100
    with pytest.raises(StaleDimension) as raised:
        DimSnapshot(store, max_age=3600, sleep=pauses.append).current(spark)
    assert pauses == [1, 2, 4] and isinstance(raised.value.__cause__, OSError)


def test_the_last_good_copy_serves_until_it_is_too_old(spark, table):
    put, loader = table
    store, clock = Store(loader), Clock()
    snapshot = DimSnapshot(store, ttl=10, clock=clock, max_age=30, sleep=lambda _: None)
    assert ids(snapshot.current(spark)) == [1, 2]
    put(3)
    store.failures, clock.now = 1000, 10
    assert ids(snapshot.current(spark)) == [1, 2] and snapshot.failed_loads == 1
    clock.now = 30
    assert ids(snapshot.current(spark)) == [1, 2] and store.calls == 9
    clock.now = 31
    with pytest.raises(StaleDimension):
        snapshot.current(spark)
    store.failures = 0
    assert ids(snapshot.current(spark)) == [3]
    # Its age counts from the load that worked.
    clock.now = 40
    assert ids(snapshot.current(spark)) == [3] and store.calls == 14


def test_a_load_that_breaks_while_it_is_written_leaves_the_copy(spark, table):
    put, loader = table
    clock, broken = Clock(), []

    def breaking(session):
        frame = loader(session)
        return frame.selectExpr("CAST(raise_error('lost') AS INT) AS id") if broken else frame

    snapshot = DimSnapshot(breaking, ttl=1, clock=clock, max_age=100, retries=1, sleep=lambda _: None)
    snapshot.current(spark)
    broken.append(1)
    clock.now = 5
    assert ids(snapshot.current(spark)) == [1, 2]


def test_a_large_dimension_is_kept_by_key(spark, table):
    _, loader = table
    assert isinstance(DimSnapshot(loader, key="id").current(spark), Dimension)
    found = DimSnapshot(loader, key="id", keyed_beyond=0, buckets=4).current(spark)
    assert isinstance(found, KeyedDimension) and found.rows == 2
    assert sorted(r.id for r in found.read().collect()) == [1, 2]
