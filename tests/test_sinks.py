import pytest
from pyspark.sql import functions as F

from pointstream.operators.ledger import load_ledger, pulled_days
from pointstream.schemas import GENERATED, LEDGER
from pointstream.sinks import tables as module
from pointstream.sinks.tables import (
    LabelledWriter,
    append_batches,
    append_rows,
    bind_by_position,
    write_day,
    write_days,
)
from pointstream.storage import put_new


def pairs(spark, *ids):
    return spark.createDataFrame([(i, f"d{i}") for i in ids], "a int, b string")


def test_positional_binding(spark):
    rows = bind_by_position(pairs(spark, 1), GENERATED)
    assert rows.columns == ["id", "description"]
    with pytest.raises(ValueError):
        bind_by_position(pairs(spark, 1).select("a"), GENERATED)
    with pytest.raises(TypeError):
        bind_by_position(pairs(spark, 1).select("b", "a"), GENERATED)


def test_replayed_batch_adds_no_rows(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED)
    writer(pairs(spark, 1, 2), 0)
    writer(pairs(spark, 3), 1)
    writer(pairs(spark, 3), 1)
    got = sorted((r.id, r.load_label) for r in writer.read(spark).collect())
    assert got == [(1, "job_batch_0"), (2, "job_batch_0"), (3, "job_batch_1")]


def test_table_is_empty_before_the_first_batch(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED)
    assert writer.read(spark).count() == 0
    assert writer.read(spark).columns == [*GENERATED.names, "load_label"]


def test_runs_do_not_replace_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    LabelledWriter(path, "job", GENERATED, run="one")(pairs(spark, 1), 0)
    other = LabelledWriter(path, "job", GENERATED, run="two")
    other(pairs(spark, 2), 0)
    assert sorted(r.id for r in other.read(spark).collect()) == [1, 2]


def test_replay_after_compaction_adds_no_rows(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, run="a", part_batches=3)
    for batch in range(8):
        writer(pairs(spark, batch), batch)
    with pytest.raises(ValueError):
        writer.compact(spark, "a", 2)
    for part in (0, 1, 0):
        writer.compact(spark, "a", part)
    writer(pairs(spark, 7), 7)
    # A replay far back: its part is compacted, its rows are there.
    writer(pairs(spark, 2), 2)
    for _ in range(2):
        rows = writer.read(spark).collect()
        assert sorted((r.id, r.load_label) for r in rows) == [(i, f"job_a_{i}") for i in range(8)]
        writer.remove_replaced(spark, "a")
    found = sorted((r.load_run, r.load_batch, r.id) for r in writer.batches(spark).collect())
    assert found == [("a", i, i) for i in range(8)]
    with pytest.raises(ValueError):
        writer.compact(spark, "a", 2)


class Killed(Exception):
    pass


def killed_at(monkeypatch, name, call):
    """Lets the call with that number, of a function of the module, end the program."""
    calls, given = [], getattr(module, name)

    def counted(*args):
        calls.append(args)
        if len(calls) == call:
            raise Killed
        return given(*args)

    monkeypatch.setattr(module, name, counted)


@pytest.mark.parametrize(("step", "call"), [("put_new", 1), ("remove", 1), ("remove", 2), ("remove", 3)])
def test_compaction_broken_off_at_any_step(spark, tmp_path, monkeypatch, step, call):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, run="a", part_batches=2)
    for batch in range(6):
        writer(pairs(spark, batch), batch)
    writer.compact(spark, "a", 0)
    with monkeypatch.context() as patch:
        killed_at(patch, step, call)
        with pytest.raises(Killed):
            writer.compact(spark, "a", 1)
            writer.remove_replaced(spark, "a")
            # Two parts and a manifest are to be removed.
            assert call == 3
    assert sorted(r.id for r in writer.read(spark).collect()) == list(range(6))
    writer.compact(spark, "a", 1)
    writer.remove_replaced(spark, "a")
    assert sorted(r.id for r in writer.read(spark).collect()) == list(range(6))
    folder = tmp_path / "t" / "load_run=a"
    assert sorted(p.name for p in folder.glob("load_part=*")) == ["load_part=2"]
    kept = sorted(p.name.split("-")[0] for p in (folder / "_compacted").iterdir() if not p.name.startswith("."))
    assert kept == ["manifest", "part", "part"]


def test_a_manifest_that_is_cut_short_is_not_in_force(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, run="a", part_batches=1)
    for batch in range(3):
        writer(pairs(spark, batch), batch)
    writer.compact(spark, "a", 0)
    put_new(spark, f"{tmp_path}/t/load_run=a/_compacted/manifest-2", '{"0": "part')
    assert sorted(r.id for r in writer.read(spark).collect()) == [0, 1, 2]
    writer.remove_replaced(spark, "a")
    writer.compact(spark, "a", 1)
    writer.remove_replaced(spark, "a")
    assert sorted(r.id for r in writer.read(spark).collect()) == [0, 1, 2]
    with pytest.raises(Exception):
        put_new(spark, f"{tmp_path}/t/load_run=a/_compacted/manifest-3", "{}")


def test_readers_that_began_before_a_compaction(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, run="a", part_batches=1)
    for batch in range(3):
        writer(pairs(spark, batch), batch)
    before = writer.read(spark)
    writer.compact(spark, "a", 0)
    writer.compact(spark, "a", 1)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]


def test_number_of_files_leaves_the_join_its_tasks(spark, tmp_path, plan_text, monkeypatch):
    rows = spark.range(0, 1000, 1, 6).selectExpr("CAST(id AS INT) AS a", "CAST(id AS STRING) AS b")
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, files=2)
    assert "RoundRobinPartitioning(2)" in plan_text(rows.repartition(2), "simple")
    writer(rows, 0)
    files = list((tmp_path / "t").glob("*/*/*/*.parquet"))
    assert len(files) == 2 and writer.read(spark).count() == 1000


def test_replay_that_became_empty_leaves_no_rows(spark, tmp_path):
    writer = LabelledWriter(str(tmp_path / "t"), "job", GENERATED, files=1)
    writer(pairs(spark, 1, 2), 0)
    writer(pairs(spark, 5), 1)
    writer(pairs(spark), 0)
    assert [r.id for r in writer.read(spark).collect()] == [5]
    assert GENERATED.names == ["id", "description"]


def test_plain_append_writers(spark, tmp_path):
    path = str(tmp_path / "plain")
    append_rows(pairs(spark, 1), "parquet", path=path)
    append_batches("parquet", path=path)(pairs(spark, 2), 7)
    assert spark.read.parquet(path).count() == 2


def days(spark, *rows):
    return spark.createDataFrame(list(rows), LEDGER)


def read_days(spark, path):
    rows = spark.read.schema("content string, cm string").parquet(path).collect()
    return sorted((r.cm, r.content) for r in rows)


def test_days_are_replaced(spark, tmp_path):
    path = str(tmp_path / "ledger")
    write_days(days(spark, ("2024-01-01", "a"), ("2024-01-01", "b"), ("2024-01-02", "c")), path)
    write_days(days(spark, ("2024-01-02", "d")), path)
    assert read_days(spark, path) == [
        ("2024-01-01", "a"),
        ("2024-01-01", "b"),
        ("2024-01-02", "d"),
    ]
    write_day(days(spark, ("2024-01-01", "e"), ("2024-01-02", "other day")), path, "2024-01-01")
    assert read_days(spark, path) == [("2024-01-01", "e"), ("2024-01-02", "d")]
    write_day(days(spark), path, "2024-01-02")
    assert read_days(spark, path) == [("2024-01-01", "e")]


def test_a_hot_day_is_split_over_tasks(spark, tmp_path, session_conf):
    session_conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes="512KB",
    )
    path = str(tmp_path / "ledger")
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "2024-01-01").otherwise(
            F.concat(F.lit("2024-02-"), (F.col("id") % 20 + 10).cast("string"))
        ).alias("cm"),
        F.sha2(F.col("id").cast("string"), 256).alias("content"),
    )
    write_days(rows, path)
    files = [f.name for f in (tmp_path / "ledger" / "cm=2024-01-01").glob("*.parquet")]
    everywhere = list((tmp_path / "ledger").glob("cm=*/*.parquet"))
    # Without the rebalance each of the 8 tasks would write to each of the 21 days.
    assert len(files) > 1 and len(everywhere) < 8 * 21 / 2
    assert spark.read.parquet(path).count() == 60_000


def test_an_empty_pull_empties_its_day(spark, tmp_path):
    path = str(tmp_path / "ledger")

    def pull(*responses):
        rows = spark.createDataFrame(list(responses), "value string, run_date string")
        rows = rows.withColumn("run_date", F.to_date("run_date"))
        day = F.col("run_date")
        write_days(load_ledger(rows, day), path, pulled=pulled_days(rows, day))

    pull(('{"result":[{"a":1}]}', "2024-01-02"), ('{"result":[{"a":2}]}', "2024-01-03"))
    assert [cm for cm, _ in read_days(spark, path)] == ["2024-01-01", "2024-01-02"]
    # One day empty, one failed: the first goes, the second stays.
    pull(('{"result":[]}', "2024-01-02"), ('{"code":500}', "2024-01-03"))
    assert read_days(spark, path) == [("2024-01-02", '{"a":2}')]
    pull(('{"result":[]}', "2024-01-03"), ('{"result":[{"a":3}]}', "2024-01-03"))
    assert read_days(spark, path) == [("2024-01-02", '{"a":3}')]
