import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F

from pointstream.functions.times import day_text, milli_text, outside_day, second_text
from pointstream.operators.messages import (
    drop_sentinel,
    message_rejects,
    non_finite_rejects,
    parse_messages,
    through_json,
    to_messages,
    to_readings,
)
from pointstream.schemas import MESSAGE, RECORD
from pointstream.sinks.messages import write_messages

T0 = dt.datetime(2024, 12, 18, 21, 41, 28)
T1 = dt.datetime(2024, 12, 18, 21, 41, 25)
GOOD = (
    '{"collect_time":"2024-12-18 21:41:28","id":17,"point_value":36.6,'
    '"real_time":"2024-12-18 21:41:25","status":0}'
)


def texts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def records(spark, *values):
    return spark.createDataFrame([(n, T0, 17, v, T1, 3) for n, v in enumerate(values)], RECORD)


def test_message_keys_and_values(spark):
    row = to_messages(records(spark, 36.6)).first()
    assert json.loads(row.value) == {
        "collect_time": "2024-12-18 21:41:28",
        "id": 17,
        "point_value": 36.6,
        "real_time": "2024-12-18 21:41:25",
        "status": 3,
    }


def test_parse_types(spark):
    readings = parse_messages(texts(spark, GOOD))
    assert readings.schema == MESSAGE
    assert tuple(readings.first()) == (T0, 17, 36.6, T1, 0)


def test_milliseconds_are_kept(spark):
    row = parse_messages(texts(spark, '{"real_time":"2024-01-01 10:00:00.125"}')).first()
    assert row.real_time == dt.datetime(2024, 1, 1, 10, 0, 0, 125_000)


def test_missing_keys_are_null_and_no_message_is_no_row(spark):
    rows = parse_messages(texts(spark, '{"id":2}', None)).collect()
    assert [tuple(r) for r in rows] == [(None, 2, None, None, None)]


BAD = ["{bad", '{"id":"x","status":1}', "null", "[]", "", '{"real_time":"yesterday"}']


@pytest.mark.parametrize("text", BAD)
def test_fail_mode_raises(spark, text):
    with pytest.raises(Exception):
        parse_messages(texts(spark, GOOD, text)).collect()


def test_quarantine_splits_good_and_bad(spark):
    messages = texts(spark, GOOD, *BAD, '{"id":2}', None).withColumn(
        "offset", F.monotonically_increasing_id()
    )
    assert sorted(r.id for r in parse_messages(messages, "quarantine").collect()) == [2, 17]
    rejects = message_rejects(messages)
    assert rejects.columns == ["offset", "reason", "value"]
    assert sorted(r.value for r in rejects.collect()) == sorted(BAD)


def test_unknown_error_mode_is_refused(spark):
    with pytest.raises(ValueError):
        parse_messages(texts(spark, GOOD), "ignore")


def test_float_widens_through_its_text(spark):
    values = [0.1, 36.6, -273.15, 0.0, 3.4e38, 1e-42, None]
    source = records(spark, *values)
    fused = [r.point_value for r in to_readings(source).orderBy("record_seq").collect()]
    assert fused[0] == 0.1 and fused[1] == 36.6 and fused[-1] is None
    parsed = parse_messages(to_messages(source, ["record_seq"])).orderBy("record_seq")
    assert [r.point_value for r in parsed.collect()] == fused


def test_non_finite_values_are_rejected(spark):
    source = records(spark, 1.0, math.nan, math.inf, -math.inf, None)
    assert to_messages(source).count() == 2
    assert to_readings(source).count() == 2
    rejects = non_finite_rejects(source).orderBy("record_seq").collect()
    assert [(r.record_seq, r.reason) for r in rejects] == [(n, "non_finite") for n in (1, 2, 3)]


def test_each_message_is_parsed_once(spark, tmp_path, plan_text):
    texts(spark, GOOD).write.text(str(tmp_path / "m"))
    source = spark.read.text(str(tmp_path / "m"))
    for mode in ("fail", "quarantine"):
        plan = plan_text(drop_sentinel(parse_messages(source, mode)), "simple")
        assert plan.count("from_json(") == 1


EDGES = [
    "1969-12-31 23:59:59.999",
    "1970-01-01 00:00:00",
    "1970-01-01 23:59:59.999",
    "1970-01-02 00:00:00",
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_sentinel_day_edges(spark, session_conf, zone):
    session_conf(spark__sql__session__timeZone=zone)
    local = F.col("value").cast("timestamp_ntz").alias("real_time")
    times = texts(spark, *EDGES, None).select(local)
    kept = drop_sentinel(times).select(milli_text("real_time")).collect()
    assert [r[0] for r in kept] == [EDGES[0], "1970-01-02 00:00:00.000"]
    by_text = times.filter(day_text("real_time") != "1970-01-01").select(milli_text("real_time"))
    assert by_text.collect() == kept
    assert drop_sentinel(times, None).count() == 5


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_time_texts(spark, session_conf, zone):
    session_conf(spark__sql__session__timeZone=zone)
    row = spark.sql("select timestamp_ntz'2024-03-10 02:30:00.1205' t").select(
        second_text("t"), milli_text("t"), day_text("t")
    ).first()
    assert tuple(row) == ("2024-03-10 02:30:00", "2024-03-10 02:30:00.120", "2024-03-10")


def test_sentinel_range_reaches_the_scan(spark, tmp_path, plan_text):
    path = str(tmp_path / "r")
    local = F.col("value").cast("timestamp_ntz").alias("real_time")
    texts(spark, EDGES[0]).select(local, "value").write.parquet(path)
    readings = spark.read.parquet(path).filter(outside_day("real_time", "1970-01-01"))
    plan = plan_text(readings.select("real_time"))
    assert "Or(LessThan(real_time" in plan
    assert "ReadSchema: struct<real_time:timestamp_ntz>" in plan


def test_messages_to_text_files(spark, tmp_path):
    path = str(tmp_path / "out")
    write_messages(to_messages(records(spark, 36.6, 1.5)), "text", path=path)
    back = parse_messages(spark.read.text(path))
    assert sorted(r.point_value for r in back.collect()) == [1.5, 36.6]


def test_zero_keeps_its_sign_from_float_to_double(spark):
    values = spark.sql("SELECT CAST(v AS FLOAT) AS v FROM VALUES ('0'), ('-0.0'), ('0.1'), (NULL) AS t(v)")
    rows = values.select(through_json(F.col("v")).alias("v")).collect()
    assert [str(r.v) for r in rows] == ["0.0", "-0.0", "0.1", "None"]
