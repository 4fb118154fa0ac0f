import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from pointstream.functions import binary as b
from pointstream.operators.decode import BUFFER, decode_frames, frame_rejects
from pointstream.operators.messages import drop_sentinel
from pointstream.schemas import FRAME
from pointstream.sources.captures import read_captures, read_datagram_files

ARRIVAL = dt.datetime(2024, 12, 18, 13, 41, 28, 900_000, tzinfo=dt.timezone.utc)
HEADER = bytes(range(10))


def pack(*records, signed=True):
    layout = "<ifiB" if signed else "<IfIB"
    return HEADER + b"".join(struct.pack(layout, *record) for record in records)


def frames_of(spark, *payloads):
    rows = [(n, ARRIVAL, bytearray(payload)) for n, payload in enumerate(payloads)]
    return spark.createDataFrame(rows, FRAME)


def rows_of(frame):
    return [tuple(r) for r in frame.orderBy("frame_id", "record_seq").collect()]


def float_bits(value):
    return struct.pack("<f", value)


FLOATS = [0.1, 36.6, -273.15, 0.0, -0.0, 3.4e38, -3.4e38, 1e-42, -1e-45, 2.0**-126, 1.0, 2.0**127]


def test_fields_bit_for_bit(spark):
    records = [(n - 5, value, n, n * 20) for n, value in enumerate(FLOATS)]
    got = decode_frames(frames_of(spark, pack(*records))).orderBy("record_seq").collect()
    assert [r.id for r in got] == [r[0] for r in records]
    assert [float_bits(r.point_value) for r in got] == [float_bits(v) for v in FLOATS]
    assert [r.status for r in got] == [r[3] for r in records]
    assert [r.record_seq for r in got] == list(range(len(FLOATS)))


def test_infinite_and_nan(spark):
    payload = pack(*[(1, v, 0, 0) for v in (math.inf, -math.inf, math.nan)])
    records = decode_frames(frames_of(spark, payload)).orderBy("record_seq")
    got = [r.point_value for r in records.collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2])


def test_field_functions_and_hex_round_trip(spark):
    payload = pack((-2, 36.6, -7, 200))
    row = frames_of(spark, payload).select(
        b.le_int32("payload", 11).alias("id"),
        b.le_float32("payload", 15).alias("value"),
        b.le_int32("payload", 19).alias("seconds"),
        b.unsigned_byte("payload", 23).alias("status"),
        b.hex_text("payload").alias("hex"),
        b.strip_header_text(b.hex_text("payload")).alias("body"),
        b.hex_bytes(b.hex_text("payload")).alias("back"),
    ).first()
    assert (row.id, row.seconds, row.status) == (-2, -7, 200)
    assert float_bits(row.value) == float_bits(36.6)
    assert row.hex == payload.hex().upper()
    assert row.body == payload[10:].hex().upper()
    assert bytes(row.back) == payload


def test_unsigned_patterns(spark):
    payload = pack((4294967295, 1.0, 4000000000, 255), signed=False)
    frames = frames_of(spark, payload)
    row = decode_frames(frames).first()
    assert row.id == -1 and row.status == 255
    assert row.real_time == dt.datetime(1960, 8, 27, 8, 38, 24)
    late = decode_frames(frames, unsigned_time=True).first()
    assert late.real_time == dt.datetime(2096, 10, 2, 15, 6, 40)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_times_do_not_depend_on_the_session_zone(spark, session_conf, zone):
    session_conf(spark__sql__session__timeZone=zone)
    seconds = [0, 1710052200, 1710054000, -2147483648, 2147483647]
    frames = frames_of(spark, pack(*[(1, 1.0, s, 0) for s in seconds]))
    texts = [F.col(name).cast("string") for name in ("real_time", "collect_time")]
    got = decode_frames(frames).select(*texts)
    assert [tuple(r) for r in got.collect()] == [
        (text, "2024-12-18 21:41:28")
        for text in (
            "1970-01-01 08:00:00",
            "2024-03-10 14:30:00",
            "2024-03-10 15:00:00",
            "1901-12-14 04:45:52",
            "2038-01-19 11:14:07",
        )
    ]
    west = decode_frames(frames, zone="America/New_York").select(F.col("real_time").cast("string"))
    assert [r[0] for r in west.collect()][:3] == [
        "1969-12-31 19:00:00",
        "2024-03-10 01:30:00",
        "2024-03-10 03:00:00",
    ]


ONE = (17, 36.6, 1734529285, 0)
CASES = {
    "empty": (HEADER, 0, 78, []),
    "one": (pack(ONE), 1, 78, []),
    "full": (pack(*[ONE] * 78), 78, 78, []),
    "ragged": (pack(ONE) + bytes(7), 1, 78, [("ragged_body", 7)]),
    "short": (b"\x01\x02\x03\x04", 0, 78, [("short_header", 4)]),
    "nothing": (b"", 0, 78, [("short_header", 0)]),
    "over": (pack(*[ONE] * 79), 79, 78, []),
    "long and ragged": (pack(*[ONE] * 79) + bytes(12), 79, 78, [("ragged_body", 12)]),
}


@pytest.mark.parametrize("case", CASES)
def test_frame_cases(spark, case):
    payload, strict, padded, rejects = CASES[case]
    frames = frames_of(spark, payload)
    assert decode_frames(frames).count() == strict
    assert decode_frames(frames, padding=BUFFER).count() == padded
    found = frame_rejects(frames).select("reason", F.length("rest")).collect()
    assert [tuple(r) for r in found] == rejects


def test_missing_payload_is_rejected(spark):
    frames = spark.createDataFrame([(1, ARRIVAL, None)], FRAME)
    assert decode_frames(frames).count() == 0
    assert [r.reason for r in frame_rejects(frames).collect()] == ["short_header"]


def test_other_columns_are_carried(spark):
    marks = {"record": F.lit("r"), "tail": F.lit(1)}
    frames = frames_of(spark, pack(ONE)).withColumns(marks)
    row = decode_frames(frames).first()
    assert (row.frame_id, row.record, row.tail, row.id) == (0, "r", 1, 17)


def test_rejected_rest_holds_the_bytes(spark):
    row = frame_rejects(frames_of(spark, pack(ONE) + b"\x09\x08\x07")).first()
    assert bytes(row.rest) == b"\x09\x08\x07"


def test_padded_records_are_zero(spark):
    rows = rows_of(decode_frames(frames_of(spark, pack(ONE)), padding=BUFFER))
    assert rows[0][3] == 17
    zero = dt.datetime(1970, 1, 1, 8)
    assert all(r[3:] == (0, 0.0, zero, 0) for r in rows[1:])


def test_strict_and_padded_agree_after_the_sentinel_filter(spark):
    rng = random.Random(7)
    day_edge = [-28801, -28800, 57599, 57600, 0, 86400]
    payloads = []
    for _ in range(120):
        records = [
            (
                rng.randint(-(2**31), 2**31 - 1),
                struct.unpack("<f", struct.pack("<f", rng.uniform(-1e6, 1e6)))[0],
                rng.choice([*day_edge, rng.randint(-(2**31), 2**31 - 1)]),
                rng.randint(0, 255),
            )
            for _ in range(rng.randint(0, 78))
        ]
        payloads.append(pack(*records))
    frames = frames_of(spark, *payloads)
    strict = rows_of(drop_sentinel(decode_frames(frames)))
    padded = rows_of(drop_sentinel(decode_frames(frames, padding=BUFFER)))
    assert strict == padded and len(strict) > 1000


def test_unknown_padding_is_refused(spark):
    with pytest.raises(ValueError):
        decode_frames(frames_of(spark, HEADER), padding="other")


def test_decode_is_one_compiled_stage_without_a_shuffle(spark, tmp_path, plan_text):
    path = str(tmp_path / "frames")
    frames_of(spark, pack(ONE)).write.parquet(path)
    plan = plan_text(drop_sentinel(decode_frames(read_captures(spark, path))), "simple")
    assert "Exchange" not in plan and "Python" not in plan
    # Three number conversions would mean a record is decoded more than once.
    assert plan.count("conv(") == 2
    operators = [line for line in plan.splitlines() if "+-" in line or line.startswith("*")]
    assert all("*(1)" in line or "FileScan" in line for line in operators)


def test_reject_scan_reads_no_decoded_columns(spark, plan_text):
    plan = plan_text(frame_rejects(frames_of(spark, HEADER)), "simple")
    assert "Generate" not in plan and "Exchange" not in plan


def test_captured_streams_equal_batch(spark, tmp_path):
    captured = str(tmp_path / "frames")
    frames_of(spark, pack(ONE, ONE), pack(ONE)).repartition(2).write.parquet(captured)
    batch = rows_of(decode_frames(read_captures(spark, captured)))
    assert len(batch) == 3
    stream = decode_frames(read_captures(spark, captured, stream=True))
    query = (
        stream.writeStream.format("memory")
        .queryName("captured")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "ck"))
        .start()
    )
    query.awaitTermination()
    assert rows_of(spark.table("captured")) == batch


def test_datagram_files(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"d{n}.bin").write_bytes(pack(*[ONE] * n))
    frames = read_datagram_files(spark, str(tmp_path))
    records = decode_frames(frames)
    assert records.count() == 3
    assert records.columns[0] == "path"
    assert records.filter("collect_time is null").count() == 0


def test_bytes_past_the_buffer_are_rejects(spark):
    over = frames_of(spark, HEADER + b"\x01" * (13 * 79))
    (row,) = frame_rejects(over, BUFFER).collect()
    assert row.reason == "over_length" and len(row.rest) == 13
    assert frame_rejects(frames_of(spark, HEADER, b"ab"), BUFFER).count() == 0


def test_carried_columns_may_not_have_the_names_that_are_made(spark):
    with pytest.raises(ValueError):
        decode_frames(frames_of(spark, HEADER).withColumn("Status", F.lit(1)))
