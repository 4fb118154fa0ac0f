"""Datagram frames to point records.

A frame is a 10-byte header and then 13-byte records: little-endian int32 id,
float32 value and int32 epoch seconds, and an unsigned status byte. The decode
is narrow: one scan, one ``explode``, column expressions, no shuffle and no
Python worker.
"""

from pyspark.sql import Column, DataFrame, functions as F

from pointstream.functions.binary import (
    float32_of_bits,
    packed_word,
    signed32,
    swap32,
    unsigned_word,
)
from pointstream.functions.once import once
from pointstream.functions.times import local_arrival, local_time
from pointstream.schemas import BUFFER_BYTES, DEVICE_ZONE, HEADER_BYTES, RECORD, RECORD_BYTES

STRICT = "strict"
BUFFER = "buffer"

SHORT_HEADER = "short_header"
RAGGED_BODY = "ragged_body"
OVER_LENGTH = "over_length"


def _framed(frames: DataFrame, padding: str) -> DataFrame:
    if padding == STRICT:
        return frames
    if padding == BUFFER:
        received = F.substring("payload", 1, BUFFER_BYTES)
        return frames.withColumn(
            "payload", F.rpad(received, BUFFER_BYTES, F.lit(bytes(1)))
        )
    raise ValueError(f"padding must be {STRICT!r} or {BUFFER!r}, not {padding!r}")


def _record_positions() -> Column:
    # sequence(0, -1) counts down, so a frame without records needs its own branch.
    records = F.expr(f"int((length(payload) - {HEADER_BYTES}) div {RECORD_BYTES})")
    return F.when(records > 0, F.sequence(F.lit(0), records - 1)).otherwise(
        F.array().cast("array<int>")
    )


def decode_frames(
    frames: DataFrame,
    padding: str = STRICT,
    zone: str = DEVICE_ZONE,
    unsigned_time: bool = False,
) -> DataFrame:
    """One row per whole record of each frame.

    ``frames`` has ``payload BINARY`` and ``recv_time TIMESTAMP``; other columns
    are carried along. ``padding="strict"`` decodes the bytes that arrived.
    ``padding="buffer"`` decodes a fixed 1024-byte receive buffer: longer frames
    are cut, shorter ones end in zero records dated 1970-01-01 in the zone.
    ``unsigned_time`` reads the seconds as unsigned, for times from 2038 on.
    """
    made = {name.lower() for name in RECORD.names}
    clash = [c for c in frames.columns if c.lower() in made]
    if clash:
        raise ValueError(f"frames carry columns that the decode makes: {clash}")
    kept = [c for c in frames.columns if c not in ("payload", "recv_time")]
    arrived = F.length("payload").alias("_arrived")
    collect_time = local_arrival("recv_time", zone).alias("collect_time")
    records = (
        _framed(frames.select("*", arrived), padding)
        .select(*kept, "_arrived", "payload", collect_time)
        .select("*", F.explode(_record_positions()).alias("record_seq"))
    )
    start = F.col("record_seq") * RECORD_BYTES + HEADER_BYTES + 1
    # Records that are padding alone are zero without a look at their bytes.
    padding_only = start > F.col("_arrived")

    def word(value: Column) -> Column:
        return value if padding == STRICT else F.when(padding_only, 0).otherwise(value)

    # Two number conversions per record: id and value in one 8-byte word, time
    # and status in one 5-byte word. The fields are then integer arithmetic.
    words = records.select(
        *kept,
        "collect_time",
        "record_seq",
        "_arrived",
        F.col("payload").substr(start, F.lit(RECORD_BYTES)).alias("_record"),
    ).select(
        *kept,
        "collect_time",
        "record_seq",
        word(packed_word("_record", 1)).alias("_head"),
        word(unsigned_word("_record", 9, 5)).alias("_tail"),
    )
    fields = words.select(
        *kept,
        "collect_time",
        "record_seq",
        swap32(F.shiftright("_head", 32)).alias("_id_bits"),
        swap32(F.col("_head")).alias("_value_bits"),
        swap32(F.shiftright("_tail", 8)).alias("_time_bits"),
        F.col("_tail").bitwiseAND(0xFF).alias("_status_bits"),
    )
    seconds = F.col("_time_bits")
    record = once(
        id=signed32(F.col("_id_bits")).cast("int"),
        point_value=float32_of_bits(F.col("_value_bits")),
        real_time=local_time(seconds if unsigned_time else signed32(seconds), zone),
        status=F.col("_status_bits").cast("int"),
    )
    return fields.select(*kept, "record_seq", "collect_time", record)


def frame_rejects(frames: DataFrame, padding: str = STRICT) -> DataFrame:
    """Frames, or ends of frames, that the decode leaves out, with a reason.

    ``short_header``: no payload, or fewer bytes than a header; ``rest`` is all.
    ``ragged_body``: bytes left after the last whole record; ``rest`` is those
    bytes, while the whole records of that frame are still decoded.
    ``over_length``, with ``padding="buffer"``: ``rest`` is the bytes past the
    receive buffer. There, short and ragged frames end in zeros and are decoded.
    """
    size = F.coalesce(F.length("payload"), F.lit(0))
    kept = [c for c in frames.columns if c != "payload"]
    if padding == BUFFER:
        cut = F.col("payload").substr(F.lit(BUFFER_BYTES + 1), size - BUFFER_BYTES)
        over = frames.filter(size > BUFFER_BYTES)
        return over.select(*kept, F.lit(OVER_LENGTH).alias("reason"), cut.alias("rest"))
    rest = F.pmod(size - HEADER_BYTES, F.lit(RECORD_BYTES))
    reason = F.when(size < HEADER_BYTES, SHORT_HEADER).when(rest != 0, RAGGED_BODY)
    left = F.when(size < HEADER_BYTES, size).otherwise(rest)
    return frames.filter((size < HEADER_BYTES) | (rest != 0)).select(
        *kept,
        reason.alias("reason"),
        F.col("payload").substr(size - left + 1, left).alias("rest"),
    )
