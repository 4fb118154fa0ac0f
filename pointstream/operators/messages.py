"""Point records to JSON messages and back, and the sentinel-day filter."""

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import FloatType, StringType, StructField, StructType

from pointstream.functions.once import once
from pointstream.functions.times import outside_day, second_text
from pointstream.schemas import MESSAGE, SENTINEL_DAY

FAIL = "fail"
QUARANTINE = "quarantine"

NON_FINITE = "non_finite"
BAD_MESSAGE = "bad_message"

_RAW = "_raw_message"


def _non_finite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def message_text() -> Column:
    """JSON text of one record; the value is written as the float it is."""
    return F.to_json(
        F.struct(
            second_text("collect_time").alias("collect_time"),
            "id",
            "point_value",
            second_text("real_time").alias("real_time"),
            "status",
        )
    )


def to_messages(records: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Records as one ``value`` column of JSON text, after any columns to keep."""
    finite = records.filter(~F.coalesce(_non_finite(F.col("point_value")), F.lit(False)))
    return finite.select(*(keep or []), message_text().alias("value"))


def non_finite_rejects(records: DataFrame) -> DataFrame:
    """Records whose value JSON cannot hold as a number."""
    return records.filter(_non_finite(F.col("point_value"))).withColumn(
        "reason", F.lit(NON_FINITE)
    )


def through_json(value: Column) -> Column:
    """FLOAT to DOUBLE as its JSON text would give it (0.1, not 0.10000000149)."""
    # Zero, of either sign, is itself in both widths: padding needs no text.
    return F.when(value == 0, value.cast("double")).otherwise(value.cast("string").cast("double"))


def to_readings(records: DataFrame) -> DataFrame:
    """Records typed as messages without writing and parsing the JSON text.

    Gives the rows that ``parse_messages(to_messages(records))`` gives.
    """
    value = F.col("point_value")
    finite = records.filter(~F.coalesce(_non_finite(value), F.lit(False)))
    if records.schema["point_value"].dataType == FloatType():
        return finite.withColumn("point_value", through_json(value))
    return finite


def _parsed(messages: DataFrame, mode: str) -> DataFrame:
    schema = MESSAGE
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        schema = StructType([*MESSAGE.fields, StructField(_RAW, StringType())])
        options["columnNameOfCorruptRecord"] = _RAW
    kept = [c for c in messages.columns if c != "value"]
    message = once(_message=F.from_json("value", schema, options))
    return messages.select(*kept, "value", message)


def parse_messages(messages: DataFrame, on_error: str = FAIL) -> DataFrame:
    """Typed readings of the ``value`` column; other columns are carried along.

    A missing key gives NULL and a NULL value (no message) gives no row. With
    ``on_error="fail"`` a malformed message fails the job; with ``"quarantine"``
    it is left out here and returned by :func:`message_rejects`.
    """
    kept = [c for c in messages.columns if c != "value"]
    message = F.col("_message")
    if on_error == QUARANTINE:
        good = message.isNotNull() & message[_RAW].isNull()
        parsed = _parsed(messages, "PERMISSIVE").filter(good)
    elif on_error == FAIL:
        # FAILFAST itself passes blank text, as a NULL message.
        blank = F.raise_error(F.lit("blank message")).cast("boolean")
        good = F.when(message.isNotNull(), True).when(F.col("value").isNull(), False)
        parsed = _parsed(messages, "FAILFAST").filter(good.otherwise(blank))
    else:
        raise ValueError(f"on_error must be {FAIL!r} or {QUARANTINE!r}, not {on_error!r}")
    return parsed.select(*kept, *[message[name].alias(name) for name in MESSAGE.names])


def mark_messages(messages: DataFrame) -> DataFrame:
    """Messages parsed once, for :func:`marked_readings` and :func:`marked_rejects`."""
    return _parsed(messages, "PERMISSIVE")


def _malformed() -> Column:
    broken = F.col("_message").isNull() | F.col("_message")[_RAW].isNotNull()
    return F.col("value").isNotNull() & broken


def _carried(marked: DataFrame) -> list[str]:
    return [c for c in marked.columns if c not in ("value", "_message")]


def marked_readings(marked: DataFrame) -> DataFrame:
    """Typed readings of the messages that are well formed."""
    fields = [F.col("_message")[name].alias(name) for name in MESSAGE.names]
    good = F.col("_message").isNotNull() & F.col("_message")[_RAW].isNull()
    return marked.filter(good).select(*_carried(marked), *fields)


def marked_rejects(marked: DataFrame) -> DataFrame:
    """The malformed ones: carried columns, ``reason`` and the raw ``value``."""
    rejects = marked.filter(_malformed())
    return rejects.select(*_carried(marked), F.lit(BAD_MESSAGE).alias("reason"), "value")


def message_rejects(messages: DataFrame) -> DataFrame:
    """Malformed messages: carried columns, ``reason`` and the raw ``value``."""
    return marked_rejects(mark_messages(messages))


def drop_sentinel(readings: DataFrame, day: str | dt.date | None = SENTINEL_DAY) -> DataFrame:
    """Readings not dated on the sentinel day; NULL times go too.

    ``day=None`` keeps every reading.
    """
    return readings if day is None else readings.filter(outside_day("real_time", day))
