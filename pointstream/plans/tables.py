"""The driver tables seen as readings, frames, messages, dimensions and ledgers.

Every view is row-local: one event becomes one reading, one frame, one message
or one response, so no view needs a shuffle or gathers a group.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pointstream.functions.binary import swap32
from pointstream.functions.once import once
from pointstream.schemas import RECORD_BYTES

# A day that the events cover, used in place of the sentinel day.
TRIAL_SENTINEL = "2024-01-01"
# Run date of the trial pull window.
TRIAL_RUN_DATE = "2024-01-16"

# Most records of a usual frame; of fifty events, one has an empty frame, one a full
# receive buffer and one a record more than that.
USUAL_RECORDS = 4
FULL_RECORDS = 78

# One status code per event type.
STATUS_CODES = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 255}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def status_code() -> Column:
    code = F.lit(None).cast("int")
    for kind, value in STATUS_CODES.items():
        code = F.when(F.col("event_type") == kind, value).otherwise(code)
    return code


def as_readings(events: DataFrame, *keep: str) -> DataFrame:
    """Events as typed readings."""
    return events.select(
        *keep,
        F.col("ts").alias("collect_time"),
        F.col("user_id").cast("int").alias("id"),
        F.col("value").alias("point_value"),
        F.col("ts").alias("real_time"),
        status_code().alias("status"),
    )


def as_records(events: DataFrame, *keep: str) -> DataFrame:
    """Events as decoded records: the value is a FLOAT, as on the wire."""
    return as_readings(events, *keep).withColumn(
        "point_value", F.col("point_value").cast("float")
    )


def point_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as points, their nations as heat stations."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    point = F.col("c_custkey").cast("int")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        point.alias("id"),
        point.alias("point_id"),
        F.col("c_name").alias("point_name"),
        F.col("c_mktsegment").alias("point_index_name"),
        F.col("n_nationkey").alias("heat_station_code"),
        F.col("n_name").alias("heat_station_name"),
        F.col("n_regionkey").alias("area_code"),
    )


def described_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a two-column dimension."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("description")
    )


def priority_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with one row for every order they have: several rows per key, equal ones too."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("point_id"),
        F.col("o_orderpriority").alias("point_index_name"),
    )


def _epoch_seconds(local: Column) -> Column:
    return F.unix_seconds(F.concat(local.cast("string"), F.lit("+00:00")).cast("timestamp"))


def _le_hex(number: Column) -> Column:
    return F.lpad(F.hex(swap32(number)), 8, "0")


def record_count() -> Column:
    """Records in an event's frame: 1 to 4, or 0, 78 or 79."""
    event = F.col("event_id")
    return (
        F.when(event % 50 == 10, 0)
        .when(event % 50 == 21, FULL_RECORDS)
        .when(event % 50 == 32, FULL_RECORDS + 1)
        .otherwise(event % USUAL_RECORDS + 1)
        .cast("int")
    )


def _with_float_bits(events: DataFrame) -> DataFrame:
    """The value's single-precision bits, for zero and positive normal values.

    The logarithm may be off by one beside a power of two, which the next step
    puts right; everything else is exact.
    """
    single, near, exponent = F.col("single"), F.col("near"), F.col("exponent")
    scale = F.pow(F.lit(2.0), near)
    step = F.when(single < scale, -1).when(single >= scale * 2, 1).otherwise(0)
    fraction = (single / F.pow(F.lit(2.0), exponent) - 1) * (1 << 23)
    bits = (exponent + 127) * (1 << 23) + fraction.cast("bigint")
    return (
        events.withColumn("single", F.col("value").cast("float").cast("double"))
        .withColumn("near", F.floor(F.log2(F.when(single > 0, single).otherwise(1.0))))
        .withColumn("exponent", near + step)
        .withColumn("bits", F.when(single == 0, F.lit(0).cast("bigint")).otherwise(bits))
    )


def as_frames(events: DataFrame) -> DataFrame:
    """One datagram per event, with records made from the event's fields.

    Record ``i`` has id ``user_id + i`` (every fourth one a negative id), the
    value as a single (every second one negated), time ``ts + i`` hours (every
    third one time 0, as an unset clock sends) and status ``code + 37 i`` modulo
    256.
    """

    def record(i: Column) -> Column:
        point = F.when(i % 4 == 3, -F.col("user_id") - 1).otherwise(F.col("user_id") + i)
        seconds = F.when(i % 3 == 2, F.lit(0).cast("bigint")).otherwise(
            F.col("seconds") + i * 3600
        )
        return F.concat(
            _le_hex(point),
            F.when(i % 2 == 0, F.col("plus")).otherwise(F.col("minus")),
            _le_hex(seconds),
            F.lpad(F.hex((F.col("code") + i * 37) % 256), 2, "0"),
        )

    # The usual records are written out one by one, as a lambda is not compiled.
    usual = F.concat(*(record(F.lit(i)) for i in range(USUAL_RECORDS)))
    short = usual.substr(F.lit(1), 2 * RECORD_BYTES * F.col("records"))
    every = F.array_join(F.transform(F.sequence(F.lit(0), F.col("records") - 1), record), "")
    body = F.when(F.col("records") <= USUAL_RECORDS, short).otherwise(every)
    header = F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 20)
    arrival = F.concat(F.col("ts").cast("string"), F.lit("+00:00")).cast("timestamp")
    return (
        _with_float_bits(events)
        .select(
            "event_id",
            "user_id",
            arrival.alias("recv_time"),
            _epoch_seconds(F.col("ts")).alias("seconds"),
            status_code().alias("code"),
            record_count().alias("records"),
            _le_hex(F.col("bits")).alias("plus"),
            _le_hex(F.col("bits") + (1 << 31)).alias("minus"),
        )
        .select(
            F.col("event_id").alias("frame_id"),
            "recv_time",
            once(payload=F.unhex(F.concat(header, body))),
        )
    )


def cut_frames(events: DataFrame) -> DataFrame:
    """Frames with some cut short by a rule on the event's number.

    Of ten frames, one keeps 1 to 9 bytes of its header and one loses 1 to 12
    bytes of its last record. Neither is one without records.
    """
    frame = F.col("frame_id")
    size = F.length("payload")
    kept_bytes = (
        F.when(frame % 10 == 3, frame % 9 + 1)
        .when(frame % 10 == 7, size - (frame % 12 + 1))
        .otherwise(size)
    )
    cut = F.col("payload").substr(F.lit(1), kept_bytes.cast("int"))
    return as_frames(events).select("frame_id", "recv_time", once(payload=cut))


def spoiled_messages(messages: DataFrame) -> DataFrame:
    """Messages with some spoiled by a rule on the event's number.

    Every seventh is broken text, every eleventh has a text id, every
    thirteenth lacks all keys but ``id``, every seventeenth is blank.
    """
    event = F.col("event_id")
    value = (
        F.when(event % 7 == 0, F.concat(F.lit("{bad "), F.col("value")))
        .when(event % 11 == 0, F.lit('{"id":"x","status":1}'))
        .when(event % 13 == 0, F.concat(F.lit('{"id":'), event.cast("string"), F.lit("}")))
        .when(event % 17 == 0, F.lit(""))
        .otherwise(F.col("value"))
    )
    # Made once: the parser below would else write each message several times.
    kept = [c for c in messages.columns if c != "value"]
    return messages.select(*kept, once(value=value))


def as_responses(events: DataFrame) -> DataFrame:
    """One ledger response per event, pulled on the day after the event.

    The ``result`` array has 0 to 2 elements; every fifth response has none.
    """

    def element(i: int) -> Column:
        return F.struct(
            F.col("event_id").alias("no"),
            F.lit(i).alias("part"),
            F.col("event_type").alias("kind"),
            F.struct(F.col("user_id").alias("user")).alias("by"),
        )

    parts = (F.col("event_id") % 3).cast("int")
    elements = F.slice(F.array(element(0), element(1)), 1, parts)
    envelope = F.when(F.col("event_id") % 5 == 4, F.lit('{"code":500}')).otherwise(
        F.to_json(F.struct(F.lit(200).alias("code"), elements.alias("result")))
    )
    return events.select(
        "event_id",
        F.date_add(F.to_date(F.substring(F.col("ts").cast("string"), 1, 10)), 1).alias("run_date"),
        once(value=envelope),
    )


def day_responses(events: DataFrame) -> DataFrame:
    """The elements of all events of a day as lines of one response: (run_date, place, line).

    Texts with commas, brackets, quotation marks and backslashes stand in it.
    """
    parts = F.sequence(F.lit(0), (F.col("event_id") % 3).cast("int") - 1)
    some = events.filter("event_id % 5 <> 4 AND event_id % 3 > 0")
    each = some.select("*", F.explode(parts).alias("part")).select(
        F.date_add(F.to_date(F.substring(F.col("ts").cast("string"), 1, 10)), 1).alias("run_date"),
        (F.col("event_id") * 4 + F.col("part")).alias("place"),
        F.to_json(
            F.struct(
                F.col("event_id").alias("no"),
                F.col("part"),
                F.concat(F.col("event_type"), F.lit('],"}\\ {')).alias("kind"),
                F.struct(F.col("user_id").alias("user"), F.array("part", "part").alias("more")).alias("by"),
            )
        ).alias("line"),
    )
    # A day's lines, its head and its tail come out of one shuffle by the day. A union of them
    # counts as dealt by the day as well, but adaptive execution may coalesce its sides apart.
    order = Window.partitionBy("run_date").orderBy("place")
    first, last = F.lag("place").over(order).isNull(), F.lead("place").over(order).isNull()

    def row(place: Column, line: Column) -> Column:
        return F.struct(place.cast("bigint").alias("place"), line.alias("line"))

    head = row(F.lit(-1), F.lit('{"code":200,"note":{"result":[1,2]},"result" : ['))
    tail = row(F.lit(1 << 62), F.lit(']\n,"end":[3,{"result":[4]}]}'))
    own = row(F.col("place"), F.concat(F.when(F.col("first"), "").otherwise(","), "line"))
    rows = F.array(F.when(F.col("first"), head), own, F.when(F.col("last"), tail))
    return (
        each.withColumn("first", first)
        .withColumn("last", last)
        .select("run_date", F.inline(F.filter(rows, lambda r: r.isNotNull())))
    )


def number_responses(events: DataFrame) -> DataFrame:
    """One response per event with figures that a double cannot hold.

    Long decimals, long whole numbers, exponents, escapes and nesting.
    """
    event = F.col("event_id")
    text = F.concat(
        F.lit('{"code":200,"result":[{"long":'),
        (F.lit("12345678901234567890").cast("decimal(28,0)") + event).cast("string"),
        F.lit("."),
        F.lpad((event % 1_000_000_000).cast("string"), 9, "0"),
        F.lit(',"whole":'),
        (F.lit("98765432109876543210").cast("decimal(28,0)") + event).cast("string"),
        F.lit(',"power":'),
        (event % 9 + 1).cast("string"),
        F.lit('e3,"text":"a\\"b\\\\c\\u00e9","deep":{"list":[1.10,{"x":'),
        event.cast("string"),
        F.lit("}]}}]}"),
    )
    return events.select(
        "event_id",
        F.date_add(F.to_date(F.substring(F.col("ts").cast("string"), 1, 10)), 1).alias("run_date"),
        once(value=text),
    )
