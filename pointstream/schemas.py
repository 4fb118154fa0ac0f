"""Fixed schemas and fixed values of the point-telemetry data model."""

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Datagram layout, device zone, sentinel day, lookup cache life and
# retries, and the range of the generated ids.
HEADER_BYTES = 10
RECORD_BYTES = 13
BUFFER_BYTES = 1024
DEVICE_ZONE = "Asia/Shanghai"
SENTINEL_DAY = "1970-01-01"
LOOKUP_TTL_SECONDS = 24 * 3600
LOOKUP_RETRIES = 3
GENERATED_LOW = 1
GENERATED_HIGH = 10


def _struct(**fields: type[DataType]) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in fields.items()])


FRAME = _struct(frame_id=LongType, recv_time=TimestampType, payload=BinaryType)

RECORD = _struct(
    record_seq=IntegerType,
    collect_time=TimestampNTZType,
    id=IntegerType,
    point_value=FloatType,
    real_time=TimestampNTZType,
    status=IntegerType,
)

MESSAGE = _struct(
    collect_time=TimestampNTZType,
    id=IntegerType,
    point_value=DoubleType,
    real_time=TimestampNTZType,
    status=IntegerType,
)

POINT_DIM = _struct(
    id=IntegerType,
    point_id=IntegerType,
    point_name=StringType,
    point_index_name=StringType,
    heat_station_code=IntegerType,
    heat_station_name=StringType,
    area_code=IntegerType,
)

ENRICHED = _struct(
    point_id=IntegerType,
    point_name=StringType,
    point_value=DoubleType,
    point_status=IntegerType,
    point_index_name=StringType,
    heat_station_code=IntegerType,
    heat_station_name=StringType,
    area_code=IntegerType,
    collect_time=StringType,
    real_time=StringType,
)

GENERATED = _struct(id=IntegerType, description=StringType)

LEDGER = _struct(cm=StringType, content=StringType)

COUNT = _struct(total=LongType)
