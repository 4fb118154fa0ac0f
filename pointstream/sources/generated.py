"""Generated ids for trials of the lookup: repeatable for a given row number."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pointstream.functions.binary import ColumnOrName, _col
from pointstream.functions.times import processing_time
from pointstream.schemas import GENERATED_HIGH, GENERATED_LOW


def generated_id(
    row_number: ColumnOrName, low: int = GENERATED_LOW, high: int = GENERATED_HIGH
) -> Column:
    """Evenly spread id in ``[low, high]``; the same row number gives the same id."""
    digest = F.md5(_col(row_number).cast("string").cast("binary"))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (draw % (high - low + 1) + low).cast("int")


def generated_ids(
    rows: DataFrame,
    row_number: str,
    low: int = GENERATED_LOW,
    high: int = GENERATED_HIGH,
) -> DataFrame:
    """Ids for the row numbers of any table, with the processing time."""
    return rows.select(
        generated_id(row_number, low, high).alias("id"), processing_time().alias("proctime")
    )


def generate_batch(spark: SparkSession, rows: int, **bounds: int) -> DataFrame:
    """A bounded run of generated ids."""
    return generated_ids(spark.range(rows), "id", **bounds)


def generate_stream(spark: SparkSession, rows_per_second: int = 10_000, **bounds: int) -> DataFrame:
    """An unbounded stream of generated ids."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return generated_ids(ticks, "value", **bounds)
