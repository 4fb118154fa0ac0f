"""Lookup join of readings to a dimension, and its result projection."""

from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType, StructType

from pointstream.functions.times import milli_text

if TYPE_CHECKING:
    from pointstream.operators.keyed import KeyedDimension

# Largest dimension to send whole to every executor, as measured row data.
BROADCAST_BYTES = 128 << 20

# Room a row takes in a hash table beside its column data.
_ROW_OVERHEAD = 48
_FIXED_WIDTH = 8


@dataclass(frozen=True)
class Dimension:
    """A dimension table together with its measured size."""

    frame: DataFrame
    rows: int
    size_bytes: int


def _row_width(schema: StructType) -> Column:
    width = F.lit(_ROW_OVERHEAD + _FIXED_WIDTH * len(schema.fields)).cast("bigint")
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif not isinstance(field.dataType, NumericType):
            width = width + F.coalesce(F.octet_length(column.cast("string")), F.lit(0))
    return width


def measure(frame: DataFrame) -> Dimension:
    """Count a dimension's rows and bytes in one aggregate over the table."""
    found = frame.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_width(frame.schema)), F.lit(0)).alias("size_bytes"),
    ).first()
    return Dimension(frame, found["rows"], found["size_bytes"])


def _broadcast_allowed(frame: DataFrame) -> bool:
    """Whether the session allows broadcasts (a threshold of -1 forbids them)."""
    threshold = frame.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return not threshold.strip().startswith("-")


def lookup_join(
    fact: DataFrame,
    dim: "DataFrame | Dimension | KeyedDimension",
    fact_key: str = "id",
    dim_key: str = "point_id",
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Inner equi-join of a fact ``f`` to a dimension ``d``, aliased by these names.

    Facts without a match and NULL keys are dropped; a key with several
    dimension rows gives several results. A plain DataFrame is read once, by the
    join itself: Catalyst and adaptive execution choose by its size. A measured
    dimension of up to ``broadcast_bytes`` (``BROADCAST_BYTES`` unless given) is
    broadcast where the session allows it, so the fact is not shuffled and a hot
    key stays spread over all scan tasks. A larger one is merged: both sides are
    shuffled on the key and adaptive execution splits a skewed partition.
    ``broadcast_bytes=0`` merges any dimension. The rows are the same either way.

    Of a keyed dimension, only the buckets of the fact's own keys are read, and only the
    rows that match are joined as a measured dimension. Its keys are read first, so the
    fact must be a batch.
    """
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if not isinstance(dim, (DataFrame, Dimension)):
        dim = dim.matching(fact, fact_key)
    side = (dim.frame if isinstance(dim, Dimension) else dim).alias("d")
    if isinstance(dim, Dimension) and dim.size_bytes <= limit and _broadcast_allowed(side):
        side = F.broadcast(side)
    elif limit == 0 or isinstance(dim, Dimension):
        side = side.hint("merge")
    return fact.alias("f").join(side, F.col(f"f.{fact_key}") == F.col(f"d.{dim_key}"), "inner")


def enriched(joined: DataFrame) -> DataFrame:
    """The ten result columns, in result-table order, with times as text."""
    return joined.select(
        "d.point_id",
        "d.point_name",
        "f.point_value",
        F.col("f.status").alias("point_status"),
        "d.point_index_name",
        "d.heat_station_code",
        "d.heat_station_name",
        "d.area_code",
        milli_text("f.collect_time").alias("collect_time"),
        milli_text("f.real_time").alias("real_time"),
    )


def described(joined: DataFrame) -> DataFrame:
    """The two result columns of the generated-id lookup."""
    return joined.select("f.id", "d.description")


def total_count(rows: DataFrame) -> DataFrame:
    """Global row count: one row in batch, a running total on a stream."""
    if rows.isStreaming:
        return rows.groupBy().count().select(F.col("count").alias("total"))
    return rows.agg(F.count(F.lit(1)).alias("total"))
