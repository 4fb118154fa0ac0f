"""A large dimension kept by key, so that a micro-batch reads only what it looks up.

The copy lies in bucket folders by a hash of the key, and in a bucket's files rows are
sorted by key, so that a reader skips row groups by their bounds. A lookup takes the
distinct keys of the batch, reads their buckets' folders only (others are not even
listed), and keeps the rows whose key is asked for. The dimension is neither shuffled nor
sorted for it, and what goes on to the join is as large as the batch's own lookups, not as
the dimension.
"""

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pointstream.operators.lookup import BROADCAST_BYTES, Dimension, measure
from pointstream.storage import names, remove, shared_folder

BUCKETS = 1024
_BUCKET = "key_bucket"


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class KeyedDimension:
    """A dimension written by key: its folder, key, columns, buckets and measured size."""

    spark: SparkSession
    path: str
    key: str
    schema: StructType
    buckets: int
    filled: frozenset[int]
    rows: int
    size_bytes: int

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets; only their folders are listed and read."""
        some = sorted(self.filled if buckets is None else self.filled.intersection(buckets))
        if not some:
            return self.spark.createDataFrame([], self.schema)
        folders = [f"{self.path}/{_BUCKET}={b}" for b in some]
        return self.spark.read.schema(self.schema).parquet(*folders)

    def matching(self, fact: DataFrame, fact_key: str, folder: str | None = None) -> Dimension:
        """The rows whose key occurs in a batch, measured; written to the given folder.

        The distinct keys are written first: at most the rows of the batch, and one number
        per bucket reaches the driver. Up to ``BROADCAST_BYTES`` of keys go to every task
        that scans the buckets; more are joined by a merge.
        """
        folder = folder or shared_folder(self.spark, "matching")
        key = F.col(f"`{fact_key}`").cast(self.schema[self.key].dataType)
        asked = fact.select(key.alias("asked_key")).filter("asked_key IS NOT NULL").distinct()
        keys = _written(asked, f"{folder}/asked")
        size = measure(keys)
        if not size.rows:
            return Dimension(self.read([]), 0, 0)
        buckets = keys.select(_bucket("asked_key", self.buckets).alias("b")).distinct().collect()
        bounds = keys.agg(F.min("asked_key").alias("low"), F.max("asked_key").alias("high")).first()
        near = self.read([r["b"] for r in buckets]).filter(
            F.col(f"`{self.key}`").between(bounds["low"], bounds["high"])
        )
        side = keys.hint("broadcast" if size.size_bytes <= BROADCAST_BYTES else "merge")
        found = near.join(side, F.col(f"`{self.key}`") == F.col("asked_key"), "left_semi")
        # Written, as it is both measured and joined.
        return measure(_written(found, f"{folder}/found"))


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def looked_up(dim: "Dimension | KeyedDimension", fact: DataFrame, fact_key: str):
    """A micro-batch and what it is joined to, while its result is written.

    For a keyed dimension the batch is kept, as its keys are read before its rows, and
    what was found for it is removed at the end.
    """
    if isinstance(dim, Dimension):
        yield fact, dim
        return
    folder, rows = shared_folder(dim.spark, "matching"), fact.persist()
    try:
        yield rows, dim.matching(rows, fact_key, folder)
    finally:
        rows.unpersist()
        remove(dim.spark, folder)


def write_keyed(
    dim: Dimension, path: str, key: str, buckets: int = BUCKETS
) -> KeyedDimension:
    """Write a measured dimension by key and return its keyed form.

    Rows without a key match nothing and are left out. A bucket that holds a key with very
    many rows is split over tasks and files.
    """
    frame = dim.frame
    spark = frame.sparkSession
    keyed = frame.filter(F.col(f"`{key}`").isNotNull()).withColumn(_BUCKET, _bucket(key, buckets))
    (
        keyed.hint("rebalance", F.col(_BUCKET))
        .sortWithinPartitions(_BUCKET, f"`{key}`")
        .write.mode("overwrite")
        .partitionBy(_BUCKET)
        .parquet(path)
    )
    filled = [n.partition("=")[2] for n in names(spark, path) if n.startswith(f"{_BUCKET}=")]
    return KeyedDimension(
        spark, path, key, frame.schema, buckets, frozenset(map(int, filled)), dim.rows, dim.size_bytes
    )
