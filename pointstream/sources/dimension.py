"""Dimension tables, and a snapshot of one that is reloaded by age."""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from pointstream.operators.keyed import BUCKETS, KeyedDimension, write_keyed
from pointstream.operators.lookup import BROADCAST_BYTES, Dimension, measure
from pointstream.schemas import LOOKUP_RETRIES, LOOKUP_TTL_SECONDS, POINT_DIM
from pointstream.storage import shared_folder

Loader = Callable[[SparkSession], DataFrame]


def read_dimension(
    spark: SparkSession, format: str, schema: StructType = POINT_DIM, **options: str
) -> DataFrame:
    """Dimension table from any batch source, in declared columns and types."""
    table = spark.read.format(format).options(**options).load()
    return table.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class StaleDimension(RuntimeError):
    """A dimension could not be loaded, and there is no copy young enough to go on with."""


class DimSnapshot:
    """Holder of a dimension for the micro-batches of one streaming query.

    The loaded table is written to the shared folder and read back from there,
    so changes of the original neither show through nor break a running batch,
    and lost executors cost nothing. It is loaded again once it is ``ttl``
    seconds old. Two folders take turns, so storage stays at two copies.
    ``ttl=0`` loads it for each batch. What is measured is the copy that is joined.

    A load that fails is tried again ``retries`` times, after ``pause`` seconds, then
    twice as many and so on. If it still fails, batches go on with the last good copy
    while that is not older than ``max_age`` seconds (never, if None), and the load is
    tried anew for each of them; else :class:`StaleDimension` is raised.

    With ``key``, a dimension larger than ``keyed_beyond`` bytes is kept by key
    (:class:`KeyedDimension`): a batch then reads only the buckets of its own keys.
    """

    def __init__(
        self,
        loader: Loader,
        ttl: float = LOOKUP_TTL_SECONDS,
        clock: Callable[[], float] = time.monotonic,
        retries: int = LOOKUP_RETRIES,
        pause: float = 1.0,
        max_age: float | None = None,
        sleep: Callable[[float], None] = time.sleep,
        key: str | None = None,
        keyed_beyond: int = BROADCAST_BYTES,
        buckets: int = BUCKETS,
    ):
        self._loader = loader
        self._ttl = ttl
        self._clock = clock
        self._retries = retries
        self._pause = pause
        self._max_age = max_age
        self._sleep = sleep
        self._key = key
        self._keyed_beyond = keyed_beyond
        self._buckets = buckets
        self._folder: str | None = None
        self._loads = 0
        self._loaded_at = 0.0
        self._current: Dimension | KeyedDimension | None = None
        #: Loads that failed for good while an older copy served.
        self.failed_loads = 0

    def current(self, spark: SparkSession) -> "Dimension | KeyedDimension":
        """The dimension to join the next batch with, not older than ``ttl``.

        While it cannot be loaded, not older than ``max_age``.
        """
        now = self._clock()
        if self._current is None or now - self._loaded_at >= self._ttl:
            try:
                self._current = self._load_in_tries(spark)
                self._loaded_at = now
            except Exception as error:
                age = None if self._current is None else self._clock() - self._loaded_at
                if age is None or self._max_age is None or age > self._max_age:
                    raise StaleDimension(f"no dimension to go on with: {error}") from error
                self.failed_loads += 1
        return self._current

    def _load_in_tries(self, spark: SparkSession) -> "Dimension | KeyedDimension":
        for attempt in range(self._retries + 1):
            try:
                return self._load(spark)
            except Exception:
                if attempt == self._retries:
                    raise
                self._sleep(self._pause * 2**attempt)
        raise AssertionError

    def _load(self, spark: SparkSession) -> "Dimension | KeyedDimension":
        if self._folder is None:
            self._folder = shared_folder(spark, "dimension")
        turn = self._loads % 2
        path = f"{self._folder}/copy-{turn}"
        table = self._loader(spark)
        table.write.mode("overwrite").parquet(path)
        copy = measure(spark.read.schema(table.schema).parquet(path))
        if self._key is not None and copy.size_bytes > self._keyed_beyond:
            copy = write_keyed(copy, f"{self._folder}/keyed-{turn}", self._key, self._buckets)
        self._loads += 1
        return copy
