"""The shared folder that snapshots, checkpoints and trial tables live in."""

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster, a machine-local folder would be lost or invisible to executors.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pointstream-"))
    return context.getCheckpointDir()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared root."""
    return f"{shared_root(spark)}/pointstream/{purpose}-{uuid.uuid4().hex}"


# Small files and folders in the shared store, through the file system that Spark uses.


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds, sorted; none for a folder that is not there."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place))


def put_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet; of two writers, one fails."""
    system, place = _file_system(spark, path)
    out = system.create(place, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _file_system(spark, path)
    body = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(body, "UTF-8")
    finally:
        body.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all that is below it, if it is there."""
    system, place = _file_system(spark, path)
    system.delete(place, True)
