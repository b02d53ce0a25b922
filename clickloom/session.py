"""Spark session and the folder for written intermediates."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. Executor counts, memory and cores belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # small shuffle partitions are merged at run time to the advised size
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # a hot user or session is split over several tasks of the join
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # timestamps in this form have row group statistics, so time filters skip row groups
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# Shuffle partitions without a known input, and what one of them should hold at most.
LEAST_PARTITIONS = 200
PARTITION_BYTES = 128 << 20


def shuffle_partitions(input_bytes: int) -> int:
    """Partitions of a shuffle that moves about as much as ``input_bytes``.

    Adaptive execution merges partitions but never makes more, so the number has to fit
    the largest shuffle: 100 TB give about 750,000.
    """
    return max(LEAST_PARTITIONS, -(-input_bytes // PARTITION_BYTES))


def build_session(
    app_name: str,
    master: str | None = None,
    hive: bool = False,
    settings: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Session with :data:`SETTINGS`; ``hive`` reads the tables from a Hive metastore.

    ``input_bytes`` is the size of the largest input and sets the number of shuffle
    partitions; without it Spark's own setting holds.
    """
    sized = {}
    if input_bytes is not None:
        sized["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **sized, **(settings or {})}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def new_work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir`` for tables a job writes and reads back.

    The setting names a folder every executor sees. Only a local session may go
    without it; it gets a temporary folder. A folder goes when its job removes it, or with
    the Python process if the session is still up then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = _local_root()
    folder = f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _made.append((spark, folder))
    return folder


_made: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_work_dirs() -> None:
    for spark, folder in _made:
        if spark.sparkContext._jsc is None:
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="clickloom-")
