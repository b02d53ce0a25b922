"""Ad click log lines: ``epoch_millis province city user_id ad_id``, single spaces."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_KEYS = ("ts", "user_id", "ad_id")

# Years 1 to 9999.
_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)

# How far a click's time may lie after its arrival: clocks differ by less.
AHEAD = "1 DAY"


def parse_ad_log(
    lines: DataFrame,
    column: str = "value",
    arrival: str | None = None,
    ahead: str = AHEAD,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Adds typed columns to the lines; a field that cannot be read is null.

    A time that no calendar has, or that lies more than ``ahead`` after the line's arrival,
    cannot be read either. ``arrival`` names the column with the time a line arrived;
    without it that is the time of the query or micro-batch. Works on batch and streaming
    input. The line itself stays, for rejected rows, and so do the columns in ``keep``.
    """
    fields = F.split(F.col(column).cast("string"), " ")
    millis = F.get(fields, F.lit(0)).try_cast("bigint")
    arrived = F.current_timestamp() if arrival is None else F.col(arrival)
    readable = millis.between(*_MILLIS) & (
        F.timestamp_millis(F.when(millis.between(*_MILLIS), millis))
        <= arrived + F.expr(f"INTERVAL {ahead}")
    )
    return lines.select(
        F.col(column).cast("string").alias("line"),
        F.timestamp_millis(F.when(readable, millis)).alias("ts"),
        F.get(fields, F.lit(1)).alias("province"),
        F.get(fields, F.lit(2)).alias("city"),
        F.get(fields, F.lit(3)).try_cast("bigint").alias("user_id"),
        F.get(fields, F.lit(4)).try_cast("bigint").alias("ad_id"),
        *keep,
    )


def valid_clicks(parsed: DataFrame) -> DataFrame:
    """Clicks whose time, user and ad could be read."""
    return parsed.dropna(subset=list(_KEYS)).drop("line")


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """The lines :func:`valid_clicks` leaves out."""
    missing = F.lit(False)
    for key in _KEYS:
        missing = missing | F.col(key).isNull()
    return parsed.where(missing).select("line")


def format_ad_log(clicks: DataFrame) -> DataFrame:
    """Clicks back to log lines, as the single column ``value``."""
    return clicks.select(
        F.concat_ws(
            " ",
            F.unix_millis("ts"),
            F.col("province").cast("string"),
            F.col("city").cast("string"),
            F.col("user_id").cast("string"),
            F.col("ad_id").cast("string"),
        ).alias("value")
    )


def kafka_options(servers: str, topics: Iterable[str] | str, **extra: str) -> dict[str, str]:
    """Reader options; ``topics`` is a comma list or several names."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": names,
        "startingOffsets": "latest",
        **extra,
    }


def read_kafka_lines(
    spark: SparkSession, servers: str, topics: Iterable[str] | str, **extra: str
) -> DataFrame:
    """Streaming log lines of the topics, with the time Kafka took each in ``timestamp``.

    Needs the Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **extra))
    return reader.load().select(
        F.col("key").cast("string"), F.col("value").cast("string"), "timestamp"
    )


def read_file_lines(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Streaming log lines of text files that appear below ``path``."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
