"""Content-addressed WARC archive.

Three tables make an archive: ``payloads`` holds every payload once under its SHA-256;
``responses`` and ``revisits`` hold, for every record of either type, its exact WARC and HTTP
header bytes and the address of its payload. A record is put together again by a join on the
address. Payloads and responses are bucketed by it, so that join shuffles no payload.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import full_text, join_hot

# Fixed values of the formats: the base32 alphabet of RFC 4648, the revisit profile of WARC/1.1.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RADIX_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
END = b"\r\n\r\n"
HEADS = "address string, warc_head binary, http_head binary"
PAYLOADS = "address string, payload binary"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of bytes, 32 characters: 20 bits give four each."""
    digits = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), RADIX_32, BASE32)


def _field(name: str, value: Column) -> Column:
    """One header line; none where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _plain(value: Column) -> Column:
    """Line breaks would end a header line: they are percent-encoded."""
    return F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write one record per row of ``pages`` below ``folder``.

    Of records whose payloads are equal and have at least ``min_bytes`` bytes, that of the
    smallest id is a ``response`` and the others are ``revisit`` records that refer to it;
    shorter payloads are all responses. Each payload is stored once in any case.

    A null html is an empty payload, a null url leaves out WARC-Target-URI. A null id is
    above every other and leaves out Source-Id. Rows that repeat the smallest id are all
    responses. Very long payloads are stored whole. Other columns are not read, whatever their
    names. An empty table gives an archive without records.
    """
    records = pages.select(
        F.col(id_col).alias("id"),
        F.col(url).cast("string").alias("url"),
        F.encode(full_text(html), "UTF-8").alias("payload"),
    ).withColumn("address", F.sha2("payload", 256))
    described = records.select(
        "id",
        "url",
        "address",
        F.octet_length("payload").alias("bytes"),
        base32_sha1(F.col("payload")).alias("digest"),
    )
    first = records.groupBy("address").agg(F.min("id").alias("first_id"))
    again = (F.col("bytes") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col(
        "id"
    ).eqNullSafe(F.col("first_id"))
    http_head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )

    def name(of: str) -> Column:
        ident = F.coalesce(F.col(of).cast("string"), F.lit("none"))
        return F.concat(F.lit("<urn:x-page:"), ident, F.lit(":"), F.col("address"), F.lit(">"))

    block = F.octet_length("http_head") + F.when(F.col("again"), 0).otherwise(F.col("bytes"))
    warc_head = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", name("id")),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _plain(F.col("url"))),
        _field("Source-Id", _plain(F.col("id").cast("string"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _field("WARC-Refers-To", F.when(F.col("again"), name("first_id"))),
        _field("Refers-To-Source-Id", F.when(F.col("again"), F.col("first_id").cast("string"))),
        _field("WARC-Profile", F.when(F.col("again"), F.lit(SAME_PAYLOAD))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit("\r\n"),
    )
    heads = (
        join_hot(described, first, "address")
        .withColumns({"again": again, "http_head": http_head})
        .select(
            "again",
            "address",
            F.encode(warc_head, "UTF-8").alias("warc_head"),
            F.encode("http_head", "UTF-8").alias("http_head"),
        )
    )
    # equal payloads meet in their map task first, so a hot one is shuffled once per task
    payloads = records.groupBy("address").agg(F.first("payload").alias("payload"))
    write_tables(heads, payloads, folder)


def write_tables(heads: DataFrame, payloads: DataFrame, folder: str) -> None:
    """Write the tables of an archive: heads tell by ``again`` which of them are revisits.

    There are as many buckets as shuffle partitions, so that those already made by the
    grouping of payloads are written as they are.
    """
    spark = heads.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heads.where("again").drop("again").write.parquet(f"{folder}/revisits")
    responses = heads.where("NOT again").drop("again").repartition(buckets, "address")
    for rows, name in ((responses, "responses"), (payloads, "payloads")):
        table = f"warc_{uuid.uuid4().hex}"
        rows.write.bucketBy(buckets, "address").option("path", f"{folder}/{name}").format(
            "parquet"
        ).saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{folder}/layout")


def _bucketed(spark: SparkSession, folder: str, name: str, columns: str, buckets: int) -> DataFrame:
    """A bucketed table of an archive; the name it has for Spark goes at once."""
    table = f"warc_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (address) INTO {buckets}"
        f" BUCKETS LOCATION '{folder}/{name}'"
    )
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return rows


def _value(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def _number(head: Column, name: str) -> Column:
    return _value(head, name).cast("long")


def _sound(test: Column, value: Column, trouble: str) -> Column:
    """``value``, or an error that names the address if ``test`` does not hold."""
    wrong = F.raise_error(F.concat(F.lit(f"{trouble} "), F.col("address")))
    return F.when(F.coalesce(test, F.lit(False)), value).otherwise(wrong)


def _named(heads: DataFrame, id_type: str) -> DataFrame:
    """Heads with the fields of their bytes."""
    head, http = F.decode("warc_head", "UTF-8"), F.decode("http_head", "UTF-8")
    return heads.select(
        "*",
        _value(head, "Source-Id").cast(id_type).alias("id"),
        _value(head, "WARC-Target-URI").alias("url"),
        _value(head, "WARC-Type").alias("record_type"),
        _value(head, "Refers-To-Source-Id").cast(id_type).alias("refers_to"),
        _value(head, "WARC-Payload-Digest").alias("named"),
        _number(head, "Content-Length").alias("block_bytes"),
        _number(http, "Content-Length").alias("body_bytes"),
        (F.octet_length("warc_head") + F.octet_length("http_head")).alias("heads_bytes"),
    )


def read_archive(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """The records below ``folder``, rebuilt: their fields and their exact bytes.

    Columns ``id``, ``url``, ``record_type``, ``refers_to`` (the id of the response),
    ``payload_bytes``, ``payload_digest``, ``record`` (WARC header, block, two line ends).
    A response is joined with its payload; size and digest are those of the payload cut out of
    the rebuilt record again, by the lengths its headers state. A revisit has them from the
    rebuilt response of its address. A payload that does not give its address, a missing
    payload, and a header whose digest or length is not that of its record are errors.
    """
    (buckets,) = spark.read.schema("buckets int").parquet(f"{folder}/layout").first()
    heads = _bucketed(spark, folder, "responses", HEADS, buckets)
    stored = _bucketed(spark, folder, "payloads", PAYLOADS, buckets)
    revisits = spark.read.schema(HEADS).parquet(f"{folder}/revisits")

    # a head without its payload is an error, hence the outer join
    met = _named(heads, id_type).join(stored, "address", "left")
    payload = _sound(F.sha2("payload", 256) == F.col("address"), F.col("payload"), "no sound payload")
    rebuilt = met.withColumn("record", F.concat("warc_head", "http_head", payload, F.lit(END)))
    # what stands between the headers and the end, if the block is as long as its header says
    size = F.octet_length("record") - F.col("heads_bytes") - len(END)
    stated = (F.col("body_bytes") == size) & (
        F.col("block_bytes") == size + F.octet_length("http_head")
    )
    cut = F.substring("record", F.col("heads_bytes") + 1, F.col("body_bytes").cast("int"))
    cut = _sound(stated, cut, "wrong Content-Length at")
    rebuilt = rebuilt.select(
        "*", F.octet_length(cut).cast("long").alias("payload_bytes"), base32_sha1(cut).alias("found")
    )
    agreed = F.col("named") == F.concat(F.lit("sha1:"), F.col("found"))
    responses = rebuilt.withColumn(
        "payload_digest", _sound(agreed, F.col("found"), "wrong digest at")
    )
    known = responses.groupBy("address").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    again = join_hot(_named(revisits, id_type), known, "address", how="left")
    plain = F.concat("warc_head", "http_head", F.lit(END))
    agreed = (F.col("named") == F.concat(F.lit("sha1:"), F.col("payload_digest"))) & (
        F.col("block_bytes") == F.octet_length("http_head")
    )
    again = again.withColumns(
        {
            "record": plain,
            "payload_digest": _sound(agreed, F.col("payload_digest"), "wrong revisit of"),
        }
    )
    columns = ["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "record"]
    return responses.select(columns).unionByName(again.select(columns))
