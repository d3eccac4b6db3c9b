"""Content-addressed WARC archive.

Payload bytes are stored once per SHA-256, record headers apart and byte for byte;
joining the two gives the original records. Every digest is taken again from the
stored bytes when an archive is read, so damage or a collision shows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.session import scratch_path

# RFC 4648 base32 letters for the digits that conv() writes, and the
# names that the WARC 1.1 format prescribes.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CRLF = "\r\n"
RECORD_END = "\r\n\r\n"

DATE = "2024-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    """Folders of an archive: ``records`` (headers, digest) and ``payloads`` (digest, bytes)."""

    records: str
    payloads: str


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: eight times twenty bits as four letters."""
    digest = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), _DIGITS, _BASE32)


def page_records(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    date: str = DATE,
) -> DataFrame:
    """WARC records of pages: key, headers (text), digest (SHA-256), payload (bytes).

    Of equal payloads of at least ``min_revisit_bytes`` the largest key is the response
    and the others revisit it; shorter payloads are all responses. A null html is an empty
    payload, a null url leaves the target header out, line ends in a url are escaped. A
    key that occurs twice with the same payload is a response both times; null keys
    rank below all others. Other columns are ignored. ``payload`` is what an
    archive stores: the block of a revisit record itself is empty.
    """
    rows = pages.select(
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    size = F.octet_length("payload")
    narrow = rows.select(
        "key", "url", "digest", size.alias("size"), base32_sha1(F.col("payload")).alias("sha1")
    )
    winners = narrow.groupBy("digest").agg(
        F.max(F.struct("key", "url")).alias("winner"), F.count(F.lit(1)).alias("copies")
    )
    shared = winners.where("copies > 1").select("digest", "winner")
    judged = narrow.join(shared, "digest", "left")
    revisits = (
        F.col("winner").isNotNull()
        & (F.col("size") >= min_revisit_bytes)
        & ~F.col("key").eqNullSafe(F.col("winner.key"))
    )
    return judged.select(
        F.col("key").alias(key),
        "digest",
        _headers(F.col("key"), F.col("url"), F.col("winner"), revisits, date).alias("headers"),
    )


def _record_id(key: Column) -> Column:
    name = F.md5(F.concat(F.lit("page:"), F.coalesce(key.cast("string"), F.lit(""))))
    parts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"),
        F.concat_ws("-", *[F.substring(name, at, n) for at, n in parts]),
        F.lit(">"),
    )


def _headers(key: Column, url: Column, winner: Column, revisits: Column, date: str) -> Column:
    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))

    def target(name: str, value: Column) -> Column:
        safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        return F.coalesce(field(name, safe), F.lit(""))

    record_type = F.when(revisits, "revisit").otherwise("response")
    number = F.coalesce(key.cast("string"), F.lit(""))
    refers = F.concat(
        field("WARC-Profile", F.lit(_REVISIT_PROFILE)),
        field("WARC-Refers-To", _record_id(winner["key"])),
        target("WARC-Refers-To-Target-URI", winner["url"]),
        field("X-Refers-To-Page", F.coalesce(winner["key"].cast("string"), F.lit(""))),
    )
    return F.concat(
        F.lit("WARC/1.1" + _CRLF),
        field("WARC-Type", record_type),
        field("WARC-Record-ID", _record_id(key)),
        field("WARC-Date", F.lit(date)),
        target("WARC-Target-URI", url),
        field("X-Page", number),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        field("WARC-Payload-Length", F.col("size").cast("string")),
        F.when(revisits, refers).otherwise(F.lit("")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisits, "0").otherwise(F.col("size").cast("string"))),
        F.lit(_CRLF),
    )


def write_archive(
    pages: DataFrame, archive: Archive | None = None, *, html: str = "html", **options
) -> Archive:
    """Store payloads once by digest and the headers of all records; the folders written.

    Payloads are grouped before they are written, with a partial step on the map side,
    so a payload that a third of the pages share is moved once per map task.
    """
    if archive is None:
        root = scratch_path(pages.sparkSession, "warc")
        archive = Archive(f"{root}/records", f"{root}/payloads")
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload")
    blobs = pages.select(payload).select(F.sha2("payload", 256).alias("digest"), "payload")
    once = blobs.groupBy("digest").agg(F.first("payload").alias("payload"))
    once.write.option("compression", "zstd").parquet(archive.payloads)
    page_records(pages, html=html, **options).write.parquet(archive.records)
    return archive


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """Stored payloads with facts taken from their bytes; a wrong digest fails the job."""
    stored = spark.read.schema("digest string, payload binary").parquet(archive.payloads)
    damaged = F.sha2("payload", 256) != F.col("digest")
    return stored.select(
        F.when(damaged, F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))))
        .otherwise(F.col("digest"))
        .alias("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )


def read_records(spark: SparkSession, archive: Archive, *, key: str = "page_id") -> DataFrame:
    """Stored headers and the fields parsed from them."""
    stored = spark.read.schema(f"`{key}` long, digest string, headers string").parquet(
        archive.records
    )

    def field(name: str) -> Column:
        return F.regexp_extract("headers", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)

    return stored.select(
        F.expr(f"try_cast({_field_sql('X-Page')} AS BIGINT)").alias(key),
        "digest",
        "headers",
        field("WARC-Type").alias("record_type"),
        F.expr(f"try_cast({_field_sql('X-Refers-To-Page')} AS BIGINT)").alias("refers_to"),
        F.expr(f"substring({_field_sql('WARC-Payload-Digest')}, 6)").alias("stated_digest"),
    )


def _field_sql(name: str) -> str:
    return rf"regexp_extract(headers, '\\r\\n{name}: ([^\\r\\n]*)\\r\\n', 1)"


def read_archive(spark: SparkSession, archive: Archive, *, key: str = "page_id") -> DataFrame:
    """Per record: key, type, what it refers to, and size and digest of its full payload.

    Size and digest come from the stored bytes, before the join, so payloads aren't moved.
    A record without its payload, or whose header states another digest, fails the job.
    """
    facts = read_payloads(spark, archive).select("digest", "payload_bytes", "payload_digest")
    joined = read_records(spark, archive, key=key).join(facts, "digest", "left")
    wrong = ~F.col("payload_digest").eqNullSafe(F.col("stated_digest"))
    return joined.select(
        key,
        "payload_bytes",
        F.when(wrong, F.raise_error(F.concat(F.lit("wrong payload "), F.col("digest"))))
        .otherwise(F.col("payload_digest"))
        .alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def restore_records(spark: SparkSession, archive: Archive, *, key: str = "page_id") -> DataFrame:
    """The original records: key, record (headers, block and record end) and full payload."""
    payloads = read_payloads(spark, archive).select("digest", "payload")
    joined = read_records(spark, archive, key=key).join(payloads, "digest")
    block = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat(F.col("headers").cast("binary"), block, F.lit(RECORD_END.encode()))
    return joined.select(key, record.alias("record"), "payload")


def write_warc_files(
    records: DataFrame, path: str, *, max_records_per_file: int = 100_000
) -> None:
    """Plain WARC files. Records end with the line separator that the writer puts there."""
    end = len(RECORD_END)
    body = F.expr(f"cast(substring(record, 1, octet_length(record) - {end}) AS string)")
    records.select(body.alias("value")).write.option("lineSep", RECORD_END).option(
        "maxRecordsPerFile", max_records_per_file
    ).text(path)
