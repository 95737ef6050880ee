"""A content-addressed WARC archive: payloads once by digest, exact record heads apart."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreworks.sinks.files import shared_dir

#: Smallest payload that a later record may refer to instead of holding it.
MIN_SHARED_BYTES = 0
#: WARC-Date of pages whose time of capture is not given.
NO_DATE = datetime(1970, 1, 1)
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: RFC 4648
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value


class DamagedPayloadError(ValueError):
    """A stored payload has not the digest that is its address."""


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32 without a prefix: five hex digits give four characters."""
    digest = F.sha1(payload)
    letters = F.lit(_BASE32)

    def four(i: Column) -> Column:
        bits = F.conv(F.substring(digest, i * 5 + 1, 5), 16, 10).cast("bigint")
        return F.concat(
            *[F.substring(letters, (F.shiftright(bits, 5 * k).bitwiseAND(F.lit(31).cast("bigint")) + 1).cast("int"), 1) for k in (3, 2, 1, 0)]
        )

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def _record_id(number: Column) -> Column:
    """A URN of the record's id; null without one."""
    return F.concat(F.lit("<urn:page:"), number.cast("string"), F.lit(">"))


def _own_id(number: Column, url: Column, digest: Column) -> Column:
    """A record without an id is named by its URL and payload."""
    named = F.sha2(F.concat_ws(" ", digest, url), 256)
    return F.coalesce(_record_id(number), F.concat(F.lit("<urn:content:"), named, F.lit(">")))


def _one_line(url: Column) -> Column:
    """A URL whose line breaks are percent-encoded, so that it can't end its line of the head."""
    return F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")


def _head(
    record_type: Column, page_id: Column, url: Column, digest: Column, refers: Column, length: Column, date: datetime
) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = record_type == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", record_type),
        line("WARC-Record-ID", _own_id(page_id, url, digest)),
        F.lit(f"WARC-Date: {date:%Y-%m-%dT%H:%M:%SZ}\r\n"),
        F.coalesce(line("WARC-Target-URI", _one_line(url)), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}\r\n")).otherwise(F.lit("")),
        F.when(revisit, line("WARC-Refers-To", _record_id(refers))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html\r\n"),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
    ).cast("binary")


def write_archive(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    min_shared: int = MIN_SHARED_BYTES,
    date: datetime = NO_DATE,
) -> None:
    """Write one record per page under ``path``: ``payloads`` and ``records``.

    ``payloads`` holds each distinct payload once, addressed by its SHA-256, written by the record
    with the largest id among equal ones. ``records`` holds each record's exact head and that
    address. The record that wrote a payload of ``min_shared`` bytes or more is the response, the
    others are revisits of it with an empty block; records with smaller payloads are all responses.

    A null payload is empty. Null ids count as smallest; where all ids of equal payloads are null
    all are responses, and so are rows that repeat the largest id. A null URL leaves its line out,
    line breaks in a URL are percent-encoded, and a null id is replaced by a name from URL and
    payload, which repeated rows share. ``date`` (UTC) is the records' WARC-Date.
    Equal payloads combine in the reading tasks, so payload bytes move once, and a payload that
    many pages share hardly at all.
    """
    payload = F.coalesce(F.col(payload_col).cast("string").cast("binary"), F.lit(b""))
    named = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    )
    addressed = named.withColumn("address", F.sha2("payload", 256))
    once = addressed.groupBy("address").agg(F.first("payload").alias("payload"), F.max("id").alias("owner"))
    once.write.parquet(f"{path}/payloads")
    owners = pages.sparkSession.read.parquet(f"{path}/payloads").select("address", "owner")
    keyed = addressed.select(
        "id", "url", "address", base32_sha1(F.col("payload")).alias("sha1"),
        F.octet_length("payload").cast("bigint").alias("bytes"),
    )
    own = F.col("id").eqNullSafe(F.col("owner")) | (F.col("bytes") < F.lit(min_shared))
    kind = F.when(own, F.lit("response")).otherwise(F.lit("revisit"))
    records = keyed.join(owners, "address").withColumn("type", kind)
    length = F.when(F.col("type") == "response", F.col("bytes")).otherwise(F.lit(0))
    head = _head(F.col("type"), F.col("id"), F.col("url"), F.col("sha1"), F.col("owner"), length, date)
    records.select(head.alias("head"), "address").write.parquet(f"{path}/records")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("head").cast("string"), rf"(?m)^{name}: (.*)$", 1)
    return F.when(found != "", found)


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    """What the heads say: type, ids, digest and length of each record, without any payload."""
    number = lambda name: F.regexp_extract(_field(name), r"^<urn:page:(-?\d+)>$", 1).try_cast("bigint")
    return spark.read.parquet(f"{path}/records").select(
        "head",
        "address",
        _field("WARC-Type").alias("record_type"),
        number("WARC-Record-ID").alias("id"),
        number("WARC-Refers-To").alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        _field("Content-Length").cast("bigint").alias("block_bytes"),
    )


def verified_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads with their length, each hashed again; a wrong one stops the job."""
    stored = spark.read.parquet(f"{path}/payloads")
    whole = F.sha2("payload", 256) == F.col("address")
    message = F.concat(F.lit("damaged payload "), F.col("address"))
    checked = F.when(whole, F.col("payload")).otherwise(F.raise_error(message).cast("binary"))
    return stored.select(
        "address", checked.alias("payload"), F.octet_length(checked).cast("bigint").alias("payload_bytes"),
        base32_sha1(checked).alias("found_digest"),
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record's type, reference, digest and full length, the payloads verified."""
    sizes = verified_payloads(spark, path).drop("payload")
    return _agreeing(read_heads(spark, path).join(sizes, "address"))


def _agreeing(records: DataFrame) -> DataFrame:
    """Records whose head states the digest that the payload has; another one stops the job."""
    stated = F.col("payload_digest")
    wrong = F.raise_error(F.concat(F.lit("damaged payload or head "), F.col("address"))).cast("string")
    return records.withColumn("payload_digest", F.when(stated == F.col("found_digest"), stated).otherwise(wrong))


def rebuild_records(spark: SparkSession, path: str) -> DataFrame:
    """The original records byte by byte, with the payload that a revisit stands for beside it."""
    parts = _agreeing(read_heads(spark, path).join(verified_payloads(spark, path), "address"))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return parts.select(
        "id", "record_type", "payload_digest", "payload", F.concat(F.col("head"), block, F.lit(b"\r\n\r\n")).alias("record")
    )


def archive_pages(pages: DataFrame, **columns: str) -> DataFrame:
    """Write an archive of pages in the shared folder and read it back."""
    path = shared_dir(pages.sparkSession, "warc")
    write_archive(pages, path, **columns)
    return read_archive(pages.sparkSession, path)
