"""A content-addressed WARC archive: payload bytes once, exact record headers apart.

An archive is a folder with two Parquet tables. ``payloads`` holds each distinct payload once,
under its SHA-256. ``records`` holds, per page, the exact bytes of the record's WARC header and
HTTP header, and the SHA-256 of its payload. A join of both gives every record back byte for
byte. Payloads of equal SHA-256 must agree in length and SHA-1, and a payload read back must have
the SHA-256 it is stored under; otherwise the job fails.

Choosing which copy is the response works on digests alone and aggregates before it shuffles.
Payload bytes move once, when the one copy that is stored is singled out; verification and the
digests of the stored bytes are computed where the payloads are read, before any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.sources import save, scratch_path, store

# Line ends, the date of all records, and from which size on copies are revisits.
CRLF = "\r\n"
DATE = "2020-01-01T00:00:00Z"
REVISIT_BYTES = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page: Column) -> Column:
    digest = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit(""))))
    parts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    uuid = F.concat_ws("-", *(F.substring(digest, at, n) for at, n in parts))
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def _header(name: str, value: Column) -> Column:
    """A header line, nothing where the value is NULL; line ends inside are percent-encoded."""
    safe = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def write_archive(pages: DataFrame, path: str) -> None:
    """Write ``pages`` (``page_id``, ``url``, ``html``) as an archive to the new folder ``path``.

    Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with the largest
    ``page_id`` is a response and the others are revisits that refer to it; smaller ones are
    responses each. NULL html is an empty payload; NULL url leaves its header out; pages with a
    NULL ``page_id`` rank below all others and have no page header. Rows that repeat a
    ``page_id`` with the same payload are responses each. No rows give an empty archive. Other
    columns are not read.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    index = store(
        pages.select(
            "page_id",
            "url",
            F.unhex(F.sha2(payload, 256)).alias("payload_key"),
            F.sha1(payload).alias("sha1"),
            F.octet_length(payload).cast("long").alias("payload_bytes"),
        ),
        "warc_index",
    )
    stored = index.groupBy("payload_key").agg(
        F.max("page_id").alias("stored_id"),
        F.max_by("url", F.struct("page_id", "url")).alias("stored_url"),
        F.min(F.struct("payload_bytes", "sha1")).alias("least"),
        F.max(F.struct("payload_bytes", "sha1")).alias("most"),
    )
    chosen = store(
        stored.select(
            "payload_key",
            "stored_id",
            "stored_url",
            F.assert_true(
                F.col("least") == F.col("most"), F.lit("payloads of equal SHA-256 differ")
            ).alias("verified"),
        ),
        "warc_chosen",
    )
    # Copies within a task leave it as one row; which of the equal payloads is kept is all one.
    payloads = (
        pages.select(payload.alias("payload"))
        .groupBy(F.unhex(F.sha2("payload", 256)).alias("payload_key"))
        .agg(F.first("payload").alias("payload"))
    )
    save(payloads, f"{path}/payloads", "parquet")
    records = index.join(chosen, "payload_key")
    revisit = (F.col("payload_bytes") >= REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(
        F.col("stored_id")
    )
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF),
        F.lit("Content-Type: text/html; charset=utf-8" + CRLF),
        _header("Content-Length", F.col("payload_bytes").cast("string")),
        F.lit(CRLF),
    )
    block = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("payload_bytes"))
    warc = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Date", F.lit(DATE)),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _header("WARC-Profile", F.when(F.col("revisit"), PROFILE)),
        _header("WARC-Refers-To", F.when(F.col("revisit"), _record_id(F.col("stored_id")))),
        _header("WARC-Refers-To-Target-URI", F.when(F.col("revisit"), F.col("stored_url"))),
        _header("WARC-Refers-To-Date", F.when(F.col("revisit"), DATE)),
        _header("X-Page-ID", F.col("page_id").cast("string")),
        _header(
            "X-Refers-To-Page-ID", F.when(F.col("revisit"), F.col("stored_id").cast("string"))
        ),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    written = (
        records.withColumn("revisit", revisit)
        .withColumn("http", http)
        .select(
            F.encode(warc, "UTF-8").alias("warc_header"),
            F.encode("http", "UTF-8").alias("http_header"),
            "payload_key",
        )
    )
    save(written, f"{path}/records", "parquet")


def _fields(header: Column) -> Column:
    """Header lines of a record as a map."""
    text = F.decode(header, "UTF-8")
    lines = F.substr(text, F.lit(1), F.char_length(text) - 2 * len(CRLF))
    return F.str_to_map(lines, F.lit(CRLF), F.lit(": "))


def _verified(key: str, value: Column) -> Column:
    """``value``, computed from ``payload``, if the payload has the digest it is stored under."""
    whole = F.unhex(F.sha2("payload", 256)) == F.col(key)
    return F.when(whole, value).otherwise(
        F.raise_error(F.lit("a stored payload does not have its digest"))
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ``page_id``, ``payload_bytes``, ``payload_digest`` (SHA-1 of the full
    payload as stored, which must be the header's), ``record_type``, ``refers_to``, ``url`` (with
    line ends percent-encoded), ``record_id``.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "payload_key",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        _verified("payload_key", F.sha1("payload")).alias("sha1"),
    )
    records = spark.read.parquet(f"{path}/records").select(
        "payload_key", _fields(F.col("warc_header")).alias("field")
    )
    same = F.concat(F.lit("sha1:"), F.col("sha1")) == F.col("field")["WARC-Payload-Digest"]
    return records.join(payloads, "payload_key").select(
        F.col("field")["X-Page-ID"].cast("long").alias("page_id"),
        "payload_bytes",
        F.when(same, F.col("sha1"))
        .otherwise(F.raise_error(F.lit("a payload does not have the digest of its record")))
        .alias("payload_digest"),
        F.col("field")["WARC-Type"].alias("record_type"),
        F.col("field")["X-Refers-To-Page-ID"].cast("long").alias("refers_to"),
        F.col("field")["WARC-Target-URI"].alias("url"),
        F.col("field")["WARC-Record-ID"].alias("record_id"),
    )


def reconstruct(spark: SparkSession, path: str) -> DataFrame:
    """The bytes of every WARC record, ``record``, with its ``page_id``: both headers as written,
    then the payload if the record is a response, then two line ends.
    """
    records = spark.read.parquet(f"{path}/records").withColumn(
        "field", _fields(F.col("warc_header"))
    )
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "payload_key", _verified("payload_key", F.col("payload")).alias("payload")
    )
    response = F.col("field")["WARC-Type"] == "response"
    body = F.when(response, F.col("payload")).otherwise(F.lit(b""))
    return records.join(payloads, "payload_key").select(
        F.col("field")["X-Page-ID"].cast("long").alias("page_id"),
        F.concat("warc_header", "http_header", body, F.encode(F.lit(2 * CRLF), "UTF-8")).alias(
            "record"
        ),
    )


def new_archive(pages: DataFrame) -> str:
    """Write ``pages`` to a new archive in the shared scratch folder; returns its path."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return path
