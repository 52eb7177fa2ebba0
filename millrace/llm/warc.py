"""Content-addressed WARC archive.

Two tables: ``payloads`` holds the bytes of every distinct payload once, under two
strong digests and the length; ``headers`` holds, for every record, its exact header
block and the address of its payload. A response record is its header block and its
payload, joined; a revisit record is its header block alone and points at the response.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column, small_side, table, text_or_empty

#: Fixed values of the WARC 1.1 format and of RFC 4648.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
SPARK_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"

ADDRESS = ("sha256", "sha1", "n_bytes")


def base32_sha1(sha1_hex: Column) -> Column:
    """Five hex digits are 20 bits, so four base-32 digits."""
    parts = [
        F.lpad(F.conv(F.substring(sha1_hex, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*parts), SPARK_DIGITS, BASE32_DIGITS)


def _address(payload: Column) -> list[Column]:
    return [
        F.unhex(F.sha2(payload, 256)).alias("sha256"),
        F.unhex(F.sha1(payload)).alias("sha1"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
    ]


def record_id(row_id: Column) -> Column:
    """A name-based UUID in form; the same page gets the same id on every run."""
    h = F.md5(F.concat(F.lit("record:"), F.coalesce(row_id.cast("string"), F.lit(""))))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive are."""

    folder: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/payloads")

    def headers(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/headers")


def write_archive(
    df: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    revisit_from: int = 0,
    date: str = "2024-01-01T00:00:00Z",
) -> Archive:
    """Write one record per row.

    A NULL body is an empty payload. Of rows with equal payloads of ``revisit_from``
    bytes or more, the smallest id is the response and the others revisit it; rows
    that repeat that id are responses too. NULL ids revisit the smallest id there is,
    and are responses where there is none. Rows that repeat an id, and all NULL ids, share
    one record id. Control characters and line ends of any script in a URL are written in
    percent form, as they would end the field; a NULL URL is written as an empty one.
    Columns other than the three named ones are not looked at. An empty table gives an
    empty archive.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "warc-write")
    body = text_or_empty(body_col).cast("binary")
    pages = df.select(
        column(id_col).alias("id"), text_or_empty(url_col).alias("url"), body.alias("payload")
    )
    archive = Archive(folder)
    # Grouped by address, so a payload travels once per task that read it.
    (
        pages.select(*_address(F.col("payload")), "payload")
        .groupBy(*ADDRESS)
        .agg(F.any_value("payload").alias("payload"))
        .write.mode("overwrite")
        .parquet(f"{folder}/payloads")
    )
    rows = scratch.save(pages.select("id", "url", *_address(F.col("payload"))), "rows")
    first = scratch.save(rows.groupBy(*ADDRESS).agg(F.min("id").alias("first_id")), "first")
    # Read from a stored copy, so that AQE can split a payload that most rows have.
    rows = rows.join(small_side(first, scratch.path("first")), list(ADDRESS))
    revisit = (
        (F.col("n_bytes") >= revisit_from)
        & F.col("first_id").isNotNull()
        & ~F.col("id").eqNullSafe(F.col("first_id"))
    )
    rows = rows.withColumn("revisit", revisit)
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    header = F.concat(
        F.lit(VERSION + CRLF),
        field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        field("WARC-Record-ID", record_id(F.col("id"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", _one_line(F.col("url"))),
        field(
            "WARC-Payload-Digest",
            F.concat(F.lit("sha1:"), base32_sha1(F.hex(F.col("sha1")))),
        ),
        F.when(
            F.col("revisit"),
            F.concat(
                field("WARC-Profile", F.lit(REVISIT_PROFILE)),
                field("WARC-Refers-To", record_id(F.col("first_id"))),
                field("WARC-Refers-To-Page", F.col("first_id").cast("string")),
            ),
        ).otherwise(""),
        field(
            "Content-Length",
            F.when(F.col("revisit"), "0").otherwise(F.col("n_bytes").cast("string")),
        ),
        F.lit(CRLF),
    )
    rows.select(F.col("id").alias("record_of"), header.cast("binary").alias("header"), *ADDRESS) \
        .write.mode("overwrite").parquet(f"{folder}/headers")
    scratch.drop("rows", "first")
    return archive


#: The characters that some reader takes for the end of a line, or that
#: cannot be seen.
_UNSAFE = [*map(chr, range(32)), "\x7f", "\x85", "\u2028", "\u2029"]


def _one_line(url: Column) -> Column:
    safe = url
    for c in _UNSAFE:
        safe = F.replace(safe, F.lit(c), F.lit("".join(f"%{b:02X}" for b in c.encode())))
    return F.when(url.rlike(r"[\x00-\x1F\x7F\x85\u2028\u2029]"), safe).otherwise(url)


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original records, byte for byte: ``record_of``, ``record``.

    Only responses meet a payload, and each payload has one response (rows that repeat
    an id aside), so the join has no hot key.
    """
    headers = archive.headers(spark)
    is_revisit = header_field(F.col("header").cast("string"), "WARC-Type") == "revisit"
    end = F.lit(CRLF * 2).cast("binary")
    full = (
        headers.filter(~is_revisit)
        .join(archive.payloads(spark), list(ADDRESS))
        .select("record_of", F.concat("header", "payload", end).alias("record"))
    )
    return full.unionByName(
        headers.filter(is_revisit).select("record_of", F.concat("header", end).alias("record"))
    )


def verify_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every stored payload, read back and hashed anew; fails the job on a difference."""
    stored = archive.payloads(spark)
    same = F.lit(True)
    for old, new in zip(ADDRESS, _address(F.col("payload"))):
        same = same & (F.col(old) == new)
    return stored.withColumn(
        "sha1", F.when(same, F.col("sha1")).otherwise(F.raise_error("payload was damaged"))
    ).select(*ADDRESS)


def header_field(header: Column, name: str) -> Column:
    """A field of a header block. Only CRLF ends a field, whatever its value holds."""
    begin = f"{name}: "
    lines = F.filter(F.split(header, CRLF), lambda line: line.startswith(begin))
    return F.substring(F.get(lines, F.lit(0)), len(begin) + 1, 1 << 30)


def parsed_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The records of ``read_records``, taken apart: ``record_of``, ``header`` (text),
    ``payload`` (the bytes that Content-Length names) and ``rest`` (what follows)."""
    text = F.col("record").cast("string")
    header = F.substring_index(text, CRLF * 2, 1)
    records = read_records(spark, archive).select("record_of", "record", header.alias("header"))
    at = F.octet_length("header") + len(CRLF * 2) + 1
    length = header_field(F.col("header"), "Content-Length").cast("int")
    return records.select(
        "record_of",
        "header",
        F.substring("record", at, length).alias("payload"),
        F.substring("record", at + length, F.lit(1 << 30)).alias("rest"),
    )


def read_index(spark: SparkSession, archive: Archive) -> DataFrame:
    """Per record, what the record itself says once it is put together and read back.

    A response's payload is cut out of its record and hashed; a digest that differs from
    the header's fails the job, as does a record that does not end where its length says.
    A revisit has the digest and length of the response's payload.
    """
    scratch = Scratch(spark, "warc-index")
    records = parsed_records(spark, archive)
    field = lambda name: header_field(F.col("header"), name)
    is_response = field("WARC-Type") == "response"
    digest = F.substring(field("WARC-Payload-Digest"), 6, 32)
    found = base32_sha1(F.sha1("payload"))
    whole = F.col("rest") == F.lit(CRLF * 2).cast("binary")
    fine = whole & (~is_response | (digest == found))
    said = scratch.save(
        records.select(
            F.col("record_of").alias("page_id"),
            F.when(fine, field("WARC-Type")).otherwise(F.raise_error(F.lit("record was damaged"))).alias("record_type"),
            digest.alias("payload_digest"),
            F.when(is_response, F.octet_length("payload").cast("long")).alias("payload_bytes"),
            field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        ),
        "said",
    )
    sizes = said.filter("record_type = 'response'").groupBy("payload_digest").agg(F.max("payload_bytes").alias("bytes"))
    sizes = scratch.save(sizes, "sizes")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    revisits = said.filter("record_type = 'revisit'").drop("payload_bytes")
    revisits = revisits.join(small_side(sizes, scratch.path("sizes")), "payload_digest").withColumnRenamed("bytes", "payload_bytes")
    return said.filter("record_type = 'response'").select(*columns).unionByName(revisits.select(*columns))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = write_archive(table(spark, sf_dir, "pages"), Scratch(spark, "warc").path("archive"))
    return read_index(spark, archive)


def _sql_base32() -> str:
    hexes = "sha1(coalesce(html, ''))"
    digit = (
        f"'{BASE32_DIGITS}'[(('0x' || {hexes}[5 * (i // 4) + 1 : 5 * (i // 4) + 5])::INT"
        " >> (15 - 5 * (i % 4))) % 32 + 1]"
    )
    return f"list_aggregate(list_transform(range(32), lambda i: {digit}), 'string_agg', '')"


ORACLE = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, {_sql_base32()} AS payload_digest FROM pages
), w AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first_id FROM p)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM w
"""
