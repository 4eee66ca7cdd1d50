"""Content-addressed web archive.

``write_archive`` keeps two Parquet tables below one folder:

* ``payloads`` (address, n_bytes, payload): every different payload once, under its
  SHA-256 address,
* ``headers`` (page_id, header, address): the exact header block of one WARC/1.1 record
  for each page - named fields, CRLF line ends, the empty line, and for
  responses the HTTP header - apart from the bytes it describes.

``read_records`` joins them and gives back whole records, byte for byte;
``read_index`` gives one row per record, parsed from the stored header and the
stored payload.  Both check every payload against its address first and fail on a mismatch.

Of records with equal payloads of at least ``revisit_bytes`` bytes the largest page_id
is the response and the others are revisit records that refer to it; shorter payloads are
stored once too, but all their records are responses.

Scale: page metadata (id, address, length) is pre-aggregated per address before the
shuffle; page bytes are shuffled once, by address, after each partition has dropped its repeated payloads, so that a payload
shared by a third of all pages arrives once per partition; only one copy of it is written.  The
join of records with addresses has one row per address on the other side, which adaptive
execution splits where one address is hot.

Defined cases: null html is an empty payload; a null url gives no target field, and control
characters in a url are written as %XX; rows repeated with one page_id and equal
payload are each a response if that is the largest id; a null page_id is never
the largest, and its record is a response only where no other page has the payload (or it is short);
an empty table gives empty tables; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8" + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAYLOADS = "address string, n_bytes long, payload binary"
HEADERS = "page_id long, header string, address string"


def _uri(page: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def _field(name: str, value: F.Column) -> F.Column:
    """A header line; nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(CRLF)), F.lit(""))


def _clean_url(url: F.Column) -> F.Column:
    bad = F.regexp_replace(url, r"\r", "%0D")
    bad = F.regexp_replace(bad, r"\n", "%0A")
    return F.regexp_replace(bad, r"[\x00-\x1F\x7F]", "%20")


def _header(date: str) -> F.Column:
    """The header block of a record with columns page_id, url, n_bytes, sha1, revisit, response."""
    http = F.concat(F.lit(HTTP), F.lit("Content-Length: "), F.col("n_bytes").cast("string"), F.lit(CRLF + CRLF))
    length = F.length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("n_bytes"))
    return F.concat(
        F.lit("WARC/1.1" + CRLF),
        _field("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", _uri(F.col("page_id"))), _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", _clean_url(F.col("url"))),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(F.col("revisit"), F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(F.col("revisit"), _uri(F.col("response")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", length.cast("string")), F.lit(CRLF), http)


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) to the two tables below ``path``."""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    src = src.withColumns({"address": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    meta = src.select("page_id", "url", "address", "n_bytes", F.sha1("payload").alias("sha1"))
    owner = meta.groupBy("address").agg(F.max("page_id").alias("response"))

    # one address, one payload: a partition sends each of its payloads once
    src.select("address", "n_bytes", "payload").dropDuplicates(["address"]).write.parquet(f"{path}/payloads")

    records = meta.join(owner, "address").withColumn(
        "revisit", (F.col("n_bytes") >= revisit_bytes) & F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")))
    records.select("page_id", _header(date).alias("header"), "address").write.parquet(f"{path}/headers")


def _payloads(spark: SparkSession, path: str) -> DataFrame:
    """Stored payloads, each checked against its address."""
    wrong = F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("address")))
    ok = (F.sha2("payload", 256) == F.col("address")) & (F.octet_length("payload") == F.col("n_bytes"))
    return spark.read.schema(PAYLOADS).parquet(f"{path}/payloads").withColumn(
        "payload", F.when(ok, F.col("payload")).otherwise(wrong.cast("binary")))


def _value(name: str) -> F.Column:
    found = F.regexp_extract("header", rf"(?md)^{name}: ([^\r\n]*)\r$", 1)
    return F.when(found != "", found)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: page_id, record (header block, payload of a response, two line ends)."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    joined = headers.join(_payloads(spark, path).select("address", "payload"), "address")
    body = F.when(_value("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("page_id", F.concat(F.encode("header", "UTF-8"), body, F.lit((CRLF * 2).encode())).alias("record"))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest (SHA-1 of the stored payload, hex),
    record_type, refers_to (page id), url.  A header that names another digest or length than its payload fails."""
    headers = spark.read.schema(HEADERS).parquet(f"{path}/headers")
    found = _payloads(spark, path).select("address", F.octet_length("payload").cast("long").alias("payload_bytes"),
                                          F.sha1("payload").alias("payload_digest"))
    kind = _value("WARC-Type")
    said = F.regexp_extract(_value("WARC-Payload-Digest"), "sha1:(.*)", 1)
    out = headers.join(found, "address").withColumn(
        "payload_digest", F.when(said == F.col("payload_digest"), F.col("payload_digest"))
        .otherwise(F.raise_error(F.concat(F.lit("header and payload differ: "), F.col("address"))).cast("string")))
    return out.select(
        F.regexp_extract(_value("WARC-Record-ID"), r"urn:page:(-?[0-9]+)", 1).try_cast("long").alias("page_id"),
        "payload_bytes", "payload_digest", kind.alias("record_type"),
        F.regexp_extract(_value("WARC-Refers-To"), r"urn:page:(-?[0-9]+)", 1).try_cast("long").alias("refers_to"),
        _value("WARC-Target-URI").alias("url"))
