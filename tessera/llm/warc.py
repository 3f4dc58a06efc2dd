"""Content-addressed web archive.

Payload bytes are stored once for each distinct content, under their SHA-256;
the exact header block of every record is stored apart, with the digest that it
points to. Urls are escaped, so none holds a header line of its own. A record
as it was written is its header block and the payload, put together by a join
on the digest; every payload read is hashed again and must have the digest that
it is stored under.

Both parts are Parquet tables in one folder, so any store that Spark writes to
will do and a lost task is written again. export_records gives whole WARC
records for tools that want them: their bytes in order are a valid WARC file.

Of records with equal payloads of at least min_bytes, that with the smallest
page_id is a response record and the others are revisit records that refer to
it; a revisit record has no payload block of its own, but its headers carry the
payload's digest. Null payloads and urls count as empty. Pages without an id
sort last in their group; rows with the same id and payload are told apart by
a running number, and the first is the response. Empty tables make empty
archives; other columns are ignored.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import base32_of_hex, new_path, persist_table

CRLF = "\r\n"
#: Characters that would end a header line for some reader, or that no URI has, and how they are written.
ESCAPES = {c: "".join(f"%{byte:02X}" for byte in c.encode()) for c in (*map(chr, range(0x20)), " ", "\x7f", "\x85", "\u2028", "\u2029")}


def target_uri(url: Column) -> Column:
    """The url with white space and control characters percent-encoded, so that it is one word of one line."""
    out = url
    for character, code in ESCAPES.items():
        out = F.replace(out, F.lit(character), F.lit(code))
    return F.when(url.rlike(r"[\x00-\x20\x7f\x85\u2028\u2029]"), out).otherwise(url)


def record_id(page_id: Column, row: Column) -> Column:
    """A record's URI, of its page and its place among the archive's records; the place alone makes it unique."""
    return F.concat(F.lit("<urn:tessera:page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(":"), row.cast("string"), F.lit(">"))


def header_block(kind: Column, own: Column, url: Column, sha1: Column, length: Column, first: Column, date: Column) -> Column:
    """The header block of a WARC/1.1 record, as UTF-8 text; own and first are record ids."""
    line = lambda key, value: F.concat(F.lit(key + ": "), value, F.lit(CRLF))
    shared = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", own),
        line("WARC-Date", date),
        line("WARC-Target-URI", target_uri(url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
    )
    revisit = F.concat(
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        line("WARC-Refers-To", first),
        line("Content-Length", F.lit("0")),
    )
    return F.concat(shared, F.when(kind == "revisit", revisit).otherwise(line("Content-Length", length.cast("string"))), F.lit(CRLF))


def payload_of(pages: DataFrame) -> Column:
    return F.coalesce(pages["html"].cast("string"), F.lit("")).cast("binary")


def decide(pages: DataFrame, min_bytes: int) -> DataFrame:
    """page_id, url, digests, row, record_type and refers_to (a record id) of every page, without payloads.

    Rows are numbered once, in a written table, since a scan planned again may
    number them otherwise. The response of a content is found by a partial
    minimum for each digest, so a content that very many pages share costs one
    row for each task. The minima are a written table, so that Spark can split
    the join back where one digest has very many rows.
    """
    html = payload_of(pages)
    full = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        F.sha2(html, 256).alias("digest"), base32_of_hex(F.sha1(html)).alias("sha1"), F.octet_length(html).cast("long").alias("payload_bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    full = persist_table(full, "warc-rows")
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    firsts = persist_table(full.groupBy("digest").agg(F.min(place).alias("first")), "warc-firsts")
    found = full.join(firsts, "digest")
    alone = (F.col("payload_bytes") < min_bytes) | (F.col("first.row") == F.col("row"))
    return found.withColumns({
        "record_type": F.when(alone, "response").otherwise("revisit"),
        "refers_to": F.when(~alone, record_id(F.col("first.page_id"), F.col("first.row"))),
    }).drop("first")


def write_archive(pages: DataFrame, min_bytes: int = 0, folder: str | None = None, date: str | None = None) -> str:
    """Write pages (page_id, url, html) as an archive and give its folder.

    date: the records' WARC-Date, as 2024-02-29T12:00:00Z; by default the time of writing, as pages have none.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    records = decide(pages, min_bytes)
    dated = F.lit(date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"))
    own = record_id(F.col("page_id"), F.col("row"))
    block = header_block(F.col("record_type"), own, F.col("url"), F.col("sha1"), F.col("payload_bytes"), F.col("refers_to"), dated)
    records.select("page_id", block.cast("binary").alias("header"), "digest").write.parquet(f"{folder}/records")
    html = payload_of(pages)
    contents = pages.select(F.sha2(html, 256).alias("digest"), html.alias("payload"))
    contents.dropDuplicates(["digest"]).write.parquet(f"{folder}/payloads")
    return folder


def open_archive(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Records (page_id, header, digest) and payloads (digest, payload) of an archive."""
    records = spark.read.schema("page_id long, header binary, digest string").parquet(f"{folder}/records")
    return records, spark.read.schema("digest string, payload binary").parquet(f"{folder}/payloads")


def verified(payloads: DataFrame) -> DataFrame:
    """Payloads, after checking that each still has its digest."""
    good = F.sha2("payload", 256) == F.col("digest")
    return payloads.withColumn("payload", F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), "digest")).cast("binary")))


def header(name: str) -> Column:
    """A header's value, or null: a line is what stands between two CRLF and nothing else."""
    value = F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def export_records(spark: SparkSession, folder: str) -> DataFrame:
    """page_id and record: the bytes of each WARC record as written; revisit records have an empty block."""
    records, payloads = open_archive(spark, folder)
    joined = records.join(verified(payloads), "digest", "left")
    missing = F.raise_error(F.concat(F.lit("missing payload "), "digest")).cast("binary")
    block = F.when(header("WARC-Type") == "response", F.coalesce("payload", missing)).otherwise(F.lit(b""))
    return joined.select("page_id", F.concat("header", block, F.lit(b"\r\n\r\n")).alias("record"))


def read_archive(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to from an archive's own bytes.

    Length and digest are taken from the stored payload that the record leads
    to, and must agree with the header. payloads adds the full payload of every
    page; without it, only lengths and digests go through the join.
    """
    records, stored = open_archive(spark, folder)
    own = verified(stored).select(
        "digest", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_of_hex(F.sha1("payload")).alias("payload_digest"), *["payload"] * payloads
    )
    page = lambda value: F.regexp_extract(value, r"^<urn:tessera:page:(-?\d+):\d+>$", 1)
    joined = records.select(
        "page_id", "digest", header("WARC-Type").alias("record_type"), header("WARC-Payload-Digest").alias("_said"),
        F.when(page(header("WARC-Refers-To")) != "", page(header("WARC-Refers-To"))).cast("long").alias("refers_to"),
    ).join(own, "digest", "left")
    agreed = F.when(F.col("_said") == F.concat(F.lit("sha1:"), "payload_digest"), F.col("payload_digest")).otherwise(F.raise_error(F.lit("payload missing or not as the header says")))
    return joined.select("page_id", "payload_bytes", agreed.alias("payload_digest"), "record_type", "refers_to", *["payload"] * payloads)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, upper(sha1(b)) AS x, min(page_id) OVER (PARTITION BY sha256(b)) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda g: array_to_string(list_transform(range(0, 4), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(x, (5 * g + 1)::INT, 5))::BIGINT >> (15 - 5 * k)::INT) % 32)::INT, 1)), '')), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM h
"""
