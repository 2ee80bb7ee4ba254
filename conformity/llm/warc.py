"""Content-addressed WARC archive: each payload stored once, record headers kept apart, joined on reading.

An archive is a folder with two tables:

* ``objects``: payload bytes once per SHA-256 digest;
* ``records``: per record its identity, its exact header block (WARC and HTTP headers, bytes), the digest
  of its payload and whether the record itself carries the payload.

``read_archive`` verifies every object against its digest and length, and joins headers to objects; a
record's bytes in a WARC file are ``header || payload || CRLF CRLF`` (the payload only for responses).

Of the records whose payloads are equal and at least ``min_bytes`` long, the one with the smallest page_id
is a response and the others are revisits that refer to it; all smaller ones are responses. A null html is
an empty payload, a null url an empty target, line ends of any kind in a url are percent-encoded in the header
(the ``url`` column keeps it exactly); a null page_id sorts after all others; among rows with the
smallest page_id repeated, one (the first by url) is the response. An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, scratch_path

CRLF = "\r\n"
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: One archive's date, so that the same pages give the same bytes.
DATE = "2024-01-01T00:00:00Z"
#: Characters that some reader of headers takes for a line's end, and what a target URI has in their place.
ESCAPED = {c: "".join(f"%{b:02X}" for b in c.encode()) for c in "\r\n\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: four groups of 40 bits, eight digits each."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), BASE32_HEX, BASE32)


def _one_line(url: Column) -> Column:
    for c, escape in ESCAPED.items():
        url = F.replace(url, F.lit(c), F.lit(escape))
    return F.coalesce(url, F.lit(""))


def _headers(kind: Column) -> Column:
    """The exact header block of a record, ending with the blank line before the payload."""
    revisit = kind == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(CRLF * 2),
    )
    length = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    named = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", named(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", _one_line(F.col("url"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT_PROFILE)), line("WARC-Refers-To", named(F.col("refers_to"))))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(pages: DataFrame, folder: str, min_bytes: int = 0) -> None:
    """Archive ``pages`` (page_id, url, html) under ``folder``."""
    prepare(pages.sparkSession)
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    narrow = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload).alias("payload_digest"),
        F.sha2(payload, 256).alias("digest"),
    )
    narrow.write.parquet(f"{folder}/staged")
    staged = pages.sparkSession.read.parquet(f"{folder}/staged")
    # payloads move once, straight into the writer's tasks: no group of equal payloads is ever collected
    firsts = staged.groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", F.coalesce("url", F.lit("")).alias("url"))).alias("first"),
        F.count(F.lit(1)).alias("copies"),
    )
    kept = pages.select(payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    kept.groupBy("digest").agg(F.first("payload").alias("payload")).write.option("compression", "zstd").parquet(f"{folder}/objects")
    # rows equal in page_id and url are told apart only among the repeats of a first record
    same = (F.col("page_id").eqNullSafe(F.col("first.page_id"))) & (F.coalesce("url", F.lit("")) == F.col("first.url"))
    joined = staged.join(firsts.where("copies > 1"), "digest", "left").withColumn("leads", F.col("first").isNotNull() & same)
    leaders = joined.where("leads").withColumn("turn", F.row_number().over(Window.partitionBy("digest").orderBy("page_id")))
    others = joined.where("NOT leads").withColumn("turn", F.when(F.col("first").isNull(), 1).otherwise(2))
    marked = leaders.unionByName(others)
    kind = F.when((F.col("turn") > 1) & (F.col("payload_bytes") >= min_bytes), "revisit").otherwise("response")
    marked = marked.withColumn("record_type", kind).withColumn("refers_to", F.when(F.col("record_type") == "revisit", F.col("first.page_id")))
    marked.select(
        "page_id", "url", "digest", "payload_bytes", F.encode(_headers(F.col("record_type")), "UTF-8").alias("header")
    ).write.parquet(f"{folder}/records")


def read_archive(spark, folder: str) -> DataFrame:
    """Records with header, payload and what both verify to: page_id, header, payload, payload_bytes,
    payload_digest (of the stored bytes). A record whose object is missing or damaged fails the job."""
    objects = spark.read.parquet(f"{folder}/objects")
    checked = objects.select(
        F.when(F.sha2("payload", 256) == F.col("digest"), F.col("digest")).otherwise(F.raise_error(F.lit("payload does not match its digest"))).alias("digest"),
        "payload",
        F.length("payload").cast("long").alias("stored_bytes"),
        base32_sha1(F.col("payload")).alias("stored_digest"),
    )
    records = spark.read.parquet(f"{folder}/records")
    joined = records.join(checked, "digest", "left")
    sound = F.coalesce(F.col("stored_bytes") == F.col("payload_bytes"), F.lit(False))
    return joined.select(
        "page_id",
        "url",
        "header",
        "payload",
        F.when(sound, F.col("stored_bytes")).otherwise(F.raise_error(F.lit("payload is missing")).cast("long")).alias("payload_bytes"),
        F.col("stored_digest").alias("payload_digest"),
    )


def field(name: str) -> Column:
    """A named field of a record's WARC header; lines end with CRLF and nothing else."""
    return F.nullif(F.regexp_extract(F.decode("header", "UTF-8"), rf"(?md)^{name}: (.*)\r$", 1), F.lit(""))


def record_bytes(records: DataFrame) -> DataFrame:
    """``records`` with the exact bytes of each record as in a WARC file, in ``record``."""
    body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat(F.col("header"), body, F.lit(b"\r\n\r\n")))


def archive_report(records: DataFrame) -> DataFrame:
    """What rebuilt records say: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A response's payload is cut out of the record's own bytes and digested; a revisit has none, so that its
    payload is the object it was joined with.
    """
    rebuilt = record_bytes(records).withColumns({"record_type": field("WARC-Type"), "of": field("WARC-Refers-To")})
    carried = F.substring(F.col("record"), F.length("header") + 1, F.length("record") - F.length("header") - len(CRLF * 2))
    held = rebuilt.withColumn("held", F.when(F.col("record_type") == "response", carried).otherwise(F.col("payload")))
    revisited = F.regexp_extract("of", r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return held.select(
        "page_id",
        F.length("held").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("held")).alias("payload_digest"),
        "record_type",
        F.when(F.col("record_type") == "revisit", revisited).alias("refers_to"),
    )


def op4_warc_archive(spark, sf_dir: str) -> DataFrame:
    """Archive all pages, read the archive back, rebuild every record and report from it."""
    folder = scratch_path(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    return archive_report(read_archive(spark, folder))


OP4_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
digits AS (
  SELECT h, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((g.v >> (35 - 5 * k)) & 31 AS INTEGER), 1), '' ORDER BY i, k) AS d
  FROM (SELECT DISTINCT h, i, CAST(concat('0x', substr(h, 1 + 10 * i, 10)) AS BIGINT) AS v FROM p, range(4) r(i)) g, range(8) s(k)
  GROUP BY h)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM p JOIN digits USING (h)
"""
