"""A content-addressed WARC archive: each payload once, under its SHA-256; exact record headers beside them.

Writing never gathers copies: digests are taken where the pages are read, the record that keeps a payload is a maximum per
digest, and only that record's bytes are moved. Reading joins headers to payloads. Each payload is checked there against
the digest that it is stored under, and each record against the SHA-1 in its own header, so neither damaged files nor two
payloads of one digest can pass.

Defined results: a null payload is empty. Of equal payloads of at least ``least_bytes`` bytes the record of the largest id is
the response, the others are revisits of it; smaller payloads are all responses. Nulls count as the smallest ids; rows of
equal id are ordered by payload, and repeated rows are records of their own (``ids.py``). Line breaks in a URL are
written as %0D and %0A. Other columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendframe.llm.ids import keyed
from lendframe.staging import staged
from lendframe.llm.packed import map_batches

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are 32 digits of five bits."""
    digits = F.sha1(payload)
    fives = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*fives), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"\r\n{name}: "), value.cast("string")), F.lit(""))


def _header(date: str) -> Column:
    """Header block of a record, without the empty line that ends it."""
    revisit = F.col("refers_uid").isNotNull()
    return F.encode(F.concat(
        F.lit("WARC/1.1"), _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<urn:record:"), "uid", F.lit(">"))),
        _line("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")),
        _line("WARC-Date", F.lit(date)), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:record:"), "refers_uid", F.lit(">")))),
        _line("Page-ID", F.col("id")), _line("Refers-To-Page-ID", F.when(revisit, F.col("refers_id"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("size")))), "utf-8")


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
                  payload_column: str = "html", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``payloads`` and ``headers`` under ``path``."""
    narrow = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), F.col(payload_column).alias("payload"))
    rows = keyed(narrow, "id", "payload")
    binary = F.coalesce(F.col("value").cast("binary"), F.lit(b""))
    rows = rows.select("uid", "id", F.col("row.url").alias("url"), binary.alias("payload"))
    facts = rows.select("uid", "id", "url", F.unhex(F.sha2("payload", 256)).alias("sha256"), base32_sha1(F.col("payload")).alias("sha1"),
                        F.octet_length("payload").cast("long").alias("size"))
    facts = staged(facts, "record-facts")
    owners = facts.groupBy("sha256").agg(F.max(F.struct("uid", "id")).alias("owner"))
    marked = facts.join(owners, "sha256")
    revisit = (F.col("size") >= least_bytes) & (F.col("uid") != F.col("owner.uid"))
    headers = marked.withColumn("refers_uid", F.when(revisit, F.col("owner.uid"))).withColumn("refers_id", F.when(revisit, F.col("owner.id")))
    headers.select("uid", _header(date).alias("header"), "sha256").write.parquet(f"{path}/headers")
    rows.join(owners.select(F.col("owner.uid").alias("uid"), "sha256"), "uid").select("sha256", "payload").write.parquet(f"{path}/payloads")


def _field(name: str) -> Column:
    found = F.regexp_extract(F.col("header").cast("string"), f"\r\n{name}: ([^\r]*)", 1)
    return F.when(F.contains(F.col("header").cast("string"), F.lit(f"\r\n{name}: ")), found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """All records: ``header``, ``payload`` (the full one, of revisits too), ``record`` (the original bytes), and what the
    header says. Columns that are not used are not moved."""
    stored = spark.read.parquet(f"{path}/payloads").select(
        "sha256", "payload", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"),
        (F.unhex(F.sha2("payload", 256)) == F.col("sha256")).alias("intact"))
    headers = spark.read.parquet(f"{path}/headers").select(
        "header", "sha256", _field("WARC-Type").alias("record_type"), _field("WARC-Target-URI").alias("url"), _field("Page-ID").alias("page_id"),
        _field("Refers-To-Page-ID").alias("refers_to"), _field("WARC-Payload-Digest").alias("said"))
    joined = headers.join(stored, "sha256", "left")
    true = F.coalesce(F.col("intact") & (F.col("said") == F.concat(F.lit("sha1:"), "payload_digest")), F.lit(False))
    digest = F.when(true, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged payload: "), F.hex("sha256"))))
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select("header", "payload", F.concat("header", F.lit(END.encode()), block, F.lit(END.encode())).alias("record"), "record_type", "url",
                         "page_id", "refers_to", "payload_bytes", digest.alias("payload_digest"))


def export_warc(records: DataFrame, path: str) -> None:
    """Write ``record`` bytes as plain WARC files, many records to a file. The writer adds nothing: each record holds its end."""
    body = F.expr(f"substring(record, 1, octet_length(record) - {len(END)})")
    records.select(body.cast("string").alias("value")).write.option("lineSep", END).text(path)


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """``header`` and ``block`` of the records of WARC files; lengths come from the headers, so blocks may hold anything."""
    def run(batches):
        for batch in batches:
            for raw in batch.column("content").to_pylist():
                headers, blocks, at = [], [], 0
                while at < len(raw):
                    end = raw.index(END.encode(), at)
                    header = raw[at:end]
                    size = next(int(x[15:]) for x in header.split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    headers.append(header)
                    blocks.append(raw[end + 4:end + 4 + size])
                    at = end + 8 + size
                yield pa.record_batch([pa.array(headers, pa.binary()), pa.array(blocks, pa.binary())], names=["header", "block"])

    return spark.read.format("binaryFile").load(path).select("content").transform(map_batches, run, "header binary, block binary")


def report(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write the archive to ``path`` and read it back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    kind = pages.schema["page_id"].dataType
    write_archive(pages, path, least_bytes)
    return read_archive(pages.sparkSession, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
