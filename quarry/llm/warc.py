"""Content-addressed WARC archive on two Parquet tables.

``payloads`` holds each payload once under its SHA-256; ``records`` holds the exact
header block of every record with the digest of its payload.  The original records are
rebuilt by a join of the two: a response is its header block, its payload and the closing line
ends; a revisit has no block of its own and gets its payload through its digest.  Digests are computed
anew from the stored bytes whenever they are read.

Of records with equal payloads of at least ``min_revisit_bytes``, the one with the
smallest id is the response and the others are revisits that refer to it; smaller
payloads are always responses.  Stored once they are all the same.

Defined results: a null payload is an empty one; a null url has no target header;
line breaks in a url are percent-encoded, so they can't forge headers; record URIs differ also where
ids repeat or are null; of rows that share the smallest id one is the response, and
a row without an id is one only where no row has an id, its revisits then refer to no key;
an empty table gives an empty archive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import shared_path, stored

DATE = "1970-01-01T00:00:00Z"
SAME_DIGEST = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


@dataclass(frozen=True)
class Archive:
    spark: SparkSession
    path: str

    @property
    def payloads(self) -> DataFrame:
        return self.spark.read.schema("payload_digest string, payload binary").parquet(f"{self.path}/payloads")

    @property
    def records(self) -> DataFrame:
        return self.spark.read.schema("payload_digest string, header binary").parquet(f"{self.path}/records")


def record_uri(row: Column) -> Column:
    """A urn:uuid for the number of a row in the archive, null for null."""
    h = F.md5(F.concat(F.lit("quarry-record:"), row.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(row.isNotNull(), F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">")))


def header_block(*, kind: Column, row: Column, key: Column, url: Column, digest: Column, length: Column, first_row: Column, first_key: Column, date: str = DATE) -> Column:
    """The exact bytes before a record's block, with the empty line.

    A line whose value is null is left out.  ``X-Record-Key`` and ``X-Refers-To-Key`` carry the ids of the
    table, which record URIs can't be turned back to.
    """
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = kind == "revisit"
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value)  # noqa: E731  null for null
    lines = [
        F.lit("WARC/1.1"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", record_uri(row)),
        line("WARC-Target-URI", safe),
        line("WARC-Date", F.lit(date)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        line("WARC-Profile", F.when(revisit, F.lit(SAME_DIGEST))),
        line("WARC-Refers-To", F.when(revisit, record_uri(first_row))),
        line("X-Record-Key", key.cast("string")),
        line("X-Refers-To-Key", F.when(revisit, first_key.cast("string"))),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(length.cast("string"))),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END)).cast("binary")


def write_archive(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 100, date: str = DATE) -> Archive:
    """Write both tables below ``path``.

    Rows are numbered, and their digests written, once; what is decided about them then rests on
    that table of some hundred bytes a row.  Payloads of digests that occur once are written as they are
    read; only those that occur again are reduced to one per digest, before they are shuffled.
    Record headers never meet the payloads here; the first row of each digest that
    occurs again comes back with a join whose hot keys Spark splits.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    digested = pages.select(payload.alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    plain = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("key"), F.col(url_col).cast("string").alias("url"), F.sha2(payload, 256).alias("payload_digest"), F.octet_length(payload).cast("long").alias("length"))
    plain = stored(plain, "rows-and-digests")
    rank = F.struct(F.col("key").isNull().alias("last"), "key", "row")
    first = plain.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(first.where("n > 1").select("payload_digest", F.col("first.row").alias("first_row"), F.col("first.key").alias("first_key")), "first-records")

    again = first.select("payload_digest")
    once = digested.join(again, "payload_digest", "left_anti")
    copied = digested.join(again, "payload_digest", "left_semi").groupBy("payload_digest").agg(F.first("payload").alias("payload"))
    once.select("payload_digest", "payload").unionByName(copied).write.option("compression", "zstd").parquet(f"{path}/payloads")

    typed = plain.join(first, "payload_digest", "left")
    revisit = F.coalesce((F.col("length") >= min_revisit_bytes) & (F.col("row") != F.col("first_row")), F.lit(False))
    kind = F.when(revisit, F.lit("revisit")).otherwise("response")
    header = header_block(kind=kind, row=F.col("row"), key=F.col("key"), url=F.col("url"), digest=F.col("payload_digest"), length=F.col("length"), first_row=F.col("first_row"), first_key=F.col("first_key"), date=date)
    typed.select("payload_digest", header.alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")
    return Archive(spark, path)


def read_records(archive: Archive) -> DataFrame:
    """Every record, rebuilt: (record, payload_digest, payload_bytes).

    ``record`` is the record in WARC form: header block, block, two line ends.  The
    digest and the size are those of the full payload as stored, also for a revisit; a payload
    without the digest it is stored under, or a record without a payload, fails the read.
    """
    stored_digest = F.sha2("payload", 256)
    sound = F.when(stored_digest == F.col("payload_digest"), stored_digest).otherwise(F.raise_error(F.concat(F.lit("payload doesn't match its digest "), F.col("payload_digest"))))
    payloads = archive.payloads.select(F.col("payload_digest").alias("stored_under"), sound.alias("sound_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"), "payload")
    joined = archive.records.join(payloads, F.col("payload_digest") == F.col("stored_under"), "left")
    digest = F.when(F.col("stored_under").isNotNull(), F.col("sound_digest")).otherwise(F.raise_error(F.concat(F.lit("no payload is stored under "), F.col("payload_digest"))))
    block = F.when(F.col("header").cast("string").contains("\r\nWARC-Type: revisit\r\n"), F.lit(b"")).otherwise(F.col("payload"))
    return joined.select(F.concat("header", block, F.lit(END.encode())).alias("record"), digest.alias("payload_digest"), "payload_bytes")


def field(header: Column, name: str) -> Column:
    """The value of a header line, null if there is none."""
    got = F.regexp_extract(F.concat(header, F.lit("\r\n")), f"\\r\\n{name}: ([^\\r\\n]*)\\r\\n", 1)
    return F.when(got != "", got)


def parsed(records: DataFrame) -> DataFrame:
    """(header, block) of each record beside its other columns, from the record's bytes alone.

    The header ends at the first empty line; the block has as many bytes as the header
    says, and after it come two line ends and nothing more, or the read fails.
    """
    head = F.substring_index(F.col("record").cast("string"), END, 1)
    rows = records.withColumn("header", head).withColumn("_at", F.octet_length("header") + len(END))
    rows = rows.withColumn("_n", field(F.col("header"), "Content-Length").cast("int"))
    closed = F.substr(F.col("record"), F.col("_at") + F.col("_n") + 1, F.lit(len(END))) == F.lit(END.encode())
    whole = (F.octet_length("record") == F.col("_at") + F.col("_n") + len(END)) & closed
    block = F.when(whole, F.substr(F.col("record"), F.col("_at") + 1, F.col("_n"))).otherwise(F.raise_error(F.lit("a record's length isn't its header's")).cast("binary"))
    return rows.withColumn("block", block).drop("_at", "_n")


def describe(records: DataFrame, id_col: str = "page_id") -> DataFrame:
    """What the parsed records say of themselves, held against the stored payload."""
    rows = parsed(records)
    said, kind = field(F.col("header"), "WARC-Payload-Digest"), field(F.col("header"), "WARC-Type")
    own = F.when(kind == "revisit", F.octet_length("block") == 0).otherwise(F.octet_length("block") == F.col("payload_bytes"))
    digest = F.when(own & (said == F.concat(F.lit("sha256:"), F.col("payload_digest"))), F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record's header and payload don't agree")))
    return rows.select(
        field(F.col("header"), "X-Record-Key").cast("long").alias(id_col),
        "payload_bytes",
        digest.alias("payload_digest"),
        kind.alias("record_type"),
        field(F.col("header"), "X-Refers-To-Key").cast("long").alias("refers_to"),
    )


def originals(archive: Archive, id_col: str = "page_id") -> DataFrame:
    """(id, url, payload) of every archived row, revisits with their full payload; urls as in the headers."""
    rows = archive.records.join(archive.payloads, "payload_digest")
    head = F.substring_index(F.col("header").cast("string"), END, 1)
    return rows.select(field(head, "X-Record-Key").cast("long").alias(id_col), field(head, "WARC-Target-URI").alias("url"), "payload")


def export_records(records: DataFrame, path: str) -> None:
    """Whole WARC records as rows of a Parquet table; a partition's records, end to end, are a WARC file."""
    records.select("record").write.option("compression", "zstd").parquet(path)


def round_trip(pages: DataFrame, id_col: str = "page_id", **names: str) -> DataFrame:
    path = shared_path(pages.sparkSession, "warc")
    return describe(read_records(write_archive(pages, path, id_col=id_col, **names)), id_col)


__all__ = ["Archive", "describe", "export_records", "originals", "parsed", "read_records", "round_trip", "write_archive"]
