"""WARC archives with revisit resolution.

Headers, not payloads, are shuffled by payload digest: in each group of equal payloads the record
with the smallest key is the original, the others revisit it. Records are then written with fresh
headers, revisits without their payload, and read back, where each revisit is joined to the
response that it refers to by record id.

An archive is written by Spark's text writer: a record is a text whose lines end in CR LF, and the
writer's line separator is the second CR LF that ends a record. So it goes to any store that Spark
can write, a lost task is written again, and records may hold any character.
"""

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitlane.llm.common import stage
from pitlane.sources.tables import shared_dir

#: Payloads of fewer bytes are written every time.
SMALLEST_REVISITED = 100
#: Records per archive file, which bounds what reading one back takes.
RECORDS_PER_FILE = 4096
#: Fixed value: what a revisit of an equal payload declares.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = ("page_id string, record_id string, record_type string, uri string, refers_to_id string, "
         "payload_digest string, payload_bytes long, payload {payload}")
_CHUNK = 1 << 16


def records(pages: DataFrame) -> DataFrame:
    """A record per row: page_id, uri, payload, digest, size. A null page is empty, a null URL too."""
    payload = F.coalesce("html", F.lit(""))
    # A URL with line breaks would forge headers.
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    return pages.select(
        F.col("page_id").alias("page_id"), uri.alias("uri"), payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("long").alias("size"))


def resolve(headers: DataFrame, smallest: int = SMALLEST_REVISITED) -> DataFrame:
    """Distinct headers (page_id, uri, digest, size) and the original of each, or null.

    Adds `original`, a struct of the original's page_id and uri, for all payloads of at least
    `smallest` bytes. The smallest page_id is the original, a null one only if there is no other;
    of equal ones the smallest uri. Groups are reduced before they are shuffled.
    """
    known = headers.groupBy("page_id", "uri", "digest", "size").agg(F.lit(1).alias("__one"))
    order = F.struct(F.col("page_id").isNull(), "page_id", "uri")
    originals = (
        headers.filter(F.col("size") >= smallest).groupBy(F.col("digest").alias("__digest"))
        .agg(F.min(order).alias("__first"))
        .select("__digest", F.struct("__first.page_id", "__first.uri").alias("original"))
    )
    worth = (F.col("digest") == F.col("__digest")) & (F.col("size") >= smallest)
    return known.join(originals, worth, "left").select(
        "page_id", "uri", "digest", "size", "original")


def _urn(page_id: Column, uri: Column, digest: Column, copy: Column, date: str) -> Column:
    """A record id that a task makes again when it is run again."""
    name = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), uri, digest,
                             copy.cast("string"), F.lit(date)))
    parts = [F.substring(name, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def write_archive(pages: DataFrame, path: str, date: str | None = None) -> None:
    """Write every row of pages as a record, equal payloads once.

    Of rows that agree in page_id, URL and payload just one can be the original. Payloads are
    shuffled once, by digest, id and URL, which spreads the copies of a payload.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    full = records(pages)
    resolved = resolve(full.drop("payload"))
    keys = ["digest", "uri", "__id", "__no_id"]
    number = {"__id": F.coalesce(F.col("page_id").cast("string"), F.lit("")), "__no_id": F.col("page_id").isNull()}
    met = full.withColumns(number).join(
        resolved.withColumns(number).drop("page_id", "size"), keys)
    copy = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    first = F.col("original.page_id").eqNullSafe(F.col("page_id")) & (
        F.col("original.uri") == F.col("uri")) & (F.col("copy") == 1)
    revisit = F.col("original").isNotNull() & ~first
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "),
        F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    origin = F.col("original")
    refers = F.concat(
        line("WARC-Profile", F.lit(_PROFILE)),
        line("WARC-Refers-To", F.concat(F.lit("<"), _urn(
            origin["page_id"], origin["uri"], F.col("digest"), F.lit(1), date), F.lit(">"))),
        line("WARC-Refers-To-Target-URI", origin["uri"]),
        line("WARC-Refers-To-Date", F.lit(date)),
    )
    text = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<"), _urn(
            F.col("page_id"), F.col("uri"), F.col("digest"), F.col("copy"), date), F.lit(">"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("uri")),
        line("Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(F.col("revisit"), refers).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(F.col("block")).cast("string")),
        F.lit("\r\n"), F.col("block"), F.lit("\r\n"),
    )
    (
        met.withColumn("copy", copy).withColumn("revisit", revisit).withColumn("block", block)
        .select(text.alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)
    )


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    """Header lines up to the empty one, by lower-case name."""
    found = {}
    while line := stream.readline().rstrip(b"\r\n"):
        name, _, value = line.decode().partition(":")
        found[name.lower()] = value.strip()
    return found


def _parse(stream: io.BufferedReader, payloads: bool) -> Iterator[tuple]:
    """The records of one file; a payload that isn't what its header declares is an error."""
    while version := stream.readline():
        if version.strip() != b"WARC/1.1":
            raise ValueError(f"no record begins with {version[:40]!r}")
        head = _headers(stream)
        end = int(head["content-length"])
        http = []
        while end:
            line = stream.readline()
            end -= len(line)
            http.append(line)
            if not line.strip():
                break
        length = next(int(x.split(b":")[1]) for x in http if x.lower().startswith(b"content-length"))
        declared = head["warc-payload-digest"].partition(":")[2]
        kept, digest, size = [], hashlib.sha256(), end
        while end:
            chunk = stream.read(min(end, _CHUNK))
            if not chunk:
                raise ValueError("a record is cut off")
            end -= len(chunk)
            digest.update(chunk)
            if payloads:
                kept.append(chunk)
        response = head["warc-type"] == "response"
        if response and (digest.hexdigest() != declared or size != length):
            raise ValueError(f"{head['warc-record-id']} is damaged")
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a record doesn't end where it should")
        yield (
            head["page-id"] or None, head["warc-record-id"].strip("<>"), head["warc-type"],
            head["warc-target-uri"], head.get("warc-refers-to", "").strip("<>") or None,
            declared, length, b"".join(kept) if payloads and response else None,
        )


def read_archive(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of an archive: ids, type, URL, what they refer to, digest and size of payloads.

    Files are read whole, one row each, and unpacked piece by piece. The digest of every payload is
    computed again. Payloads themselves come only if asked for.
    """
    schema = _READ.format(payload="binary")
    names = [part.split()[0] for part in schema.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                stream = io.BufferedReader(gzip.open(pa.BufferReader(content.as_buffer())), _CHUNK)
                for row in _parse(stream, payloads):
                    rows.append(row)
                    if len(rows) == (64 if payloads else 4096):
                        yield _batch(rows, names, kinds)
                        rows = []
                if rows:
                    yield _batch(rows, names, kinds)

    found = spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
    return found if payloads else found.drop("payload")


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names)


def follow(found: DataFrame) -> DataFrame:
    """Each record with the page that it refers to, found by record id."""
    responses = found.filter("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to"))
    plain = found.filter("record_type != 'revisit'").withColumn("refers_to", F.lit(None).cast("string"))
    revisits = found.filter("record_type = 'revisit'").join(responses, "refers_to_id", "left")
    return plain.unionByName(revisits)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write all pages to an archive in the shared folder, read it back, and list its records.

    Columns page_id, payload_bytes, payload_digest, record_type, refers_to: one row per row of
    pages. A null page is an empty payload; a null page_id stays null, and a revisit of a record
    without one refers to null. An empty table gives an empty result; other columns are not read.
    """
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    kind = pages.schema["page_id"].dataType
    write_archive(pages, path)
    found = follow(stage(read_archive(spark, path), "warc-records"))
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
