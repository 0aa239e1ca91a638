"""WARC archives of pages: one dictionary for all records, each record compressed on its own.

A file is a leading skippable frame that holds the Zstandard dictionary, then one frame for each record. Spark's
text sink writes the files: a frame is the value of a row, and the line separator is an empty skippable frame, which
every Zstandard reader passes over. So the files are committed like any other output of Spark, on any file system it
knows, and a lost executor leaves no half-written file. Reading splits the files at the same separator, so a long
file is read by many tasks.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import SLICE_ROWS, stored
from riskloom.session import scratch_path

# Frame marks of the compressed WARC format, and its profile of a revisit.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads from this many bytes on are archived once; copies refer to it.
REVISIT_BYTES = 1000
#: Records that the dictionary is built from: at most so many, of at most so many bytes each and together.
SAMPLE_RECORDS, SAMPLE_RECORD_BYTES, SAMPLE_BYTES = 2000, 1 << 17, 1 << 23
DICTIONARY_BYTES = 112_640
LEVEL = 3
#: Pages carry no time of their own. A fixed one lets a task that runs again write the same bytes.
DATE = "1970-01-01T00:00:00Z"

_RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long"
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def _payload() -> Column:
    return F.coalesce(F.col("html"), F.lit("")).cast("binary")


def plan_records(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records to write, and one row for each different payload.

    Of equal payloads of at least ``REVISIT_BYTES`` the row with the largest page_id is the response and the others
    revisit it. Rows that share that largest id cannot be told apart and are all responses, and so are copies
    that have no page_id at all. Only the digests are grouped; the pages meet the payloads that occur more than once.
    """
    rows = _rows(pages)
    payloads = stored(
        rows.groupBy("digest").agg(
            F.max("page_id").alias("head"), F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("payload")).alias("bytes")
        )
    )
    # stored, so that its size is known: where it is small the payloads are not shuffled
    heads = stored(payloads.filter((F.col("copies") > 1) & (F.col("bytes") >= REVISIT_BYTES)).select("digest", "head"))
    records = rows.join(heads, "digest", "left").withColumn(
        "refers_to", F.when((F.col("page_id") < F.col("head")) | F.col("page_id").isNull(), F.col("head"))
    )
    return records.select("page_id", "url", "payload", "digest", "refers_to"), payloads


def _rows(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), _payload().alias("payload")
    )
    return rows.withColumn("digest", F.sha1("payload"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha1(f'{page_id}:{digest}'.encode()).hexdigest()[:32])}>"


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP header of the payload alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    label = base64.b32encode(bytes.fromhex(digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{label}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            f"WARC-Profile: {REVISIT_PROFILE}",
            f"WARC-Refers-To: {record_id(refers_to, digest)}",
            f"Refers-To-Page-ID: {refers_to}",
        ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_bytes() -> bytes:
    """The record at the start of each file that says what it holds."""
    block = b"format: WARC File Format 1.1\r\nsoftware: riskloom\r\n"
    head = [
        "WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(None, hashlib.sha1(block).hexdigest())}",
        f"WARC-Date: {DATE}", "Content-Type: application/warc-fields", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(pages: DataFrame, payloads: DataFrame) -> bytes | None:
    """A Zstandard dictionary built in one task from a bounded sample of the records to archive.

    The sample takes different payloads in the order of a hash, until one of the bounds is reached. None where there are
    too few records to build one.
    """
    size = F.sum("bytes").over(_running())
    chosen = (
        payloads.filter(F.col("bytes").between(1, SAMPLE_RECORD_BYTES))
        .select("digest", "bytes", F.xxhash64("digest").alias("at"))
        .orderBy("at", "digest")
        .limit(SAMPLE_RECORDS)
        .withColumn("total", size)
        .filter(F.col("total") <= SAMPLE_BYTES)
        .select("digest")
    )
    sample = (
        _rows(pages)
        .join(F.broadcast(chosen), "digest")  # at most SAMPLE_RECORDS digests
        .groupBy("digest")
        .agg(F.max(F.struct("page_id", "url", "payload")).alias("one"))
        .select("one.*", "digest")
    )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = []
        for batch in batches:
            for row in batch.to_pylist():
                texts.append(record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], None))
        texts.sort()
        room = min(DICTIONARY_BYTES, sum(map(len, texts)) // 8)
        try:
            made = [zstandard.train_dictionary(room, texts, k=512, d=8).as_bytes()]
        except (zstandard.ZstdError, ValueError):
            made = []
        yield pa.record_batch([pa.array(made, pa.binary())], ["dictionary"])

    first = sample.coalesce(1).mapInArrow(train, "dictionary binary").first()
    return bytes(first["dictionary"]) if first else None


def _running():
    from pyspark.sql import Window

    # at most SAMPLE_RECORDS rows
    return Window.orderBy("at", "digest").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def compress(text: bytes, dictionary: zstandard.ZstdCompressionDict | None, coders: dict) -> bytes:
    """One frame. It never holds the separator: another level is taken in the unheard-of case that it would."""
    for level in [LEVEL, *range(1, 20)]:
        if level not in coders:
            coders[level] = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_checksum=True)
        frame = coders[level].compress(text)
        if SEPARATOR.encode() not in frame:
            return frame
    raise ValueError("a record cannot be told from the separator")


def write_archive(pages: DataFrame, path: str) -> None:
    """Writes a record for each row of `pages` (page_id, url, html) below `path`. A null html is an empty payload.

    Each part file is an archive of its own that begins with the dictionary. An empty table gives no record. Other columns
    are not read.
    """
    records, payloads = plan_records(pages)
    dictionary = build_dictionary(pages, payloads)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        coders: dict[int, zstandard.ZstdCompressor] = {}
        begun = False
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                out = []
                if not begun:
                    if dictionary:
                        out.append(DICTIONARY_MAGIC + struct.pack("<I", len(dictionary)) + dictionary)
                    out.append(compress(info_bytes(), own, coders))
                    begun = True
                for row in batch.slice(at, SLICE_ROWS).to_pylist():
                    text = record_bytes(row["page_id"], row["url"], row["payload"], row["digest"], row["refers_to"])
                    out.append(compress(text, own, coders))
                yield pa.record_batch([pa.array(out, pa.binary())], ["frame"])

    framed = records.mapInArrow(frames, "frame binary")
    framed.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def parse_record(text: bytes) -> dict:
    """The fields of a record and, of a response, its payload."""
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.decode().partition(": ")
        fields[name.lower()] = value
    block = rest[: int(fields["content-length"])]
    fields["block"] = block
    if fields["warc-type"] in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        fields["payload_bytes"] = int(re.search(rb"Content-Length: (\d+)", http)[1])
        fields["digest"] = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
        if fields["warc-type"] == "response":
            if hashlib.sha1(payload).hexdigest() != fields["digest"] or len(payload) != fields["payload_bytes"]:
                raise ValueError(f"damaged record {fields['warc-record-id']}")
            fields["payload"] = payload
    return fields


def read_archive(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The response and revisit records below `path`; with `payload`, that of each response as well.

    Each payload is checked against its digest; a damaged one ends the job with an error.
    """
    lines = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("frame"))
    # the first row of each file, and the same in all files of a folder
    found = lines.filter(F.substring("frame", 1, 4) == F.lit(DICTIONARY_MAGIC)).limit(1).collect()
    dictionary = bytes(found[0]["frame"][8:]) if found else None

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        reader = zstandard.ZstdDecompressor(dict_data=own)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                rows = []
                for frame in batch.slice(at, SLICE_ROWS).column(0).to_pylist():
                    if frame and not frame.startswith(DICTIONARY_MAGIC):
                        got = parse_record(reader.decompress(frame))
                        if got["warc-type"] != "warcinfo":
                            rows.append(got)
                columns = [
                    pa.array([int(r["page-id"]) if "page-id" in r else None for r in rows], pa.int64()),
                    pa.array([r.get("warc-target-uri") for r in rows], pa.string()),
                    pa.array([r["warc-type"] for r in rows], pa.string()),
                    pa.array([r["digest"] for r in rows], pa.string()),
                    pa.array([r["payload_bytes"] for r in rows], pa.int64()),
                    pa.array([int(r["refers-to-page-id"]) if "refers-to-page-id" in r else None for r in rows], pa.int64()),
                ]
                names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to"]
                if payload:
                    columns.append(pa.array([r.get("payload") for r in rows], pa.binary()))
                    names.append("payload")
                yield pa.record_batch(columns, names)

    return lines.mapInArrow(records, _RECORD + (", payload binary" if payload else ""))


def archive(pages: DataFrame) -> DataFrame:
    """Writes the archive of `pages` to the shared folder and reads its records back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
