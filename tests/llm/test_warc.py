"""WARC archives: an independent reader, odd rows, copies, separators."""

import glob
import hashlib
import io
import random
import struct

import zstandard
from riskloom.llm import warc
from riskloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "page_id long, url string, html string"


def plain_records(path):
    """All records of all files, by the stream reader of the library, which knows nothing of separators."""
    found, sizes = [], []
    for file in sorted(glob.glob(f"{path}/part-*")):
        raw = open(file, "rb").read()
        own = None
        if raw[:4] == b"\x5d\x2a\x4d\x18":
            size = struct.unpack("<I", raw[4:8])[0]
            own = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
            assert own.dict_id() > 0
            raw = raw[8 + size :]
        sizes.append(own is not None)
        stream = zstandard.ZstdDecompressor(dict_data=own).stream_reader(io.BytesIO(raw), read_across_frames=True)
        text = stream.read()
        while text:
            head, rest = text.split(b"\r\n\r\n", 1)
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            size = int(fields[b"Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            found.append((fields, rest[:size]))
            text = rest[size + 4 :]
    return found, sizes


def want_of(rows):
    heads = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            heads[body] = max(page, heads.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        to = heads.get(body)
        to = None if to is None or to == page else to
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str)


def test_pages_come_back_and_any_reader_reads_the_files(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in pages.collect()]
    assert rows_of(QUERIES["op12_warc"](spark, SF)) == want_of(rows)
    path = str(tmp_path / "a")
    warc.write_archive(pages.repartition(3), path)
    found, with_dictionary = plain_records(path)
    assert with_dictionary and all(with_dictionary)
    bodies = [block.split(b"\r\n\r\n", 1)[1] for f, block in found if f[b"WARC-Type"] == b"response"]
    revisits = [f for f, _ in found if f[b"WARC-Type"] == b"revisit"]
    assert len(bodies) + len(revisits) == len(rows)
    ids = {f[b"WARC-Record-ID"] for f, _ in found if f[b"WARC-Type"] == b"response"}
    assert all(f[b"WARC-Refers-To"] in ids for f in revisits)
    assert {hashlib.sha1(b).digest() for b in bodies} == {hashlib.sha1((h or "").encode()).digest() for _, _, h in rows}
    back = warc.read_archive(spark, path, payload=True).filter("record_type = 'response'").collect()
    assert sorted(bytes(r.payload) for r in back) == sorted(bodies)


def test_dictionary_makes_the_archive_smaller(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    records, payloads = warc.plan_records(pages)
    made = warc.build_dictionary(pages, payloads)
    texts = [warc.record_bytes(r.page_id, r.url, bytes(r.payload), r.digest, None) for r in records.collect()]
    own = zstandard.ZstdCompressionDict(made)
    assert sum(len(warc.compress(t, own, {})) for t in texts) < 0.8 * sum(len(warc.compress(t, None, {})) for t in texts)


def test_odd_rows(spark):
    long, other = "x" * 1000, "é" * 500
    rows = [(1, "http://a/ b\r\nX: y", None), (2, None, ""), (3, "u", "a" * 999), (4, "u", "a" * 999)]
    rows += [(5, "u", long), (7, "u", long), (6, "v", long), (8, "u", other), (9, "u", other)]
    rows += [(None, "u", long), (10, "u", "WARC/1.1\r\n\r\n" * 90), (11, "u", "y" * 3_000_000), (-1, "u", "\x00\r\n\n")]
    rows += [(12, "u", "P*M\x18\x00\x00\x00\x00" * 300), (13, "ünï", "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(warc.archive(df)) == want_of(rows)
    clash = df.selectExpr("*", "'x' AS digest", "1 AS refers_to", "2 AS head", "3 AS payload", "4 AS bytes")
    assert rows_of(warc.archive(clash)) == want_of(rows)
    twice = [*rows, (7, "u", long)]  # rows that share the largest id are all responses
    assert rows_of(warc.archive(spark.createDataFrame(twice, SCHEMA))) == want_of(twice)
    assert warc.archive(df.limit(0)).count() == 0
    assert warc.archive(spark.createDataFrame([(None, None, None)] * 3, SCHEMA)).count() == 3


def test_largest_group_of_copies_and_a_lost_order(spark):
    rng = random.Random(3)
    rows = [(i, f"u{i}", "same" * 300 if i % 3 else f"{rng.random()}" * 60) for i in range(3000)]
    rng.shuffle(rows)
    got = rows_of(warc.archive(spark.createDataFrame(rows, SCHEMA).repartition(7)))
    assert got == want_of(rows)


def test_frames_never_hold_the_separator(monkeypatch):
    real = zstandard.ZstdCompressor

    class Unlucky:
        def __init__(self, level, dict_data, write_checksum):
            self.level, self.coder = level, real(level=level)

        def compress(self, text):
            return warc.SEPARATOR.encode() if self.level == warc.LEVEL else self.coder.compress(text)

    monkeypatch.setattr(warc.zstandard, "ZstdCompressor", Unlucky)
    assert zstandard.ZstdDecompressor().decompress(warc.compress(b"abc", None, {})) == b"abc"
